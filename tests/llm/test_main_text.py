"""Main text: a brute-force version of the recurrence rules, scopes, forms, headers and odd tables."""

from collections import Counter, defaultdict

from quarry.llm import site_template
from tests.conftest import SF_SMALL


def text(source):
    return "\n".join(site_template.Page(source).blocks)


def brute(rows, min_pages=10):
    """The texts of all pages, in one Python pass over them."""
    pages = {i: (host(u), site_template.Page(h or "")) for i, u, h in rows}
    seen = {}
    for h, p in pages.values():
        if any(p.under):
            seen.setdefault((h, "\n".join(p.blocks)), p)
    count, hosts = Counter(), defaultdict(set)
    for (h, _), p in seen.items():
        for s in {s for u in p.under for s in u}:
            count[h, s] += 1
            hosts[s].add(h)
    often = defaultdict(set)
    for (h, s), n in count.items():
        if n >= min_pages:
            often[h].add(s)
    different, before, after = defaultdict(set), defaultdict(Counter), defaultdict(Counter)
    for (h, _), p in seen.items():
        found, rest = site_template.rests(p.under, [len(b) for b in p.blocks], [hash(b) for b in p.blocks], often[h])
        for s, b, a in found:
            different[h, s].add(rest)
            before[h, s][b] += 1
            after[h, s][a] += 1
    bad = defaultdict(set)
    for h in often:
        for s in often[h]:
            if s & 3 == site_template.CONTAINER:
                bad[h].add(s)
            elif len(different[h, s]) >= min_pages:
                fixed = max(c.most_common(1)[0][1] / sum(c.values()) for c in (before[h, s], after[h, s])) >= 0.9
                if len(hosts[s]) == 1 or fixed and len(hosts[s]) <= 3:
                    bad[h].add(s)
    return {i: "\n".join(b for b, k in zip(p.blocks, site_template.kept_blocks(p.under, bad[h])) if k) for i, (h, p) in pages.items()}


def host(url):
    rest = (url or "").split("://", 1)
    if len(rest) < 2:
        return ""
    for c in "/?#":
        rest[1] = rest[1].split(c)[0]
    return "".join(x.lower() if "A" <= x <= "Z" else x for x in rest[1])


def test_all_given_pages_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    common = "<p>Everyone says this now and then."
    for h in range(5):  # prose of many hosts at the end, a notice of one host, a section box of two
        rows += [(10_000 + 100 * h + i, f"http://h{h}.org/{i}", f"<article><h1>Title {h} {i}</h1><p>Story {h} {i} of the day"
                  + ("<p>Our offers end at midnight." if h == 0 else "") + (f"<p>x{i}" * (i % 4) + "<p>Sign up." if h in (1, 2) else "") + common + "</article>")
                 for i in range(14)]
    got = {r["page_id"]: r["text"] for r in site_template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    want = brute(rows)
    assert got == want
    assert got[10_003].split("\n") == ["Title 0 3", "Story 0 3 of the day", "Everyone says this now and then."]
    assert got[10_103].split("\n")[-1] == "Everyone says this now and then." and "Sign up." not in got[10_103]


def test_form_around_the_page():
    page = '<body><form id="aspnetForm" runat="server"><div class="menu">m</div><h1>Title</h1><p>Long prose of the page.</p><input><label>Search</label></form></body>'
    assert text(page).split("\n")[:2] == ["Title", "Long prose of the page."] and "m" not in text(page).split("\n")
    assert text("<body><p>Prose of the page, much of it.</p><form><p>Your name</p><input></form></body>") == "Prose of the page, much of it."
    assert text("<article><p>a</p><form><p>Many words about your comment here</p></form></article>") == "a"
    assert text('<body><form class="search"><p>Only a search field</p></form></body>') == ""


def test_teasers_and_headers():
    assert text("<main><h1>T</h1><p>long prose of the main part of it</p><section><article class='card'><p>Teaser</article></section></main>").split("\n")[:2] == [
        "T", "long prose of the main part of it"]
    assert text("<main><header><h1>T</h1><nav>n</nav></header><p>prose</p></main><header><h1>Site</h1></header>") == "T\nprose"
    assert text("<main><h1>T</h1><article><p>a long article with all the text</article><section>More</section></main>") == "a long article with all the text"


def test_odd_pages_and_columns(spark):
    schema = "page_id long, url string, html string, host string, text string, sig long, under string, blocks string, id int, bad int"
    rows = [(i, u, h, "h", "t", 1, "u", "b", 2, 3) for i, u, h in [(None, "http://a.b/", "<p>x</p>"), (1, None, "<p>y</p>"), (1, None, "<p>y</p>"), (2, "http://a.b/", None)]]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in site_template.main_text(df).collect()), key=str)
    assert got == sorted([(None, "http://a.b/", "x", 1), (1, None, "y", 1), (1, None, "y", 1), (2, "http://a.b/", "", 0)], key=str)
    assert site_template.main_text(df.where("page_id > 99")).collect() == []
    long = spark.createDataFrame([(5, "http://a.b/", "<p>" + "word " * 200_000 + "</p>")], "page_id long, url string, html string")
    assert site_template.main_text(long).first()["n_chars"] == 999_999
