"""Main text of web pages: page roles, and removal of a site's recurring subtrees.

Every page is read once, element by element (unclosed and stray tags as browsers treat them,
truncated pages up to their end).  The scope is the ``article`` elements, else ``main``, else
the body; articles that hold less than half of the text around them are teasers and decide nothing.
Inside it, elements whose tag, role or whole class name or id is that of a menu,
header, footer, sidebar, notice, advert, form, widget or comments are left out, as are scripts,
styles and hidden elements.  Parts of a compound name decide nothing, and neither do the ids of
headings, of sections and of elements inside an article or main.  If every article (else main)
is inside elements so left out, these are read after all, unless the text outside is longer.  On a
page without article and main, forms are read if they hold most of the text.  A header in an article
or main part belongs to it.

What is left of a site's template is found by recurrence: each block element in scope is
hashed as a subtree (tags and text), and the subtrees are counted per host in Spark, once per
distinct page.  Distinct means different main text, so a group of copies of one page counts once
and copied articles survive.  A subtree that recurs on ``min_pages`` distinct pages is a template
candidate, however many other pages the host has.  Then

* containers (``div``, ``section``, lists, tables, ...) are deleted;
* paragraphs and the other blocks are deleted if the rest of their pages differs: there are
  ``min_pages`` different rests among pages where the blocks that do not recur are most of the
  other blocks or most of the text.  So paragraphs of copies with small edits survive.  They must
  also look like a template's: found on this host only, or on three hosts at most and in nine of
  ten pages at one place, counted from the first or the last block.  A sentence that many hosts
  have is common prose and stays;
* a heading is deleted if so is all text up to the next heading;
* parts of a list or table inside an article or main (``li``, ``td``, ... and what is in them)
  go only with a container: equal cells and items are common in different tables.

Text: character references are decoded, white space inside a block becomes one space, blocks
are trimmed, empty ones dropped, and the rest joined by one line feed in page order.

Null html gives an empty text, a null url an empty host.  Repeated rows give equal rows.  A
very long page is read whole.  An empty table gives no rows; only id, url and html are read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import pinned
from quarry.llm.url_rules import host_of

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.S)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot "
                    "th thead tr ul").split())
CONTAINERS = frozenset("aside details div dl figure ol section table ul".split())
PARTS = frozenset("caption dd dt legend li option summary tbody td tfoot th thead tr".split())
#: The kinds of counted subtrees, the lowest two bits of their hashes.
CONTAINER, PROSE, HEADING = 0, 1, 2
#: What a start tag closes, up to the given scope.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}

SKIPPED = frozenset("nav footer aside form button select dialog menu template svg object canvas audio video datalist".split()) | RAW
SKIPPED_OUTSIDE = frozenset({"header"})
#: Never shown as text, even around an article.
HARD = frozenset("button select template svg object canvas audio video datalist head".split()) | RAW
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Whole class names and ids, as a supplement of the recurrence counts.
CLASSES = frozenset((
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup paywall sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer comment comments commentlist reply replies respond disqus related recommended share sharing social widget "
    "toolbar masthead login search skip toc "
    "ad-banner ad-box ad-container ad-slot ad-unit banner-ad cookie-banner cookie-bar cookie-consent cookie-notice comment-list comment-respond "
    "comments-area disqus_thread main-menu main-nav main-navigation nav-links nav-menu newsletter-signup page-footer post-navigation "
    "related-articles related-posts share-buttons side-bar site-footer site-nav site-navigation site-sidebar skip-link social-links "
    "social-share widget-area").split())
CLASSES_OUTSIDE = frozenset("header page-header site-header".split())


def _is_side(tag: str, attrs: str, in_article: bool, in_main: bool = False) -> bool:
    """Whether an element is not part of the main text by its role."""
    if tag in SKIPPED or (tag in SKIPPED_OUTSIDE and not in_article and not in_main):
        return True
    if tag in ("html", "body", "article", "main") or "=" not in attrs and "hidden" not in attrs.lower():
        return False
    by_id, section = False, in_article or in_main or tag == "section" or tag in HEADINGS
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            names = set(value.split())
            listed = bool(names & CLASSES or (not in_article and not in_main and names & CLASSES_OUTSIDE))
            if name == "id":  # ids of headings and sections are made from their titles
                by_id |= listed
            elif listed:
                return True
            else:
                section |= "section" in names
        elif name == "role" and value.strip() in ROLES:
            return True
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return by_id and not section


def _chars(blocks: list[tuple[str, list[int]]]) -> int:
    return sum(len(line) for line, _ in blocks)


class Page:
    """Blocks of the main text and, per block, the hashes of the counted subtrees around it."""

    def __init__(self, source: str):
        found, wrappers = self._read(source, frozenset())
        if wrappers:  # every article is inside an element left out: is it the page's text?
            more, _ = self._read(source, wrappers)
            if _chars(more["article"] or more["main"]) >= _chars(found["main"] or found["body"]):
                found = more
        chosen = self._scope(found)
        if self.forms and not found["article"] and not found["main"]:  # a form around the page, or one on it?
            more, _ = self._read(source, frozenset(self.forms))
            if _chars(whole := self._scope(more)) > 2 * _chars(chosen):
                chosen = whole
        self.blocks = [b for b, _ in chosen]
        self.under = [u for _, u in chosen]

    @staticmethod
    def _scope(found: dict) -> list:
        """The articles, unless most text of the main part (or the body) is outside them: then they are teasers."""
        around = found["main"] or found["body"]
        if found["article"] and 2 * _chars(found["article"]) >= _chars(around):
            return found["article"]
        return around

    def _read(self, source: str, exempt: frozenset[int]) -> tuple[dict[str, list[tuple[str, list[int]]]], frozenset[int]]:
        """Blocks by scope, and the left-out elements around the articles (or mains) if none is outside such
        elements; ``exempt`` elements (by number) are not left out."""
        out: dict[str, list] = {"article": [], "main": [], "body": []}
        stack: list[list] = []  # tag, side, articles open, mains open, first token, first block (None: not counted), kind, part, number
        tokens: list = []
        blocks: list[tuple[str, list[int], bool, bool]] = []
        text: list[str] = []
        side = articles = mains = parts = 0
        has_article = has_main = False
        number = 0
        self.forms: list[int] = []  # forms left out for their tag alone
        held: dict[str, list[list[int]]] = {"article": [], "main": []}  # left-out elements around articles and mains
        level = {"article": math.inf, "main": math.inf}

        def flush():
            if text:
                line = " ".join(entities.unescape("".join(text)).split())
                text.clear()
                if line:
                    blocks.append((line, [], articles > 0, mains > 0))
                    tokens.append(line)

        def close():
            nonlocal side, articles, mains, parts
            tag, was_side, token, first, kind, was_part, _ = stack.pop()
            if tag in BLOCKS:
                flush()
            side -= was_side
            parts -= was_part
            articles -= tag == "article"
            mains -= tag == "main"
            if not side and token is not None:
                digest = xxhash.xxh64_intdigest("\x00".join([tag, *map(str, tokens[token:])]).encode()) >> 1
                del tokens[token:]
                tokens.append(digest)
                if first is not None:
                    for b in blocks[first:]:
                        b[1].append(digest >> 2 << 2 | kind)

        at, n = 0, len(source)
        while at < n:
            m = _TOKEN.search(source, at)
            if not side:
                text.append(source[at:m.start() if m else n])
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if tag == "br":
                    text.append(" ")
                elif any(e[0] == tag for e in stack):
                    while stack[-1][0] != tag:
                        close()
                    close()
                continue
            if tag == "br" or tag == "wbr":
                text.append(" " if tag == "br" and not side else "")
                continue
            if tag in BLOCKS:
                if not side:
                    flush()
                if tag not in ("body", "html", "head"):
                    self._close_implied(stack, "p", {"p"}, {"button", "table", "td", "th", "article", "section", "div"}, close)
            if tag in CLOSES:
                self._close_implied(stack, tag, *CLOSES[tag], close)
            if tag in VOID or m[3].endswith("/>") and tag not in BLOCKS:
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
                at = n if not end else (source.find(">", end.start()) + 1 or n)
                continue
            own = _is_side(tag, m[3], articles > 0, mains > 0) or tag == "head"  # nothing in a head is text
            number += 1
            if number in exempt:
                own = False
            elif own and tag == "form" and not side and not _is_side("div", m[3], articles > 0, mains > 0):
                self.forms.append(number)
            if tag == "body" and any(e[0] == "head" for e in stack):
                while any(e[0] == "head" for e in stack):
                    close()
            articles += tag == "article"
            mains += tag == "main"
            if not side:
                has_article |= tag == "article" and not own
                has_main |= tag == "main" and not own
            elif tag in held and not any(e[1] and e[0] in HARD for e in stack):
                around = [e[-1] for e in stack if e[1]]
                level[tag] = min(level[tag], len(around))
                held[tag].append(around[:level[tag]])
            part = tag in PARTS and (articles > 0 or mains > 0)
            parts += part
            counted = not side and not own and tag in BLOCKS and (tag in CONTAINERS or not parts and tag not in ("html", "body", "main", "article"))
            kind = CONTAINER if tag in CONTAINERS else HEADING if tag in HEADINGS else PROSE
            side += own
            stack.append([tag, own, len(tokens) if not side else None, len(blocks) if counted else None, kind, part, number])
        while stack:
            close()
        flush()
        for line, under, in_article, in_main in blocks:
            out["body"].append((line, under))
            if in_article:
                out["article"].append((line, under))
            if in_main:
                out["main"].append((line, under))
        if has_article and not out["article"]:
            out["body"] = out["main"] = []
        if has_article or has_main and not held["article"]:
            return out, frozenset()
        tag = "article" if held["article"] else "main"
        return out, frozenset(e for around in held[tag] for e in around[:level[tag]])

    @staticmethod
    def _close_implied(stack, tag, closes, scope, close):
        for e in reversed(stack):
            if e[0] in closes:
                while stack[-1][0] not in closes:
                    close()
                close()
                return
            if e[0] in scope:
                return


def parse(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, host, blocks, under, sig)``; ``under`` has the hashes of the counted subtrees of each block,
    ``sig`` hashes the whole text."""
    cut = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                read = [Page(h or "") for h in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("url"), batch.column("host"), pa.array([p.blocks for p in read], pa.list_(pa.string())),
                     pa.array([p.under for p in read], pa.list_(pa.list_(pa.int64()))),
                     pa.array([xxhash.xxh64_intdigest("\n".join(p.blocks).encode()) >> 1 for p in read], pa.int64())],
                    names=["id", "url", "host", "blocks", "under", "sig"])

    kind = cut.schema["id"].dataType.simpleString()
    return cut.mapInArrow(run, f"id {kind}, url string, host string, blocks array<string>, under array<array<bigint>>, sig bigint")


def recurring(seen: DataFrame, min_pages: int = 10) -> DataFrame:
    """``(host, subtree)`` that recur on many distinct pages of their host, from distinct ``(host, sig, under)`` rows."""
    return _subtrees(seen).groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages).select("host", "subtree")


def _subtrees(seen: DataFrame) -> DataFrame:
    return seen.select("host", "sig", F.explode(F.array_distinct(F.flatten("under"))).alias("subtree"))


def _of_pages(seen: DataFrame, subtrees: DataFrame, name: str) -> DataFrame:
    """``(host, sig, name)``: which of the ``subtrees`` a page has, for pages that have any."""
    return _subtrees(seen).join(subtrees, ["host", "subtree"]).groupBy("host", "sig").agg(F.collect_set("subtree").alias(name))


def rests(under: list[list[int]], sizes: list[int], prints: list[int], often: set[int]) -> tuple[list[tuple[int, int, int]], int]:
    """Subtrees of a page, no containers, beside which most of the page does not recur, each with the number of
    blocks before it and after it; and the hash of what does not recur."""
    live = [k for k, u in enumerate(under) if not any(h & 3 == CONTAINER and h in often for h in u)]
    held = {k: [h for h in under[k] if h in often] for k in live}
    own = [k for k in live if not held[k]]
    chars, most = sum(sizes[k] for k in own), sum(sizes[k] for k in live)
    n = Counter(h for k in live for h in set(held[k]))
    place: dict[int, list[int]] = {}
    for at, k in enumerate(live):
        for h in held[k]:
            place.setdefault(h, [at, at])[1] = at
    out = [(h, place[h][0], len(live) - 1 - place[h][1]) for h, blocks in n.items()
           if own and (2 * len(own) > len(live) - blocks or 2 * chars > most)]
    return out, xxhash.xxh64_intdigest(" ".join(str(prints[k]) for k in own)) >> 1


#: Share of a host's pages that have a template's paragraph at one place, and the hosts that may share it.
FIXED_PLACE, FEW_HOSTS = 0.9, 3


def differing(seen: DataFrame, often: DataFrame, min_pages: int = 10) -> DataFrame:
    """``(host, subtree)`` of the recurring paragraphs, headings, ... whose pages differ in the rest and that
    are on one host only, or on few and at a fixed place."""
    some = seen.join(_of_pages(seen, often, "often"), ["host", "sig"]).where(F.exists("often", lambda h: h.bitwiseAND(F.lit(3)) != CONTAINER))

    def run(batches):
        for batch in batches:
            rows = [(host, *found, rest) for host, under, sizes, prints, often in zip(*[batch.column(c).to_pylist() for c in names])
                    for page, rest in [rests(under, sizes, prints, set(often))] for found in page]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 0 else pa.int64()) for k, c in enumerate(cols)],
                                             names=["host", "subtree", "before", "after", "rest"])

    names = ["host", "under", "sizes", "prints", "often"]
    found = pinned(some.select(*names).mapInArrow(run, "host string, subtree bigint, before bigint, after bigint, rest bigint"))
    key = ["host", "subtree"]
    wanted = found.select(*key, "rest").distinct().groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= min_pages).select(*key)

    def most(place):
        return found.groupBy(*key, place).agg(F.count("*").alias("c")).groupBy(*key).agg((F.max("c") / F.sum("c")).alias(place))

    places = most("before").join(most("after"), key).where(F.greatest("before", "after") >= FIXED_PLACE).select(*key)
    hosts = _subtrees(seen).select(*key).distinct().join(wanted.select("subtree").distinct(), "subtree", "left_semi")
    few = pinned(hosts.groupBy("subtree").agg(F.count("*").alias("hosts")).where(F.col("hosts") <= FEW_HOSTS))
    alone = wanted.join(few.where("hosts = 1"), "subtree", "left_semi").select(*key)
    return wanted.join(few, "subtree", "left_semi").select(*key).join(places, key, "left_semi").unionByName(alone).distinct()


def kept_blocks(under: list[list[int]], bad: set[int]) -> list[bool]:
    """Which blocks stay when the subtrees ``bad`` are deleted."""
    keep = [not any(h & 3 != HEADING and h in bad for h in u) for u in under]
    k = len(under)
    text = stays = False  # of the section after block k: whether it has text, and any that stays
    while k:
        k -= 1
        titles = [h for h in under[k] if h & 3 == HEADING]
        if titles:
            keep[k] = keep[k] and not (text and not stays and any(h in bad for h in titles))
            text = stays = False
        else:
            text, stays = True, stays or keep[k]
    return keep


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = 10) -> DataFrame:
    """``(id, url, text, n_chars, n_removed_blocks)`` for every page."""
    parsed = parse(pages, id_col, url_col, html_col)
    read = parsed.where(F.size(F.flatten("under")) > 0).select(
        "host", "sig", "under", F.transform("blocks", lambda b: F.length(b)).alias("sizes"), F.transform("blocks", lambda b: F.xxhash64(b)).alias("prints"))
    seen = pinned(read.groupBy("host", "sig").agg(*[F.first(c).alias(c) for c in ("under", "sizes", "prints")]))
    often = pinned(recurring(seen, min_pages))
    containers = often.where(F.col("subtree").bitwiseAND(F.lit(3)) == CONTAINER)
    bad = pinned(containers.unionByName(differing(seen, often, min_pages)))
    joined = parsed.join(pinned(_of_pages(seen, bad, "bad")), ["host", "sig"], "left")

    def run(batches):
        for batch in batches:
            texts, gone = [], []
            for blocks, under, bad in zip(*[batch.column(c).to_pylist() for c in ("blocks", "under", "bad")]):
                left = [b for b, k in zip(blocks, kept_blocks(under, set(bad))) if k] if bad else blocks
                texts.append("\n".join(left))
                gone.append(len(blocks) - len(left))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(gone, pa.int64())],
                                             names=["id", "url", "text", "n_removed_blocks"])

    kind = joined.schema["id"].dataType.simpleString()
    out = joined.select("id", "url", "blocks", "under", "bad").mapInArrow(run, f"id {kind}, url string, text string, n_removed_blocks bigint")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"), "n_removed_blocks")
