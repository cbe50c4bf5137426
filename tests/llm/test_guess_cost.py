"""Guess cost against all segmentations, and the whole operator against one pass without Spark."""

import math
import random
from collections import Counter

import pytest

from quarry.llm import secrets

SF_SMALL = "/root/testdata/sf0.001"


def piece_cost(cost, more, piece):
    """The cheapest reading of one whole piece."""
    out = [len(piece) + 1.0]
    low = piece.lower() if len(piece.lower()) == len(piece) else piece
    for form, extra in ((low, 0.0), (low.translate(secrets._LEET), math.log10(4))):
        ranks = [r for r in (more.get(form), cost.rank.get(form)) if r]
        if len(piece) >= 3 and ranks:
            out.append(math.log10(min(ranks) + 1) + extra + (math.log10(2) if piece != low else 0.0))
            break
    if secrets._DATE.fullmatch(piece):
        out.append(4.0)
    if secrets._YEAR.fullmatch(piece):
        out.append(2.0)
    if len(piece) >= 3 and all(b in cost.next.get(a, ()) for a, b in zip(low, low[1:])):
        out.append(math.log10(94 * len(piece)))
    for size in range(1, secrets.LONGEST_BLOCK + 1):
        if len(piece) >= size + max(size, 2) and all(low[i] == low[i - size] for i in range(size, len(low))):
            out.append((math.log10(95) if size == 1 else size + 1.0) + math.log10(len(piece) / size))
    return min(out)


def exhaustive(cost, value, more):
    n = len(value)
    return min(sum(piece_cost(cost, more, value[a:b]) for a, b in zip([0, *cuts], [*cuts, n]))
               for mask in range(2 ** (n - 1)) for cuts in [[i + 1 for i in range(n - 1) if mask >> i & 1]])


def test_cost_is_least_over_all_segmentations():
    rng = random.Random(5)
    cost, more = secrets.GuessCost(), {"geduld": 3, "qwer": 40, "master": 900, "ter": 12}
    parts = ["master", "qwerty", "G3duld", "1999", "20240131", "abab", "aaa", "zz", "k7", "#", "asdf", "ter", "Dragon", "xyzxyz", "fdsa"]
    values = ["masterty", "qwertyui", "20240131", "mastertrewq", "aaaaaa", "k7k7k7k7x", "ſecretß"]
    values += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))[:12] for _ in range(60)]
    for value in values:
        assert cost(value, more) == pytest.approx(exhaustive(cost, value, more)), value
    assert cost("qw" * 50_000) < 9 and cost("k7#Zq" * 40_000) < 12  # very long values, in linear time


def brute_scan(rows, min_log10=9.0):
    """Guess spans of ``(doc_id, text, lang)`` by one pass over everything."""
    seen = {}
    for _, text, lang in rows:
        for w in secrets._words(text or ""):
            seen.setdefault((lang, w), []).append(text)
    count = {k: len(v) for k, v in seen.items() if len(set(v)) > 1}
    by_lang = {}
    for (lang, _), n in count.items():
        by_lang.setdefault(lang, Counter())[n] += 1
    rank = {}
    for (lang, w), n in count.items():
        own = 1 + sum(c for m, c in by_lang[lang].items() if m > n)
        rank[w] = min(own, rank.get(w, own))
    cost, out = secrets.GuessCost(), []
    for i, text, _ in rows:
        text = text or ""
        spans = secrets.base_spans(text) + [("guess", a, b) for a, b in secrets.candidates(text) if cost(
            text[a:b], {p: rank[p] for p in secrets._pieces(text[a:b]) if p in rank}) >= min_log10]
        out.append((i, secrets.joined(spans)))
    return sorted(out, key=str)


def test_scan_against_one_pass(spark):
    given = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    words = sorted({w for _, t, _ in given for w in secrets._words(t or "")})
    rng = random.Random(2)
    made = [(10**6 + k, f"note {k}: the password is {rng.choice(words)}{rng.choice(words)} and DB_PASS='{rng.choice(words)}{rng.randint(0, 10**9)}#x'",
             rng.choice(["en", "de", None])) for k in range(120)]
    # the same value in a third of all rows, rows repeated, null ids and texts
    hot = [(2 * 10**6 + k, f"pwd: Zk8#qT!9vLx2 {k}", "en") for k in range(150)]
    rows = given + made + hot + [made[0], made[0], (None, made[1][1], None), (None, None, None), (5, "", "en"), (None, None, None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = sorted(((r["doc_id"], r["spans"]) for r in secrets.scan(table).collect()), key=str)
    assert got == brute_scan(rows)
    assert sum("guess" in s for _, s in got) > 150


def test_a_rank_of_any_size_is_used(spark):
    """More words of one count than any list would hold still make their values cheap."""
    words = ["".join(chr(97 + k // 26**i % 26) for i in range(4)) + "esque" for k in range(3000)]
    text = " ".join(words)
    rows = [(0, text, "en"), (1, text + " again", "en"), (2, f"the secret is {words[2999]}", "en")]
    got = {r["doc_id"]: r["n_guess"] for r in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert got == {0: 0, 1: 0, 2: 0}
    alone = secrets.scan(spark.createDataFrame(rows[2:], "doc_id bigint, text string, lang string")).first()
    assert alone["n_guess"] == 1
