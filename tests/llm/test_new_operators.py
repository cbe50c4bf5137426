"""Conversation repair, whitening and exact duplicates against brute-force versions."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from quarry.llm import conversation_repair, queries, radix_dedup, whitening
from tests.conftest import SF_SMALL

WHITE = re.compile(r"[\x20\x09-\x0D]+")


# --- exact duplicates -------------------------------------------------------------------------

def dedup_brute(rows):
    """Multiset of (doc_id, keep_id, size, sha); and of the rows that stay."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(WHITE.sub(" ", text or ""), []).append(doc_id)
    out, stay = [], []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
        stay.append((keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str), sorted(stay, key=str)


DEDUP_ROWS = ([(i, t) for i, t in enumerate(
    [None, "", " ", "\n\t", "a b", "a b", "a \n b", "a  b ", "x" * 64, "x" * 65, "x" * 64 + " ", "é" * 32, "é" * 32 + "x", "日本 語" * 500,
     "日本\n語" * 500, "日本 語" * 500 + "!", "long " * 4000 + "a", "long\t" * 4000 + "a", "long " * 4000 + "b", " \n" * 40_000 + "z", " z",
     "a" * 63 + " " * 300 + "b", "a" * 63 + " b"])]
    + [(None, "a b"), (None, "only null"), (None, "only null"), (4, "a b"), (4, "a b"), (0, "a b")] + [(100 + i, "copies " * 30) for i in range(300)])


@pytest.mark.parametrize("digit", [(64, 16, 1 << 20), (3, 1, 3), (3, 8, 5000)])
def test_exact_duplicates_against_brute_force(spark, digit):
    rows = DEDUP_ROWS if digit[1] > 1 else [(i, (t or "")[:12]) for i, t in DEDUP_ROWS]
    docs = spark.createDataFrame([(i, t, 1, "p", 2, True, "q") for i, t in rows],
                                 "doc_id long, text string, n int, rest string, row long, kept boolean, digit string").repartition(5)
    got = radix_dedup.exact_duplicates(docs, first_digit=digit[0], growth=digit[1], largest_digit=digit[2]).collect()
    every, stay = dedup_brute(rows)
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == every
    assert sorted([(r["doc_id"], r["text_sha256"]) for r in got if r["kept"]], key=str) == stay
    assert radix_dedup.exact_duplicates(docs.where("doc_id < -1")).collect() == []


def test_exact_duplicates_of_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = queries.op13_exact_duplicates(spark, SF_SMALL).collect()
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == dedup_brute(
        [(r["doc_id"], r["text"]) for r in docs.collect()])[0]


# --- conversation repair ----------------------------------------------------------------------

def cheapest(initials, faults):
    """Least (cost, audit) by Dijkstra over whole audits."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, made = heapq.heappop(heap)
        if at == len(initials) and re.fullmatch("(s?(ua)+)?", made):
            return cost, audit
        state = made[-1:]
        if (audit, at) in done:
            continue
        done.add((audit, at))
        following = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        role = following[-1]
        if audit[-3:] != "III":
            heapq.heappush(heap, (cost + 2, audit + "I", at, made + role))
        if at < len(initials):
            cut = faults[at] == conversation_repair.CUT
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, made))
            if faults[at] in (conversation_repair.FINE, conversation_repair.CUT):
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", at + 1, made + role))
                if initials[at] in following:
                    heapq.heappush(heap, (cost + cut, audit + "K", at + 1, made + initials[at]))
    raise AssertionError


def test_least_weight_against_search():
    draw = random.Random(1)
    cases = [("", b"")] + [("".join(c), bytes(n)) for n in range(1, 4) for c in itertools.product("sua?", repeat=n)]
    cases += [("".join(draw.choice("suuaa?") for _ in range(n)), bytes(draw.choice((0, 0, 0, 1, 2, 3)) for _ in range(n)))
              for n in range(1, 8) for _ in range(40)]
    for initials, faults in cases:
        assert conversation_repair.least_weight(initials, faults) == cheapest(initials, faults), (initials, faults)


def repair_brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            kept += [(turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns, seen, faults = {t for t, _, _ in kept if t is not None}, set(), []
        for _, role, text in kept:
            body = WHITE.sub("", text)
            faults.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = "".join(r[:1] if r[:1] in ("s", "u", "a") else "?" for _, r, _ in kept)
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit = cheapest(initials, faults)
        lines, made, rest = [], "", iter(kept)
        for edit in audit:
            want = "assistant" if made[-1:] == "u" else "user"
            row = next(rest) if edit != "I" else (None, want, "")
            if edit != "D":
                lines.append((row[1] if edit == "K" else want) + ":" + row[2])
                made += lines[-1][0]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(df):
    got = df.collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def test_repair_of_given_conversations(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    assert repaired(queries.op11_conversation_repair(spark, SF_SMALL)) == repair_brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_repair_of_odd_conversations(spark):
    draw = random.Random(2)
    texts = [None, "", " \n", "Fine.", "Cut", "Fine.", "Ends \t\n", "Wow! ", "é", "no. no", "x?\x0b"]
    rows = [(draw.choice([None, *range(40)]), draw.choice([None, 0, 1, 2, 3, 5, 9]), draw.choice([None, "", "user", "assistant", "system", "tool", "Aa", "ses"]),
             draw.choice(texts)) for _ in range(160)]
    rows += [(900, None, "user", "a."), (900, None, "user", "a."), (901, 3, "user", "word. " * 20_000)] + [(c, 0, "user", "Hi.") for c in range(1000, 1040)]
    rows = [r for r in rows if r[0] is not None] + [r for r in rows if r[0] is None][:6]
    schema = "conv_id long, turn long, role string, text string, fault int, gone boolean, audit string, c long, n long"
    df = spark.createDataFrame([(*r, 7, True, "z", 1, 2) for r in rows], schema).repartition(3)
    assert repaired(conversation_repair.repair(df)) == repair_brute(rows)
    assert conversation_repair.repair(df.where("conv_id < 0")).collect() == []


def test_long_conversation_is_repaired():
    n = 3000
    cost, audit = conversation_repair.least_weight("ua" * n, bytes(2 * n))
    assert (cost, audit) == (0, "K" * 2 * n)
    assert conversation_repair.least_weight("u" * n, bytes(n))[0] == 2 * (n // 2)


# --- whitening --------------------------------------------------------------------------------

def whiten_brute(rows, components=8):
    kept = [(i, [int(np.floor(1024 * float(c))) + 100_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept], object)
    n, s = len(x), x.sum(0)
    y = ((n * x - s) / n).astype(float)
    cov = y.T @ y / n
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    return kept, ((n * x - s) ** 2).sum(1), y @ axes / np.sqrt(e), e / np.trace(cov)


def test_whitening_against_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    kept, deviation, whitened, explained = whiten_brute(rows)
    got = queries.op12_whitening(spark, SF_SMALL).collect()
    assert len(got) == 8 * len(kept)
    place = {i: k for k, (i, _) in enumerate(kept)}
    w = np.zeros((len(kept), 8))
    for r in got:
        w[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[place[r["vec_id"]]] and r["n"] == len(kept)
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-9
    sign = np.sign((w * whitened).sum(0))
    assert np.abs(w * sign - whitened).max() < 1e-7


def test_whitening_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0, 0.25]), (1, [0.5, 1.0, 0.25]), (None, [1.5, -1.0, 4.0]), (3, [2.5, 3.0, -1.0]), (4, None), (5, [None, 1.0, 2.0]), (6, [nan, 1.0, 2.0]),
            (7, [inf, 0.0, 0.0]), (8, [1.0, 2.0]), (9, []), (10, [7.0, 2.0, 2.0])]
    schema = "vec_id long, embedding array<float>, x string, d int, k long, component int"
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], schema)
    got = whitening.whiten(df).collect()
    assert len(got) == 3 * 5 and sorted(r["component"] for r in got) == sorted([1, 2, 3] * 5) and got[0]["identity_error"] < 1e-9
    _, deviation, _, explained = whiten_brute([r for r in rows if len(r[1] or [0]) == 3])
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(deviation)
    assert whitening.whiten(df.where("vec_id > 99")).collect() == []
    assert whitening.whiten(df.where("vec_id = 1")).collect() == []  # no variance
    assert whitening.whiten(df.where("vec_id = 9")).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(20)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}  # rank one
    huge = spark.createDataFrame([(i, [float(i) * 1e37, 1.0]) for i in range(3)], "vec_id long, embedding array<float>")
    assert {r["n"] for r in whitening.whiten(huge).collect()} == {3}


def test_jacobi_on_an_ill_conditioned_matrix():
    draw = np.random.default_rng(0)
    q, _ = np.linalg.qr(draw.normal(size=(30, 30)))
    e = np.logspace(0, -10, 30)
    values, axes = whitening.principal_axes(q * e @ q.T, 30)
    assert np.abs(values[:20] / e[:20] - 1).max() < 1e-8
    assert np.abs(axes.T @ axes - np.eye(axes.shape[1])).max() < 1e-12
    assert np.abs(np.abs((axes * q[:, :axes.shape[1]]).sum(0))[:20] - 1).max() < 1e-8
