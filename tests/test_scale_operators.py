"""Wide and penalised regression, search from both ends, many patterns, lasting ids."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import lasting_ids, meeting, patterns, regression, wide_regression
from quarry.plans.tables import table
from tests.conftest import SF_SMALL


def test_wide_sgd_equals_moments(spark):
    li = table(spark, SF_SMALL, "lineitem").select((F.col("l_tax") * 10).alias("a"), F.col("l_discount").alias("b"), F.col("l_quantity").alias("y"))
    want, rounds = regression.sgd_ridge(li, ["a", "b"], "y")
    rows = li.select(F.array(F.lit(0), F.lit(1)).alias("indices"), F.array("a", "b").alias("values"), F.col("y").alias("label"))
    odd = spark.createDataFrame([([0], [None], 1.0), (None, [1.0], 1.0), ([1], [1.0], None), ([0, 1], [1.0], 2.0)],
                                "indices array<int>, values array<double>, label double")
    got, n = wide_regression.sgd_wide(rows.unionByName(odd), 2)
    assert n == rounds and np.allclose(got, want, rtol=1e-12)
    assert wide_regression.sgd_wide(rows.limit(0), 3)[1] == 0


def test_wide_sgd_with_ten_thousand_features(spark):
    draw = np.random.default_rng(0)
    truth = np.zeros(10_000)
    truth[::100] = draw.normal(size=100)
    rows = []
    for _ in range(400):
        k = np.unique(np.concatenate([draw.integers(0, 10_000, 20), draw.integers(0, 100, 5) * 100]))
        v = draw.normal(size=len(k))
        rows.append((k.tolist(), v.tolist(), float(v @ truth[k])))
    got, rounds = wide_regression.sgd_wide(spark.createDataFrame(rows, "indices array<int>, values array<double>, label double"), 10_000, iterations=4, tol=0)
    w = np.zeros(10_000)
    x = np.zeros((400, 10_000))
    for i, (k, v, _) in enumerate(rows):
        x[i, k] = v
    y = np.array([r[2] for r in rows])
    for i in range(1, 5):
        w = w * (1 - 0.01 / i ** 0.5) - (x.T @ (x @ w - y)) / 400 / i ** 0.5
    assert rounds == 4 and np.allclose(got, w, atol=1e-12)


def test_coordinate_descent_equals_spark_ml(spark):
    li = table(spark, SF_SMALL, "lineitem").select("l_quantity", "l_discount", "l_tax", F.lit(3.0).alias("same"), (F.col("l_extendedprice") / 1000).alias("label"))
    names = ["l_quantity", "l_discount", "l_tax", "same"]
    for reg, mix in ((0.3, 0.8), (2.0, 1.0), (1.0, 0.0), (100.0, 1.0), (0.0, 0.5)):
        w, b = wide_regression.elastic_net_from_moments(li, names, "label", reg, mix)
        m = regression.elastic_net(regression.assemble(li, names), reg=reg, mix=mix, max_iter=1000, tol=1e-13)
        assert np.allclose(w, m.coefficients.toArray(), atol=2e-4), (reg, mix)
        assert abs(b - m.intercept) < 5e-3
    assert not w[3]
    flat = li.select("l_quantity", F.lit(5.0).alias("label"))
    w, b = wide_regression.elastic_net_from_moments(flat, ["l_quantity"], "label")
    assert list(w) == [0.0] and b == 5.0


def brute(edges, start, target):
    out = defaultdict(list)
    for a, b in edges:
        out[a].append(b)
    dist, level, expanded = {start: 0}, [start], 0
    while level:
        nxt = set()
        for a in level:
            expanded += len(out[a])
            nxt |= {b for b in out[a] if b not in dist}
        if target in nxt:
            hits = sum(b == target for a in level for b in out[a])
            return dist[level[0]] + 1, hits, expanded
        for b in nxt:
            dist[b] = dist[level[0]] + 1
        level = list(nxt)
    return None, 0, expanded


def test_meeting_against_brute_force(spark):
    draw = random.Random(5)
    n = 300
    edges = [(draw.randrange(n), draw.randrange(n)) for _ in range(900)] + [(5, 9), (5, 9)]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "src long, dst long").coalesce(2)
    fewer = 0
    for start, target in [(1, 250), (5, 9), (17, 17), (3, 1000), (40, 2)]:
        met = meeting.meet(df, start, target)
        distance, hits, expanded = brute(edges, start, target) if start != target else (None, 0, 0)
        assert (met.distance, met.hits) == (distance, hits), (start, target)
        fewer += distance is not None and distance > 2 and met.expanded < expanded
    assert fewer


def test_thousand_patterns_equal_like(spark):
    draw = random.Random(7)
    words = ["".join(draw.choice("abcde") for _ in range(draw.randrange(1, 6))) for _ in range(60)]
    lines = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(0, 12)))) for i in range(400)] + [(400, None), (401, ""), (402, "a%b_c" * 500)]
    wanted = [(k, [draw.choice(words)[:draw.randrange(1, 5)] for _ in range(draw.randrange(1, 4))]) for k in range(1000)]
    wanted += [(1000, []), (1001, None), (1002, ["", "%b"]), (1003, ["zzzz"]), (1004, ["aa", "aa"])]
    got = patterns.pattern_matches(spark.createDataFrame(lines, "id long, text string"), "id", "text",
                                   spark.createDataFrame(wanted, "p long, pieces array<string>"), "p", "pieces", patterns_per_block=300)
    want = []
    for k, pieces in wanted:
        for i, text in lines if any(pieces or []) else []:
            at = 0
            for piece in pieces:
                at = -1 if at < 0 or text is None or text.find(piece, at) < 0 else text.find(piece, at) + len(piece)
            if at >= 0 and text is not None:
                want.append((k, i))
    assert sorted((r["p"], r["id"]) for r in got.collect()) == sorted(want)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_ids_last(spark, tmp_path):
    ids = lasting_ids.IdTable(spark, str(tmp_path / "ids"), "v")
    assert ids.load(spark.createDataFrame([("b",), ("d",), (None,), ("b",)], "v string")) == 2
    first = {r.v: r.id for r in ids.read().collect()}
    assert first == {"b": 0, "d": 1}
    assert ids.load(spark.createDataFrame([("a",), ("d",), ("c",)], "v string")) == 2
    assert ids.load(spark.createDataFrame([("a",)], "v string")) == 0
    again = lasting_ids.IdTable(spark, str(tmp_path / "ids"), "v")
    for k in range(10):
        again.load(spark.createDataFrame([(f"n{k}",)], "v string"))
    now = {r.v: r.id for r in again.read().collect()}
    assert {v: now[v] for v in first} == first and now["a"] == 2 and sorted(now.values()) == list(range(14))
    coded = again.encode(spark.createDataFrame([("a", 1), ("x", 2), (None, 3)], "w string, k int"), "w", "wid")
    assert sorted((r.k, r.wid) for r in coded.collect()) == [(1, 2), (2, None), (3, None)]


@pytest.mark.parametrize("order", [1, -1])
def test_first_load_may_be_empty(spark, tmp_path, order):
    ids = lasting_ids.IdTable(spark, str(tmp_path / "ids"), "v")
    empty = spark.createDataFrame([], "v long")
    for df in [empty, spark.createDataFrame([(7,)], "v long")][::order]:
        ids.load(df)
    assert [(r.v, r.id) for r in ids.read().collect()] == [(7, 0)]


def test_patterns_summed_equal_the_matches(spark):
    draw = random.Random(11)
    words = ["".join(draw.choice("abé\U0001F600") for _ in range(draw.randrange(1, 5))) for _ in range(40)]
    lines = [(i, i % 7 if i % 11 else None, " ".join(draw.choice(words) for _ in range(draw.randrange(0, 9)))) for i in range(300)] + [(300, 1, None), (301, 1, "")]
    wanted = [(k, [draw.choice(words)[:3] for _ in range(draw.randrange(1, 5))]) for k in range(400)]
    wanted += [(400 + k, p) for k, (_, p) in enumerate(wanted[:50])] + [(900, None), (901, [""])]
    frames = spark.createDataFrame(lines, "id long, of long, text string"), spark.createDataFrame(wanted, "p long, pieces array<string>")
    args = frames[0], "id", "text", frames[1], "p", "pieces"
    want = {}
    for p, pieces in wanted:
        hits = [of for _, of, text in lines if pieces and any(pieces) and text is not None and patterns._in_order(text, pieces)]
        if hits:
            want[p] = len(hits), min([x for x in hits if x is not None], default=None)
    for per_block in (64, 200_000):
        got = patterns.pattern_matches(*args, patterns_per_block=per_block, least="of").collect()
        assert {r["p"]: (r["n"], r["least"]) for r in got} == want and len(got) == len(want)
    assert patterns.pattern_matches(frames[0], "id", "text", frames[1].limit(0), "p", "pieces", least="of").collect() == []
    assert patterns.pattern_matches(*args[:3], frames[1].limit(0), "p", "pieces").collect() == []
