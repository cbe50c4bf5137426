import numpy as np
import pytest

from quarry.operators.recommend import train_als
from quarry.operators.top_products import recommend_for_all, top_products
from quarry.plans.tables import ratings

SF_SMALL = "/root/testdata/sf0.001"


def brute(users, items, n):
    out = {}
    for u, a in users:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in items)
        out[u] = [(i, -s) for s, i in scored[:n]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["user"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["user"], [])) + 1
        out[r["user"]].append((r["item"], r["score"]))
    return out


def frames(spark, users, items):
    return (spark.createDataFrame(users, "u bigint, a array<double>"), spark.createDataFrame(items, "i string, b array<double>"))


@pytest.mark.parametrize("block", [3, 16, 4096])
def test_equal_to_all_products(spark, block):
    rng = np.random.default_rng(3)
    sizes = rng.pareto(1.2, 200) + 0.1
    items = [(f"i{k:03}", [float(x) for x in np.round(rng.normal(size=4) * s, 2)]) for k, s in enumerate(sizes)]
    items += [(f"t{k}", items[5][1]) for k in range(30)] + [("zero", [0.0] * 4)]  # ties that pass n, and a zero vector
    users = [(k, [float(x) for x in np.round(rng.normal(size=4), 2)]) for k in range(60)] + [(100, [0.0] * 4)]
    want = brute(users, items, 7)
    odd_users, odd_items = [(None, [1.0] * 4), (7000, None), (7001, [1.0, None, 1.0, 1.0])], [(None, [9e9] * 4), ("x", None), ("y", [None] * 4)]
    out = top_products(*frames(spark, users + odd_users, items + odd_items), 7, "u", "a", "i", "b", block_items=block)
    got = found(out)
    assert got.keys() == want.keys()
    for u in want:
        assert [i for i, _ in got[u]] == [i for i, _ in want[u]], u
        assert [s for _, s in got[u]] == pytest.approx([s for _, s in want[u]])
    if block < 4096:  # long vectors come first, so that most users stop early
        scored = out.groupBy("user").max("scored").collect()
        assert sum(r[1] for r in scored) < 0.8 * len(users) * len(items)


def test_few_items_and_empty_frames(spark):
    users, items = [(1, [1.0]), (2, [-1.0])], [("a", [2.0]), ("b", [1.0])]
    got = found(top_products(*frames(spark, users, items), 5, "u", "a", "i", "b", block_items=1))
    assert got == {1: [("a", 2.0), ("b", 1.0)], 2: [("b", -1.0), ("a", -2.0)]}
    for u, i in (([], items), (users, [])):
        assert top_products(*frames(spark, u, i), 5, "u", "a", "i", "b").collect() == []


def test_equal_to_recommendations_of_als(spark):
    model = train_als(ratings(spark, SF_SMALL, "l_partkey"), "user_id", "item_id", "rating", rank=4, max_iter=3)
    got = found(recommend_for_all(model, 4, block_items=16))
    want = {r["user_id"]: [float(x["rating"]) for x in r["recommendations"]] for r in model.recommendForAllUsers(4).collect()}
    assert got.keys() == want.keys()
    for u in want:
        assert [s for _, s in got[u]] == pytest.approx(want[u], rel=1e-4, abs=1e-4)


def test_items_of_about_one_length_are_not_all_compared(spark):
    rng = np.random.default_rng(8)
    items = [(f"i{k:04}", [float(x) for x in rng.normal(50, 5, size=6)]) for k in range(900)]
    users = [(k, [float(x) for x in rng.poisson(1.0, size=6)]) for k in range(80)]
    out = top_products(*frames(spark, users, items), 3, "u", "a", "i", "b", block_items=8)
    got, want = found(out), brute(users, items, 3)
    assert {u: [i for i, _ in rows] for u, rows in got.items()} == {u: [i for i, _ in rows] for u, rows in want.items()}
    # by their norms alone hardly any user would stop before the last round
    assert sum(r[1] for r in out.groupBy("user").max("scored").collect()) < 0.7 * len(users) * len(items)
