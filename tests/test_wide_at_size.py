import numpy as np
from pyspark.sql import functions as F

from quarry.operators import recommend, wide_regression


def test_rows_of_the_same_indices_are_added_up(spark):
    draw = np.random.default_rng(1)
    rows = []
    for _ in range(900):
        k = draw.choice(6, size=draw.integers(0, 6), replace=True)
        rows.append(([int(x) for x in k], [float(x) for x in draw.normal(size=len(k))], float(draw.normal())))
    df = spark.createDataFrame(rows, "indices array<int>, values array<double>, label double")
    got, rounds = wide_regression.sgd_wide(df, 6, iterations=5, tol=0)
    x = np.zeros((len(rows), 6))
    for n, (k, v, _) in enumerate(rows):
        np.add.at(x[n], k, v)
    y, w = np.array([r[2] for r in rows]), np.zeros(6)
    for i in range(1, 6):
        s = wide_regression.SGD_STEP / i ** 0.5
        w = w * (1 - s * wide_regression.SGD_REG) - s * (x.T @ (x @ w - y)) / len(rows)
    assert rounds == 5 and np.allclose(got, w, atol=1e-12)
    single = df.where(F.size("indices") == 1)
    assert wide_regression._summed(single, 3).count() == single.select("indices").distinct().count() < single.count()
    looked = wide_regression.weights_of(spark.createDataFrame([(3,), (0,), (None,)], "k long"), "k", got)
    assert {r["k"]: r["weight"] for r in looked.collect()} == {3: got[3], 0: got[0]}


def test_more_ratings_take_no_more_blocks_than_they_fill(spark, monkeypatch):
    used = []

    class Als:
        def __init__(self, **args):
            used.append((args["numUserBlocks"], args["numItemBlocks"]))

        def fit(self, ratings):
            return None

    monkeypatch.setattr(recommend, "ALS", Als)
    for n in (1, 6_000_000, 201_000_000):
        few = spark.range(1).select(F.lit(1).alias("u"), F.lit(1).alias("i"), F.lit(1.0).alias("r"))
        monkeypatch.setattr(type(few), "count", lambda self: n)
        recommend.train_als(few, "u", "i", "r")
    assert used == [(10, 10), (4, 4), (5, 5)]


def test_blocks_of_small_executors(spark, monkeypatch):
    used = []

    class Als:
        def __init__(self, **args):
            used.append((args["numUserBlocks"], args["numItemBlocks"], args["checkpointInterval"]))

        def fit(self, ratings):
            return None

    monkeypatch.setattr(recommend, "ALS", Als)
    few = spark.range(1).select(F.lit(1).alias("u"), F.lit(1).alias("i"), F.lit(1.0).alias("r"))
    for n in (1, 6_000_000, 216_000_000):
        monkeypatch.setattr(type(few), "count", lambda self: n)
        recommend.train_als(few, "u", "i", "r", ratings_per_block=recommend.SMALL_EXECUTOR_RATINGS)
    assert used == [(10, 10, 10), (4, 4, 10), (22, 22, 2)]
