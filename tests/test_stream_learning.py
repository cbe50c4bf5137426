"""Stream = batch, window semantics, and the learning operators."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import recommend, regression
from quarry.plans.tables import table
from quarry.streaming import windows
from tests.conftest import SF_SMALL


def rows_of(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_pane_counts_equal_window_function(spark):
    ev = table(spark, SF_SMALL, "events")
    panes = windows.sliding_counts(ev, "ts", ["event_type"], 300, 2)
    direct = (ev.groupBy(F.window(F.col("ts").cast("timestamp"), "300 seconds", "2 seconds").alias("w"),
                         "event_type").count()
              .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), "event_type",
                      F.col("count").alias("n")))
    cols = ["window_start", "window_end", "event_type", "n"]
    assert rows_of(panes, cols) == rows_of(direct, cols)
    uneven = windows.sliding_counts(ev, "ts", ["event_type"], 300, 7)    # falls back to window()
    assert uneven.count() > 0


def test_stream_equals_batch(spark):
    schema = table(spark, SF_SMALL, "events").schema
    stream = windows.file_stream(spark, SF_SMALL, schema, glob="events.parquet")
    panes = windows.run_to_table(windows.stream_pane_counts(stream, "ts", ["event_type"]), ["event_type"], "t")
    streamed = windows.panes_to_windows(panes, ["event_type"])
    batch = windows.sliding_counts(table(spark, SF_SMALL, "events"), "ts", ["event_type"])
    cols = ["window_start", "window_end", "event_type", "n"]
    assert rows_of(streamed, cols) == rows_of(batch, cols)
    # direct window() form, complete picture in update mode as well
    stream2 = windows.file_stream(spark, SF_SMALL, schema, glob="events.parquet")
    direct = windows.run_to_table(windows.stream_sliding_counts(stream2, "ts", ["event_type"]),
                                  ["event_type"], "t2")
    assert rows_of(direct, cols) == rows_of(batch, cols)


def test_stream_late_rows_dropped_by_watermark(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "ts timestamp_ntz, word string"
    first = spark.createDataFrame([("2024-01-01 00:10:00", "a"), ("2024-01-01 00:10:01", "b")], "t string, word string")
    first.select(F.col("t").cast("timestamp_ntz").alias("ts"), "word").write.parquet(str(folder / "b0"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .parquet(str(folder / "*")))
    counts = windows.stream_pane_counts(stream, "ts", ["word"], slide_s=2, watermark="1 minute")
    base = str(tmp_path / "out")
    from quarry.sources.sinks import batch_dirs_writer, read_batch_dirs
    flat = counts.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "word", "n")
    q = (flat.writeStream.outputMode("update").option("checkpointLocation", base + "/ck")
         .foreachBatch(batch_dirs_writer(base + "/o")).trigger(availableNow=True).start())
    q.awaitTermination()
    late = spark.createDataFrame([("2024-01-01 00:00:00", "late"), ("2024-01-01 00:20:00", "c")],
                                 "t string, word string")
    late.select(F.col("t").cast("timestamp_ntz").alias("ts"), "word").write.parquet(str(folder / "b1"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "*")))
    counts = windows.stream_pane_counts(stream, "ts", ["word"], slide_s=2, watermark="1 minute")
    flat = counts.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "word", "n")
    q = (flat.writeStream.outputMode("update").option("checkpointLocation", base + "/ck")
         .foreachBatch(batch_dirs_writer(base + "/o")).trigger(availableNow=True).start())
    q.awaitTermination()
    words = {r.word for r in read_batch_dirs(spark, base + "/o", ["window_start", "word"]).collect()}
    assert words == {"a", "b", "c"}     # the row 10 minutes behind the watermark is dropped


def test_sliding_mean_empty_window_is_null(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01", "ab")], "t string, s string") \
        .select(F.col("t").cast("timestamp_ntz").alias("ts"), "s")
    out = windows.sliding_int_mean(df, "ts", F.length("s"), 8, 4)
    assert {r.int_mean for r in out.collect()} == {2}


def test_sgd_matches_row_by_row_recurrence(spark):
    li = table(spark, SF_SMALL, "lineitem").select((F.col("l_tax") * 10).alias("x"),
                                                  F.col("l_quantity").alias("y"))
    w, rounds = regression.sgd_ridge(li, ["x"], "y")
    pdf = li.toPandas()
    x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy()
    ww, prev, r_brute = 0.0, None, 0
    for i in range(1, 101):
        grad = sum((ww * xi - yi) * xi for xi, yi in zip(x, y)) / len(x)
        s = 1.0 / math.sqrt(i)
        ww = ww * (1 - s * 0.01) - s * grad
        r_brute = i
        if prev is not None and abs(prev - ww) < 0.001 * max(abs(ww), 1.0):
            break
        prev = ww
    assert rounds == r_brute
    assert abs(w[0] - ww) < 1e-9 * max(1.0, abs(ww))


def test_sgd_two_features_and_scaling(spark):
    li = table(spark, SF_SMALL, "lineitem").select((F.col("l_tax") * 10).alias("a"), F.col("l_discount").alias("b"),
                                                  F.col("l_quantity").alias("y"))
    w, rounds = regression.sgd_ridge(li, ["a", "b"], "y")
    assert w.shape == (2,) and 1 <= rounds <= 100
    scaled = regression.scale(regression.assemble(li, ["a", "b"]))
    from pyspark.ml.functions import vector_to_array
    stats = scaled.select(vector_to_array("scaled")[0].alias("s")).agg(F.avg("s"), F.stddev("s")).first()
    assert abs(stats[0]) < 1e-9 and abs(stats[1] - 1) < 1e-9


def test_elastic_net_ols_matches_regr_slope(spark):
    li = table(spark, SF_SMALL, "lineitem").select(F.col("l_quantity").alias("x"),
                                                  F.col("l_extendedprice").alias("label"))
    model = regression.elastic_net(regression.assemble(li, ["x"]), reg=0.0, mix=0.0)
    ref = li.agg(F.regr_slope("label", "x").alias("s"), F.regr_intercept("label", "x").alias("i")).first()
    assert abs(model.coefficients[0] - ref["s"]) < 1e-6 * abs(ref["s"])
    assert abs(model.intercept - ref["i"]) < 1e-4 * max(1.0, abs(ref["i"]))
    train, test = regression.hash_split(li.withColumn("k", F.monotonically_increasing_id()), ["k"])
    assert train.count() + test.count() == li.count()


def test_als_repeatable_and_better_than_mean(spark):
    from quarry.plans.tables import ratings
    r = ratings(spark, SF_SMALL, item="l_partkey")
    m1 = recommend.train_als(r, "user_id", "item_id", "rating", max_iter=5)
    m2 = recommend.train_als(r, "user_id", "item_id", "rating", max_iter=5)
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    a = recommend.recommend_for_users(m1, users, 10).collect()
    b = recommend.recommend_for_users(m2, users, 10).collect()
    assert [(x.user, x.item) for x in a] == [(x.user, x.item) for x in b]
    assert {x.user: 0 for x in a} and all(sum(1 for x in a if x.user == u) == 10 for u in {x.user for x in a})
    pred = m1.transform(r.select(F.col("user_id").cast("int").alias("user_id"),
                                 F.col("item_id").cast("int").alias("item_id"), "rating"))
    rmse = math.sqrt(pred.agg(F.avg((F.col("prediction") - F.col("rating")) ** 2)).first()[0])
    mean = r.agg(F.avg("rating")).first()[0]
    base = math.sqrt(r.agg(F.avg((F.col("rating") - mean) ** 2)).first()[0])
    assert rmse < base
    none = recommend.recommend_for_users(m1, spark.createDataFrame([(10 ** 8,)], "user_id int"), 10)
    assert none.count() == 0


def test_stream_without_input_gives_empty_table(spark, tmp_path):
    folder = tmp_path / "empty"
    folder.mkdir()
    stream = windows.file_stream(spark, str(folder), table(spark, SF_SMALL, "events").schema)
    out = windows.run_to_table(windows.stream_pane_counts(stream, "ts", ["event_type"]), ["event_type"], "e")
    assert out.count() == 0 and "n" in out.columns


def test_change_points_match_fan_out_with_tiny_buckets(spark, monkeypatch):
    """Exercise bucket carry-over: buckets as narrow as the window."""
    ev = table(spark, SF_SMALL, "events")
    cols = ["window_start", "window_end", "event_type", "n"]
    monkeypatch.setattr(windows, "FAN_OUT_MAX", 10 ** 6)
    fanned = rows_of(windows.sliding_counts(ev, "ts", ["event_type"], 600, 20), cols)
    monkeypatch.setattr(windows, "FAN_OUT_MAX", 1)
    monkeypatch.setattr(windows, "BUCKET_SLIDES", 1)         # raised to k = 30 inside
    bucketed = rows_of(windows.sliding_counts(ev, "ts", ["event_type"], 600, 20), cols)
    assert fanned == bucketed
    m_cols = ["window_start", "total", "n", "int_mean"]
    a = rows_of(windows.sliding_int_mean(ev, "ts", F.length("props"), 300, 4), m_cols)
    monkeypatch.setattr(windows, "FAN_OUT_MAX", 10 ** 6)
    b = rows_of(windows.sliding_int_mean(ev, "ts", F.length("props"), 300, 4), m_cols)
    assert a == b


def test_processing_time_trigger_and_console(spark, tmp_path):
    import time as _time
    folder = tmp_path / "live"
    folder.mkdir()
    ev = table(spark, SF_SMALL, "events")
    ev.where("event_id < 200").write.parquet(str(folder / "f0"))
    stream = windows.file_stream(spark, str(folder / "*"), ev.schema)
    q, base = windows.start_to_folder(windows.stream_pane_counts(stream, "ts", ["event_type"]), "live", trigger_s=1)
    try:
        q.processAllAvailable()
        first = windows.read_folder(spark, base, ["event_type"]).agg(F.sum("n")).first()[0]
        ev.where("event_id >= 200 AND event_id < 500").write.parquet(str(folder / "f1"))   # later rows
        deadline = _time.time() + 60
        total = first
        while total != 500 and _time.time() < deadline:
            q.processAllAvailable()
            total = windows.read_folder(spark, base, ["event_type"]).agg(F.sum("n")).first()[0]
        assert first == 200 and total == 500
    finally:
        q.stop()
    stream2 = windows.file_stream(spark, str(folder / "*"), ev.schema)
    c = windows.start_console(windows.stream_pane_counts(stream2, "ts", ["event_type"]), rows=3, trigger_s=1)
    try:
        c.processAllAvailable()
        assert c.isActive
    finally:
        c.stop()


def test_sgd_equals_mllib_sgd(spark):
    """Moments form vs Spark's own full-batch SGD with the squared-L2 updater
    (the RDD API appears only here, as the reference implementation)."""
    import warnings

    from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD
    li = table(spark, SF_SMALL, "lineitem").select((F.col("l_tax") * 10).alias("x"),
                                                  F.col("l_quantity").alias("y"))
    w, _ = regression.sgd_ridge(li, ["x"], "y")
    points = li.rdd.map(lambda r: LabeledPoint(r.y, [r.x]))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        model = LinearRegressionWithSGD.train(points, iterations=100, step=1.0, miniBatchFraction=1.0,
                                              regParam=0.01, regType="l2", intercept=False)
    assert abs(model.weights[0] - w[0]) < 1e-9 * max(1.0, abs(w[0]))


def test_back_fill_of_a_folder_counts_every_row(spark, tmp_path):
    """Part files in any order, one per micro-batch: no row is late in a back-fill."""
    ev = table(spark, SF_SMALL, "events")
    folder = tmp_path / "events.parquet"
    ev.repartition(4).write.parquet(str(folder))
    stream = windows.table_stream(spark, str(folder), ev.schema, files_per_trigger=1)
    panes = windows.run_to_table(windows.stream_pane_counts(stream, "ts", ["event_type"], watermark=None),
                                 ["event_type"], "folder")
    assert panes.agg({"n": "sum"}).first()[0] == ev.count()
    stream = windows.table_stream(spark, str(folder), ev.schema, files_per_trigger=1)
    panes = windows.run_to_table(windows.stream_pane_counts(stream, "ts", [], windows.MEAN_SLIDE_S, watermark=None,
                                                            value=F.length("props")), [], "means")
    cols = ["window_start", "total", "n", "int_mean"]
    assert rows_of(windows.panes_to_means(panes), cols) == rows_of(windows.sliding_int_mean(ev, "ts", F.length("props")), cols)
    with pytest.raises(FileNotFoundError):
        windows.table_stream(spark, str(tmp_path / "none.parquet"), ev.schema)


def test_moments_leave_incomplete_rows_out(spark):
    from quarry.operators.regression import moments
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0), (None, 5.0), (2.0, None)], "x double, y double")
    n, xtx, xty = moments(df, ["x"], "y")
    assert (n, xtx[0, 0], xty[0]) == (2, 10.0, 14.0)
