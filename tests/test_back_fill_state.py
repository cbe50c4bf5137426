"""Back-fills at size: state outside the heap, neighbouring panes in one state row, panes shuffled once."""

import os
from collections import Counter

from pyspark.sql import functions as F

from quarry import session
from quarry.streaming import windows


def _words(spark):
    """Words at seconds before and after the epoch, some without a time or a word."""
    rows = [(s, w) for s in range(-50, 400, 3) for w in ("a", f"r{s % 7}", None)] + [(None, "a")]
    return spark.createDataFrame(rows, "s long, word string").select(F.timestamp_micros(F.col("s") * 1_000_000).cast("timestamp_ntz").alias("ts"), "s", "word")


def _expected(rows, slide):
    return Counter((r.s // slide, r.word) for r in rows if r.s is not None)


def _start(spark, words, folder):
    """A back-fill of 2 s panes over four files in any order, one per micro-batch."""
    words.repartition(4).write.parquet(folder)
    stream = windows.table_stream(spark, folder, words.schema, files_per_trigger=1)
    query, base = windows.start_to_folder(windows.stream_pane_counts(stream, "ts", ["word"], 2, watermark=None, value=F.col("s")), "packed", trigger_s=None)
    query.awaitTermination()
    return query, base


def test_back_fill_keeps_its_state_outside_the_heap(spark, tmp_path):
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    words = _words(spark)
    query, base = _start(spark, words, str(tmp_path / "words.parquet"))
    assert spark.conf.get(store) == before
    metrics = [op["customMetrics"] for p in query.recentProgress for op in p["stateOperators"]]
    assert len(query.recentProgress) >= 4 and all("rocksdbPutCount" in m for m in metrics)
    rows = words.collect()
    want = _expected(rows, 2)
    # a batch writes fewer state rows than it has panes
    assert sum(m["rocksdbPutCount"] for m in metrics) < len(want)
    totals = Counter()
    for r in rows:
        if r.s is not None:
            totals[r.s // 2, r.word] += r.s
    got = windows.read_folder(spark, base, ["word"]).select(
        (F.unix_micros(F.col("window_start").cast("timestamp")) / 2_000_000).cast("long").alias("p"),
        (F.unix_micros(F.col("window_end").cast("timestamp")) / 2_000_000).cast("long").alias("q"), "word", "n", "total").collect()
    assert {(r.p, r.word): (r.n, r.total) for r in got} == {k: (n, totals[k]) for k, n in want.items()}
    assert len(got) == len(want) and all(r.q == r.p + 1 for r in got)


def test_few_windows_per_pane_shuffle_panes_not_copies(spark):
    words = _words(spark)
    panes = [(p, w, n) for (p, w), n in _expected(words.collect(), 2).items()]
    panes += panes[:5]                                       # a pane given in two parts
    df = spark.createDataFrame(panes, "_pane long, word string, _c long")
    got = windows._windows_from_panes(df, ["word"], 10, 2, ["_c"])
    want = Counter()
    for p, w, n in panes:
        for j in range(5):
            want[p - j, w] += n
    assert Counter({(r._w, r.word): r._c for r in got.collect()}) == want
    assert got.count() == len(want)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    above, below = plan.split("Exchange hashpartitioning")   # the only one: panes are dealt before they meet their windows
    assert "HashAggregate" in above and "HashAggregate" not in below
    final = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 1


def test_panes_are_seldom_sent_twice_and_the_checkpoint_goes(spark, tmp_path):
    panes = [(p, f"w{p % 3}", 1 + p % 4) for p in range(-90, 90)]
    df = spark.createDataFrame(panes, "_pane long, word string, _c long").repartition(2)
    got = windows._windows_from_panes(df, ["word"], 10, 2, ["_c"])
    want = Counter()
    for p, w, n in panes:
        for j in range(5):
            want[p - j, w] += n
    assert Counter({(r._w, r.word): r._c for r in got.collect()}) == want
    below = got._jdf.queryExecution().sparkPlan().toString().split("Exchange hashpartitioning")[1]
    assert "_d#" in below and "_b#" not in below              # copied to their blocks after the shuffle
    words = _words(spark)
    words.write.parquet(str(tmp_path / "words.parquet"))
    stream = windows.table_stream(spark, str(tmp_path / "words.parquet"), words.schema)
    before = len(session._scratch)
    table = windows.run_to_table(windows.stream_pane_counts(stream, "ts", ["word"], 2, watermark=None), ["word"], "packed")
    assert table.count() == len(_expected(words.collect(), 2))
    assert [os.listdir(p) for p in session._scratch[before:]] == [["out"]]
