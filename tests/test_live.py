"""Supported pairs, band joins, the message log, and streams that forget, rank, compact and restart."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import bands, pair_support, similarity
from quarry.plans import live_queries
from quarry.plans.tables import ratings, table
from quarry.sources.batch_table import BatchTable
from quarry.streaming import inverse_window, message_log, ranked, windows
from tests.conftest import SF_SMALL

WINDOW = ["window_start", "window_end", "event_type", "n"]


def rows_of(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("buckets,chunk", [(1 << 16, 2000), (7, 2000), (64, 5)])
def test_supported_pairs_lose_nothing(spark, buckets, chunk):
    r = ratings(spark, SF_SMALL, "l_partkey")
    r = r.unionByName(r.where("item_id % 3 = 0"))  # repeated ratings count as often
    report = {}
    got = pair_support.supported_pairs(r, "user_id", "item_id", "rating", 12, buckets=buckets, chunk_items=chunk, report=report)
    every = similarity.item_similarity(r, "user_id", "item_id", "rating")
    cols = ["item1", "item2", "n", "score"]
    want = every.where("n > 12").select("item1", "item2", "n", F.round("score", 9).alias("score"))
    assert rows_of(got.withColumn("score", F.round("score", 9)), cols) == rows_of(want, cols)
    assert report["aggregated"] <= report["counted"] <= report["all_pairs"]
    if buckets > 1000:
        assert report["aggregated"] < report["all_pairs"] * 0.6
    assert pair_support.supported_pairs(r.limit(0), "user_id", "item_id", "rating", 4).collect() == []


def test_band_join_against_brute_force(spark):
    draw = random.Random(3)
    a = [(i, draw.choice([draw.uniform(0, 5000), draw.uniform(1000, 1010), 2000.0])) for i in range(600)]
    b = [(i, draw.choice([draw.uniform(0, 5000), draw.uniform(1000, 1010), 2003.0])) for i in range(500)]

    def frame(rows, name):
        stamp = F.timestamp_micros((F.col("s") * 1_000_000).cast("long"))
        df = spark.createDataFrame([*rows, (-1, None)], f"{name} long, s double")
        return df.select(name, F.when(F.col("s").isNotNull(), stamp).alias(f"t{name}")).repartition(3)
    want = sorted((i, j) for i, s in a for j, t in b if abs(int(s * 1e6) - int(t * 1e6)) <= 3_000_000)
    for ranges, cell in ((16, 40), (1, None), (512, 7)):
        got = bands.band_join(frame(a, "x"), frame(b, "y"), "tx", "ty", 3, ranges, cell)
        assert got.columns == ["x", "tx", "y", "ty"]
        assert rows_of(got, ["x", "y"]) == want
    assert bands.band_join(frame(a, "x").limit(0), frame(b, "y"), "tx", "ty", 3).collect() == []


def test_stream_band_join_equals_batch(spark, tmp_path):
    ev = table(spark, SF_SMALL, "events")
    for kind in ("purchase", "click"):
        ev.where(F.col("event_type") == kind).repartition(2).write.parquet(str(tmp_path / kind))

    def stream(kind, ts, name):
        s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / kind))
        return s.select(F.col("event_id").alias(name), F.col("ts").alias(ts))
    joined = bands.stream_band_join(stream("purchase", "ta", "x"), stream("click", "tb", "y"), "ta", "tb", 3600, "60 days", "60 days")
    q = (joined.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    sides = [ev.where(F.col("event_type") == k).select(F.col("event_id").alias(n), F.col("ts").alias(t)) for k, t, n in (("purchase", "ta", "x"), ("click", "tb", "y"))]
    got, want = spark.read.parquet(str(tmp_path / "out")), bands.band_join(*sides, "ta", "tb", 3600)
    assert rows_of(got, ["x", "y"]) == rows_of(want, ["x", "y"]) != []


def test_message_log_offsets_and_replay(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.range(1000).select("id", F.concat(F.lit("m"), "id").alias("text"))
    assert message_log.append(rows.where("id < 400"), log, 3, order="id") == 400
    assert message_log.append(rows.where("id >= 400"), log, 3) == 600
    reader = message_log.MessageLog({"path": log, "rows_per_task": "50"}).streamReader(rows.schema)
    end = reader.latestOffset()
    assert sum(end.values()) == 1000 and reader.initialOffset() == {} and reader.partitions(end, end) == []
    slices = reader.partitions({}, end)
    assert max(s.high - s.low for s in slices) <= 50 and len(slices) > 20
    read = [i for s in slices for b in reader.read(s) for i in b.column("id").to_pylist()]
    assert sorted(read) == list(range(1000))
    assert [i for s in reader.partitions({}, end) for b in reader.read(s) for i in b.column("id").to_pylist()] == read
    middle = {p: n // 2 for p, n in end.items()}
    halves = [[i for s in reader.partitions(a, b) for x in reader.read(s) for i in x.column("id").to_pylist()] for a, b in (({}, middle), (middle, end))]
    assert sorted(halves[0] + halves[1]) == list(range(1000))
    assert message_log.committed(log) == {}
    late = message_log.MessageLog({"path": log, "startingOffsets": "latest"}).streamReader(rows.schema)
    assert late.initialOffset() == end


def test_state_forgets_and_survives_a_restart(spark, tmp_path):
    session = inverse_window.state_session(spark)
    log, base = str(tmp_path / "log"), str(tmp_path)
    events = table(spark, SF_SMALL, "events")
    held, dropped = [], 0
    parts = [*live_queries._parts_by_time(events), live_queries._quiet(events), live_queries._quiet(events, "INTERVAL 2 DAYS")]
    for part in parts:
        message_log.append(part, log, 4, order="ts")
        runs = inverse_window.forgetting_counts(message_log.log_stream(session, log, events.schema), "ts", ["user_id"], 300, 2)
        q = (runs.writeStream.format("parquet").option("checkpointLocation", f"{base}/ck").outputMode("append").trigger(availableNow=True).start(f"{base}/out"))
        q.awaitTermination()
        held.append(q.recentProgress[-1].stateOperators[0].numRowsTotal)
        dropped += windows.dropped_rows(q)
    assert max(held) > 0 and held[-1] == 0 and dropped == 0
    got = inverse_window.runs_to_windows(spark.read.parquet(f"{base}/out"), ["user_id"])
    want = windows.sliding_counts(events, "ts", ["user_id"], 300, 2)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()


def test_counter_settles_each_window_once():
    c = inverse_window.Counter()
    for pane, n in ((10, 2), (12, 1), (30, 5)):
        c.enter(pane, n, 3)
    first = list(c.settle(11))
    c = inverse_window.Counter(c.bytes())
    runs = first + list(c.settle(40))
    counts = {w: n for a, z, n in runs for w in range(a, z)}
    assert counts == {8: 2, 9: 2, 10: 3, 11: 1, 12: 1, 28: 5, 29: 5, 30: 5} and sum(z - a for a, z, _ in runs) == len(counts)
    assert c.next_change is None and c.count == 0


class Killed(Exception):
    pass


def test_ranking_after_every_batch_and_after_a_crash(spark, tmp_path):
    session = inverse_window.state_session(spark)
    log, base = str(tmp_path / "log"), str(tmp_path)
    events = table(spark, SF_SMALL, "events")
    ranking = ranked.RunningTopK(spark, f"{base}/r", ["event_type"], "event_type", 2, 300, 60, delay_s=60, fan_out=2)
    cols = ["window_start", "window_end", "event_type", "n", "rank"]
    read = events.limit(0)
    for k, part in enumerate(live_queries._parts_by_time(events, 4)):
        message_log.append(part, log, 2, order="ts")
        read = read.unionByName(part)

        def start(fn):
            panes = windows.stream_pane_counts(message_log.log_stream(session, log, events.schema), "ts", ["event_type"], 60, watermark="60 seconds")
            return (windows._flat(panes).writeStream.outputMode("update").option("checkpointLocation", f"{base}/ck").foreachBatch(fn)
                    .trigger(availableNow=True).start())
        if k == 2:  # the batch is written, and the query dies before Spark knows
            def killed(batch, number):
                ranking(batch, number)
                raise Killed
            with pytest.raises(Exception, match="Killed"):
                start(killed).awaitTermination()
        start(ranking).awaitTermination()
        want = windows.window_top_k(windows.sliding_counts(read, "ts", ["event_type"], 300, 60), 2, "event_type")
        assert rows_of(ranking.read(), cols) == rows_of(want, cols)


def test_batch_table_merges_and_ignores_repeats(spark, tmp_path):
    t = BatchTable(spark, str(tmp_path / "t"), ["window_end", "k"], "window_end", delay_s=20, fan_out=3)
    assert t.read() is None
    want = {}
    most = 0
    for number in range(40):
        rows = [(number * 10 - back, k, number) for back in (0, 10, 20) for k in range(2)]
        df = spark.createDataFrame(rows, "s long, k int, v long").select(F.timestamp_seconds("s").cast("timestamp_ntz").alias("window_end"), "k", "v").coalesce(1)
        assert t.write(df, number)
        want.update({(s, k): v for s, k, v in rows})
        if number % 13 == 5:
            assert not t.write(df.withColumn("v", F.lit(-1).cast("long")), number)  # a repeated batch changes nothing
        most = max(most, len(t.manifest()["folders"]))
        if number in (0, 7, 26, 39):
            got = t.read().select(F.unix_micros(F.col("window_end").cast("timestamp")).alias("s"), "k", "v")
            assert {(r.s // 1_000_000, r.k): r.v for r in got.collect()} == want and got.count() == len(want)
    assert most <= 16 and any(f["closed"] for f in t.manifest()["folders"])
    early = t.read(F.col("window_end") < F.timestamp_seconds(F.lit(50)).cast("timestamp_ntz"))
    assert early.count() == sum(s < 50 for s, _ in want)
