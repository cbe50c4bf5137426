"""Sliding-window counts and means (W1-W8), batch and Structured Streaming.

Batch form (``sliding_counts``, ``sliding_int_mean``): when the window is a
multiple of the slide, rows are first aggregated into slide-wide *panes*
(one partial aggregate per pane and key).  Each pane then becomes two change
points (enter / leave), and a running sum over the ordered change points of a
key, split into time buckets, yields every non-empty window exactly once
(``_windows_from_panes``).  ``window()`` instead copies each row into
``window / slide`` windows (150 at 300 s / 2 s) and aggregates the copies.

Streaming form: the stateful aggregate keeps slide-wide tumbling panes with a
watermark (``stream_pane_counts``), written per micro-batch to ``batch_id=N``
folders by ``foreachBatch`` (idempotent on retry) in update mode; reading back
keeps each pane's row from the latest batch and adds panes up to sliding
windows.  A back-fill, which never closes a pane, has its state in RocksDB and keeps
neighbouring panes of a key in one state row (``_packed_pane_counts``).  ``stream_sliding_counts`` is the direct ``window()`` form (150 state
rows per event at 300 s / 2 s), kept for comparison.

Windows are aligned to the epoch (the reference's processing-time windows were
aligned to job start); a key whose count drops to zero simply has no row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.sinks import batch_dirs_writer, read_batch_dirs
from quarry.functions.text import int_div_mean
from quarry.session import delete_path, scratch_path

# The reference's micro-batch and window settings (seconds).
BATCH_INTERVAL_S = 2
COUNT_WINDOW_S = 300
COUNT_SLIDE_S = 2
MEAN_WINDOW_S = 300
MEAN_SLIDE_S = 4

# State of pane counts: in RocksDB, whose stores share one bounded memory in each executor
# and spill to its disk; a micro-batch writes its changes only.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}

# Panes of one key that share a state row in a back-fill.
PANES_PER_ROW = 16


def _micros(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def _ntz(micros: Column) -> Column:
    return F.timestamp_micros(micros).cast("timestamp_ntz")


# Up to this many windows per pane, panes are simply added to their windows.
FAN_OUT_MAX = 16
# Blocks of windows that such panes are shuffled to at once: few panes lie at an edge and are sent twice.
DEALT_BLOCKS = 16
# Width, in slides, of the time buckets the change-point pass is split into.
# Must be at least window/slide (checked below).
BUCKET_SLIDES = 4096


def _windows_from_panes(panes: DataFrame, keys: list[str], window_s: int, slide_s: int,
                        measures: list[str]) -> DataFrame:
    """Sliding-window sums of integral pane ``measures`` (the first one is a
    positive row count) without copying every pane to every window.

    A pane ``p`` adds its measures to windows ``p-k+1 .. p`` (``k`` =
    window/slide): a ``+m`` change at ``p-k+1`` and a ``-m`` change at ``p+1``.
    Change points are summed per key and time, split into buckets of
    ``BUCKET_SLIDES`` slides (each bucket gets the sum of all earlier buckets as
    carry-in, which also covers the stretch before its first change point), and
    within a bucket a running sum over the ordered change points gives the value
    of every window up to the next change point.  Windows with a positive count are emitted once
    each, so there is no aggregation over ``panes x k`` rows, and no task holds
    more than one bucket of one key.  For ``k <= FAN_OUT_MAX`` the panes are
    added to their windows instead (cheaper with many sparse keys): windows go by
    blocks of ``k``, a pane meets one or two of them, and one row per key and
    block sums each of its windows in a column.  Panes are shuffled to
    ``DEALT_BLOCKS`` neighbouring blocks at once and copied to the blocks there.
    """
    from pyspark.sql import Window

    k = window_s // slide_s
    if k <= FAN_OUT_MAX:
        # shuffled once on (key, blocks), as panes; the aggregate reuses that partitioning
        first, last = F.col("_pane") - (k - 1), F.col("_pane")
        wide = k * DEALT_BLOCKS
        dealt = (panes.withColumn("_d", F.explode(F.sequence(F.floor(first / wide), F.floor(last / wide))))
                 .repartition(*keys, "_d"))
        start = F.col("_d") * DEALT_BLOCKS
        dealt = dealt.withColumn("_b", F.explode(F.sequence(F.greatest(F.floor(first / k), start),
                                                            F.least(F.floor(last / k), start + (DEALT_BLOCKS - 1)))))
        windows = [F.col("_b") * k + j for j in range(k)]
        blocks = dealt.groupBy(*keys, "_d", "_b").agg(*[
            F.sum(F.when(w.between(first, last), F.col(m))).alias(f"_{m}_{j}") for j, w in enumerate(windows) for m in measures])
        each = F.explode(F.array(*[F.struct(*[F.col(f"_{m}_{j}").alias(m) for m in measures], w.alias("_w")) for j, w in enumerate(windows)]))
        return blocks.select(*keys, each.alias("_s")).where(F.col(f"_s.{measures[0]}").isNotNull()).select(*keys, "_s.*")
    bw = max(BUCKET_SLIDES, k)
    sums = [F.col(m) for m in measures]
    # Change points, shuffled once on (key, bucket): the aggregate and the
    # running-sum window below both reuse that partitioning.
    changes = (panes.select(*keys, F.explode(F.array(
        F.struct((F.col("_pane") - (k - 1)).alias("t"), *[c.alias(m) for c, m in zip(sums, measures)]),
        F.struct((F.col("_pane") + 1).alias("t"), *[(-c).alias(m) for c, m in zip(sums, measures)]),
    )).alias("d")).select(*keys, "d.*")
        .withColumn("_b", F.floor(F.col("t") / bw))
        .repartition(*keys, "_b")
        .groupBy(*keys, "_b", "t").agg(*[F.sum(m).alias(m) for m in measures]))
    # carry-in per (key, bucket): everything that changed in earlier buckets
    # (one row per bucket and key: small, joined back by broadcast when AQE sees it is)
    totals = changes.groupBy(*keys, "_b").agg(*[F.sum(m).alias(m) for m in measures])
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, "_b", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_carry_{m}")
                                         for m in measures])
    w = Window.partitionBy(*keys, "_b").orderBy("t")
    running = changes.join(carry, [*keys, "_b"]).select(
        *keys, "_b", "t",
        F.lag("t").over(w).alias("_prev"),
        F.coalesce(F.lead("t").over(w), (F.col("_b") + 1) * bw).alias("_next"),
        *[F.col(f"_carry_{m}").alias(f"_carry_{m}") for m in measures],
        *[(F.col(f"_carry_{m}") + F.sum(m).over(w.rowsBetween(Window.unboundedPreceding, 0))).alias(m)
          for m in measures])
    # each change point covers [t, next); the first one of a bucket also covers
    # [bucket start, t) with the carried-in value
    segs = running.select(*keys, F.explode(F.array(
        F.struct(F.col("t").alias("a"), F.col("_next").alias("z"), *[F.col(m).alias(m) for m in measures]),
        F.struct((F.col("_b") * bw).alias("a"),
                 F.when(F.col("_prev").isNull(), F.col("t")).otherwise(F.col("_b") * bw).alias("z"),
                 *[F.col(f"_carry_{m}").alias(m) for m in measures]),
    )).alias("s")).select(*keys, "s.*")
    return (segs.where((F.col(measures[0]) > 0) & (F.col("z") > F.col("a")))
            .select(*keys, *measures, F.explode(F.sequence("a", F.col("z") - 1)).alias("_w")))


def _window_bounds(window_s: int, slide_s: int) -> list[Column]:
    slide_us = slide_s * 1_000_000
    return [_ntz(F.col("_w") * slide_us).alias("window_start"),
            _ntz(F.col("_w") * slide_us + window_s * 1_000_000).alias("window_end")]


def sliding_counts(df: DataFrame, ts: str, keys: Sequence[str], window_s: int = COUNT_WINDOW_S,
                   slide_s: int = COUNT_SLIDE_S, name: str = "n") -> DataFrame:
    """Rows per key per sliding window
    ``(window_start, window_end, *keys, n)``."""
    keys = list(keys)
    if window_s % slide_s:
        w = F.window(F.col(ts).cast("timestamp"), f"{window_s} seconds", f"{slide_s} seconds")
        out = df.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias(name))
        return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, name)
    slide_us = slide_s * 1_000_000
    panes = (df.withColumn("_pane", F.floor(_micros(ts) / slide_us))
             .groupBy("_pane", *keys).agg(F.count(F.lit(1)).alias("_c")))
    out = _windows_from_panes(panes, keys, window_s, slide_s, ["_c"])
    return out.select(*_window_bounds(window_s, slide_s), *keys, F.col("_c").cast("bigint").alias(name))


def sliding_int_mean(df: DataFrame, ts: str, value: Column, window_s: int = MEAN_WINDOW_S,
                     slide_s: int = MEAN_SLIDE_S, keys: Sequence[str] = ()) -> DataFrame:
    """W4 + F21: integer mean of an integral ``value`` per sliding window
    ``(window_start, window_end, *keys, total, n, int_mean)``."""
    keys = list(keys)
    slide_us = slide_s * 1_000_000
    panes = (df.withColumn("_pane", F.floor(_micros(ts) / slide_us)).withColumn("_v", value.cast("bigint"))
             .groupBy("_pane", *keys).agg(F.count(F.lit(1)).alias("_c"), F.sum("_v").alias("_s")))
    out = _windows_from_panes(panes, keys, window_s, slide_s, ["_c", "_s"])
    return out.select(*_window_bounds(window_s, slide_s), *keys,
                      F.col("_s").cast("bigint").alias("total"), F.col("_c").cast("bigint").alias("n"),
                      int_div_mean(F.col("_s"), F.col("_c")).alias("int_mean"))


def window_top_k(counts: DataFrame, k: int, key: str, name: str = "n",
                 rank_col: str = "rank") -> DataFrame:
    """The ``k`` largest keys of each window (ties by key), numbered.  The
    ranking window is partitioned by window start, so windows rank in parallel,
    and Spark plans a partial ``WindowGroupLimit`` before the shuffle: each map
    task forwards at most ``k`` rows per window, however many keys it holds."""
    from pyspark.sql import Window
    w = Window.partitionBy("window_start").orderBy(F.desc(name), F.asc(key))
    return counts.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


# ---------------------------------------------------------------------------
# Structured Streaming
# ---------------------------------------------------------------------------
def file_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """S17 re-aimed: a file stream over a folder (new files become new batches)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(folder)


def table_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over one table: a folder of part files, or a single file (the
    stream then watches its parent for that name).  Fails when nothing is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(f"no table at {path}")
    if fs.getFileStatus(p).isDirectory():
        return file_stream(spark, path, schema, fmt, files_per_trigger=files_per_trigger)
    return file_stream(spark, p.getParent().toString(), schema, fmt, glob=p.getName(), files_per_trigger=files_per_trigger)


def dropped_rows(query) -> int:
    """Rows a live query has dropped as later than its watermark (from its recent progress)."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress
               for op in p["stateOperators"])


def stream_sliding_counts(stream: DataFrame, ts: str, keys: Sequence[str], window_s: int = COUNT_WINDOW_S,
                          slide_s: int = COUNT_SLIDE_S, watermark: str = "10 minutes",
                          name: str = "n") -> DataFrame:
    """W2/W3 on a stream: event-time sliding counts with a watermark."""
    ev = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    w = F.window("_ts", f"{window_s} seconds", f"{slide_s} seconds")
    return ev.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias(name))


def stream_pane_counts(stream: DataFrame, ts: str, keys: Sequence[str], slide_s: int = COUNT_SLIDE_S,
                       watermark: str | None = "10 minutes", name: str = "n",
                       value: Column | None = None) -> DataFrame:
    """Pane form of W2/W3 (with an integral ``value``, whose sum is ``total``, of W4) for streams: the stateful part keeps one count per
    slide-wide tumbling pane and key (``window / slide`` times less state than
    sliding windows); :func:`panes_to_windows` fans the panes out to sliding
    windows when the result is read.

    A live stream needs a watermark to bound its state and drops rows later than that
    (:func:`dropped_rows` reports them).  A back-fill reads files in any order and takes
    ``watermark=None``: no row is late, and the state is one count per pane and key, kept in
    one row for ``PANES_PER_ROW`` neighbouring panes of a key."""
    ev = stream.withColumn("_ts", F.col(ts).cast("timestamp"))
    if watermark is None:
        return _packed_pane_counts(ev, list(keys), slide_s, name, value)
    ev = ev.withWatermark("_ts", watermark)
    w = F.window("_ts", f"{slide_s} seconds")
    sums = [] if value is None else [F.sum(value.cast("bigint")).alias("total")]
    return ev.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias(name), *sums)


def _packed_pane_counts(ev: DataFrame, keys: list[str], slide_s: int, name: str, value: Column | None) -> DataFrame:
    """``(w, *keys, n)`` and ``total``, a row per pane and key, from state rows of ``PANES_PER_ROW`` panes.
    A micro-batch emits the panes of the state rows it changes."""
    slide_us = slide_s * 1_000_000
    at = [F.pmod(F.floor(_micros("_ts") / slide_us), F.lit(PANES_PER_ROW)) == i for i in range(PANES_PER_ROW)]
    sums = [] if value is None else [F.sum(F.when(here, value.cast("bigint"))).alias(f"_total{i}") for i, here in enumerate(at)]
    rows = (ev.groupBy(F.window("_ts", f"{slide_s * PANES_PER_ROW} seconds").alias("_row"), *keys)
            .agg(*[F.count(F.when(here, 1)).alias(f"_n{i}") for i, here in enumerate(at)], *sums))

    def edge(i):
        return F.timestamp_micros(F.unix_micros("_row.start") + i * slide_us)

    panes = [F.struct(F.struct(edge(i).alias("start"), edge(i + 1).alias("end")).alias("w"), F.col(f"_n{i}").alias(name),
                      *([] if value is None else [F.col(f"_total{i}").alias("total")])) for i in range(PANES_PER_ROW)]
    return (rows.select(*keys, F.explode(F.array(*panes)).alias("_p")).where(F.col(f"_p.{name}") > 0)
            .select("_p.w", *keys, f"_p.{name}", *([] if value is None else ["_p.total"])))


def panes_to_means(panes: DataFrame, keys: Sequence[str] = (), window_s: int = MEAN_WINDOW_S,
                   slide_s: int = MEAN_SLIDE_S, name: str = "n") -> DataFrame:
    """W4 from the panes of a stream: as :func:`sliding_int_mean`."""
    keys = list(keys)
    p = panes.select(F.floor(_micros("window_start") / (slide_s * 1_000_000)).alias("_pane"), *keys,
                     F.col(name).alias("_c"), F.col("total").alias("_s"))
    out = _windows_from_panes(p, keys, window_s, slide_s, ["_c", "_s"])
    return out.select(*_window_bounds(window_s, slide_s), *keys,
                      F.col("_s").cast("bigint").alias("total"), F.col("_c").cast("bigint").alias("n"),
                      int_div_mean(F.col("_s"), F.col("_c")).alias("int_mean"))


def panes_to_windows(panes: DataFrame, keys: Sequence[str], window_s: int = COUNT_WINDOW_S,
                     slide_s: int = COUNT_SLIDE_S, name: str = "n") -> DataFrame:
    """Sliding-window counts from pane counts ``(window_start, window_end, *keys, n)``."""
    keys = list(keys)
    slide_us = slide_s * 1_000_000
    p = panes.select(F.floor(_micros("window_start") / slide_us).alias("_pane"), *keys, F.col(name).alias("_c"))
    out = _windows_from_panes(p, keys, window_s, slide_s, ["_c"])
    return out.select(*_window_bounds(window_s, slide_s), *keys, F.col("_c").cast("bigint").alias(name))


def _flat(agg: DataFrame) -> DataFrame:
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                      *[c for c in agg.columns if c != "w"])


def start_to_folder(agg: DataFrame, label: str, trigger_s: int | None = BATCH_INTERVAL_S,
                    output_mode: str = "update"):
    """Start a windowed streaming aggregate that writes every
    micro-batch to ``<folder>/out/batch_id=N``; returns ``(query, folder)``.

    ``trigger_s`` seconds per micro-batch (2 s in the reference); ``None``
    processes what is available and stops.  State and progress live in
    ``<folder>/checkpoint`` under ``spark.checkpoint.dir``, so a restarted query
    resumes where it stopped.  Read results at any time with :func:`read_folder`.
    A back-fill's state (``trigger_s=None``) is kept by RocksDB, outside the executors' heap; a live
    query keeps the session's store.
    """
    base = scratch_path(agg.sparkSession, label)
    writer = (_flat(agg).writeStream.outputMode(output_mode)
              .option("checkpointLocation", f"{base}/checkpoint")
              .foreachBatch(batch_dirs_writer(f"{base}/out")))
    writer = writer.trigger(availableNow=True) if trigger_s is None else \
        writer.trigger(processingTime=f"{trigger_s} seconds")
    with _rocksdb_state(agg.sparkSession) if trigger_s is None else nullcontext():
        return writer.start(), base


def read_folder(spark: SparkSession, folder: str, keys: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Current result of a :func:`start_to_folder` query (latest batch wins per
    window and key); empty when no micro-batch has finished yet."""
    if not _exists(spark, f"{folder}/out"):
        if schema is None:
            raise ValueError("no micro-batch yet; pass the schema to get an empty frame")
        return spark.createDataFrame([], schema)
    return read_batch_dirs(spark, f"{folder}/out", ["window_start", "window_end", *keys])


def run_to_table(agg: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Run a windowed streaming aggregate over what is available, wait for it,
    and return its result (tests, batch back-fill, the registered queries).  The
    checkpoint of a query that has ended well is deleted: nobody can go on from it."""
    q, base = start_to_folder(agg, label, trigger_s=None)
    q.awaitTermination()
    delete_path(agg.sparkSession, f"{base}/checkpoint")
    return read_folder(agg.sparkSession, base, keys, _flat(agg).schema)


@contextmanager
def _rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, whatever the session's own store is (a query
    takes the settings along when it starts)."""
    before = {name: spark.conf.get(name, None) for name in ROCKSDB_STATE}
    try:
        for name, value in ROCKSDB_STATE.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stream_words(stream: DataFrame, text: str, ts: str) -> DataFrame:
    """W8 + F2 + P18/P19 on a stream: split each message on single blanks
    (flatMap), keep hashtags and non-banned words (filter), tag the kind (map).
    Stateless, so each micro-batch is processed on its own."""
    from quarry.functions.text import hashtag_filter, stream_word_filter
    w = stream.select(F.col(ts).alias("ts"), F.explode(F.split(F.col(text), " ")).alias("word"))
    return (w.where(hashtag_filter("word") | stream_word_filter("word"))
            .withColumn("kind", F.when(hashtag_filter("word"), "hashtag").otherwise("word")))


def start_console(df: DataFrame, rows: int = 10, trigger_s: int = BATCH_INTERVAL_S,
                  output_mode: str = "update"):
    """Print the first ``rows`` rows of every micro-batch (the reference's
    ``print``); returns the running query.  For inspection, not for results."""
    return (df.writeStream.outputMode(output_mode).format("console")
            .option("numRows", rows).option("truncate", "false")
            .trigger(processingTime=f"{trigger_s} seconds").start())
