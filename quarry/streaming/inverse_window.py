"""Sliding counts of a live stream that forget: enter and leave events per key.

A row in pane ``p`` (``slide`` wide) enters the windows ``p - k + 1 .. p`` (``k`` = window / slide):
its key's count rises by one at window ``p - k + 1`` and falls again, the inverse step, at ``p + 1``.
The state of a key is its running count and these pending changes, at most two a pane still in a
window.  When the watermark passes a pane no more rows of it can come, and a timer settles the
windows that end there: the count between two changes is emitted once, as a run of windows, and the
changes leave the state.  A key whose count is back at zero without pending changes is evicted, so
the state holds the keys of the last ``window + delay`` only, whatever the stream has seen.

State and timers live in the RocksDB state store, outside the executors' heap, and in the query's
checkpoint.  Every window is emitted once and for good: the result needs no upsert when read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quarry.streaming.windows import COUNT_SLIDE_S, COUNT_WINDOW_S, _window_bounds

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session beside ``spark`` whose streams keep their state in RocksDB, in ``partitions`` stores (as
    many as ``spark`` has shuffle partitions when not given); a query keeps the number it started with."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.conf.get("spark.sql.shuffle.partitions")))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return session


class Counter:
    """Count and pending changes of one key, as bytes: position, count, then (window, change) pairs."""

    def __init__(self, data: bytes | None = None):
        numbers = struct.unpack(f">{len(data) // 8}q", data) if data else ()
        self.position, self.count = numbers[:2] or (None, 0)
        self.changes = dict(zip(numbers[2::2], numbers[3::2]))

    def bytes(self) -> bytes:
        flat = [x for change in sorted(self.changes.items()) for x in change]
        return struct.pack(f">{2 + len(flat)}q", self.position or 0, self.count, *flat)

    def enter(self, pane: int, rows: int, k: int) -> None:
        for window, change in ((pane - k + 1, rows), (pane + 1, -rows)):
            self.changes[window] = self.changes.get(window, 0) + change

    def settle(self, until: int) -> Iterator[tuple[int, int, int]]:
        """Runs ``(first window, window after the last, count)`` of the windows before ``until``."""
        for window in sorted(w for w in self.changes if w <= until):
            if self.count and window > self.position:
                yield self.position, window, self.count
            self.position, self.count = window, self.count + self.changes.pop(window)
        if self.count and until > self.position:
            yield self.position, until, self.count
            self.position = until

    @property
    def next_change(self) -> int | None:
        return min(self.changes, default=None)


class SlidingCounter(StatefulProcessor):
    """Rows ``(*keys, qy_at, qy_pane, qy_rows)``; output ``(*keys, _from, _until, _n)``."""

    def __init__(self, keys: Sequence[str], k: int, slide_ms: int):
        self.keys, self.k, self.slide_ms = list(keys), k, slide_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("counter", T.StructType([T.StructField("data", T.BinaryType())]))

    def _counter(self) -> Counter:
        return Counter(bytes(self.state.get()[0]) if self.state.exists() else None)

    def _keep(self, counter: Counter) -> None:
        """Store the counter and wake up when its next change is settled: the last pane of the window
        before it must be over.  Without a change left there is nothing to remember."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if counter.next_change is None:
            self.state.clear()
            return
        self.state.update((counter.bytes(),))
        self.handle.registerTimer((counter.next_change + self.k - 1) * self.slide_ms)

    def handleInputRows(self, key, rows, timerValues):
        counter = self._counter()
        for batch in rows:
            for pane, n in batch.groupby("qy_pane")["qy_rows"].sum().items():
                counter.enter(int(pane), int(n), self.k)
        self._keep(counter)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd
        counter = self._counter()
        # windows whose last pane ends at the watermark or before
        until = timerValues.getCurrentWatermarkInMs() // self.slide_ms - self.k + 1
        runs = list(counter.settle(until))
        self._keep(counter)
        if runs:
            out = pd.DataFrame(runs, columns=["_from", "_until", "_n"])
            for name, value in zip(self.keys, key):
                out.insert(0, name, value)
            yield out[[*self.keys, "_from", "_until", "_n"]]

    def close(self) -> None:
        pass


def _counted(panes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of one key and pane counted inside each Arrow batch, with the latest time: fewer rows reach
    the state, and the watermark moves as it would by single rows."""
    def run(batches):
        for batch in batches:
            groups = pa.Table.from_batches([batch]).group_by([*keys, "qy_pane"]).aggregate([("qy_at", "max"), ([], "count_all")])
            found = groups.select([*keys, "qy_at_max", "qy_pane", "count_all"]).rename_columns([*keys, "qy_at", "qy_pane", "qy_rows"])
            yield from found.to_batches()

    schema = T.StructType([*panes.schema.fields[:-1], T.StructField("qy_pane", T.LongType()), T.StructField("qy_rows", T.LongType())])
    return panes.mapInArrow(run, schema)


def forgetting_counts(stream: DataFrame, ts: str, keys: Sequence[str], window_s: int = COUNT_WINDOW_S, slide_s: int = COUNT_SLIDE_S,
                      delay: str = "1 minute") -> DataFrame:
    """Runs of windows with their counts ``(*keys, _from, _until, _n)``, in append mode.

    ``stream`` belongs to a ``state_session``.  Rows later than ``delay`` are dropped.  A row whose
    keys are all null only moves the watermark: send one to close the windows of a stream that has
    gone quiet."""
    if window_s % slide_s:
        raise ValueError("the window must be a multiple of the slide")
    keys = list(keys)
    slide_us = slide_s * 1_000_000
    at = F.col(ts).cast("timestamp")
    panes = _counted(stream.select(*keys, at.alias("qy_at"), F.floor(F.unix_micros(at) / slide_us).alias("qy_pane")), keys)
    # the condition names the time, so that Spark does not filter before the watermark has seen the row
    known = F.coalesce(*[F.col(c).cast("string") for c in keys]).isNotNull()
    panes = panes.withWatermark("qy_at", delay).where(F.when(F.col("qy_at") > F.timestamp_micros(F.lit(-(1 << 62))), known))
    out = T.StructType([stream.schema[c] for c in keys] + [T.StructField(c, T.LongType()) for c in ("_from", "_until", "_n")])
    return panes.groupBy(*keys).transformWithStateInPandas(
        SlidingCounter(keys, window_s // slide_s, slide_s * 1000), outputStructType=out, outputMode="append", timeMode="eventTime")


def runs_to_windows(runs: DataFrame, keys: Sequence[str], window_s: int = COUNT_WINDOW_S, slide_s: int = COUNT_SLIDE_S, name: str = "n") -> DataFrame:
    """``(window_start, window_end, *keys, n)`` from the runs of ``forgetting_counts``."""
    each = runs.withColumn("_w", F.explode(F.sequence(F.col("_from"), F.col("_until") - 1)))
    return each.select(*_window_bounds(window_s, slide_s), *keys, F.col("_n").alias(name))
