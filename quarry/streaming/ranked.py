"""Top keys of sliding windows, ranked while the stream runs.

The stateful part of the query counts rows per pane and key (update mode).  Each micro-batch brings
the panes it has changed; only the windows over these panes are counted anew, from the panes in the
table that they cover, ranked, and written.  The ranking table holds ``k`` rows per window, and the
pane table is pruned to the changed span before it is read.  Both are ``BatchTable`` s, so a batch run
again after a failure changes nothing, and readers see the ranking of a whole batch.

After every batch the ranking equals that of a batch query over all rows read so far.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.batch_table import BatchTable
from quarry.streaming.windows import COUNT_SLIDE_S, COUNT_WINDOW_S, _flat, _micros, panes_to_windows, window_top_k


class RunningTopK:
    """``foreachBatch`` function and reader of the ranking of one query."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], tie: str, k: int = 10, window_s: int = COUNT_WINDOW_S,
                 slide_s: int = COUNT_SLIDE_S, delay_s: float | None = None, fan_out: int = 8):
        """``delay_s`` is the delay of the stream's watermark; None: windows never close (back-fill)."""
        if window_s % slide_s:
            raise ValueError("the window must be a multiple of the slide")
        self.keys, self.tie, self.k, self.window_s, self.slide_s = list(keys), tie, k, window_s, slide_s
        closing = {} if delay_s is None else {"closing_column": "window_end", "delay_s": delay_s + window_s}
        self.panes = BatchTable(spark, f"{path}/panes", ["window_start", "window_end", *self.keys], fan_out=fan_out, **closing)
        self.ranking = BatchTable(spark, f"{path}/ranking", ["window_start", "window_end", "rank"], fan_out=fan_out, **closing)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """``batch``: changed panes ``(window_start, window_end, *keys, n)``."""
        self.panes.write(batch, batch_id)
        # read back what was written: asking the batch itself again would run the query's state again
        self.ranking.write(window_top_k(self._changed_counts(self.panes.batch(batch_id)), self.k, self.tie), batch_id)

    def _changed_counts(self, changes: DataFrame) -> DataFrame:
        """Counts of every window over a changed pane."""
        step, reach = self.slide_s * 1_000_000, self.window_s // self.slide_s - 1
        number = F.floor(_micros("window_start") / step)
        changed = changes.select(number.alias("_p")).distinct()
        span = changed.agg(F.min("_p").alias("low"), F.max("_p").alias("high")).first()
        if span["low"] is None:
            return panes_to_windows(changes, self.keys, self.window_s, self.slide_s)

        def around(before, after):
            return changed.select(F.explode(F.sequence(F.col("_p") - before, F.col("_p") + after)).alias("_p")).distinct()

        low, high = [F.timestamp_micros(F.lit(p * step)).cast("timestamp_ntz") for p in (span["low"] - reach, span["high"] + reach)]
        covered = self.panes.read((F.col("window_start") >= low) & (F.col("window_start") <= high))
        covered = covered.withColumn("_p", number).join(around(reach, reach), "_p", "left_semi").drop("_p")
        counts = panes_to_windows(covered, self.keys, self.window_s, self.slide_s)
        return counts.withColumn("_p", number).join(around(reach, 0), "_p", "left_semi").drop("_p")

    def read(self) -> DataFrame | None:
        """``(window_start, window_end, *keys, n, rank)`` as of the last batch."""
        return self.ranking.read()


def start_running_top_k(pane_counts: DataFrame, ranking: RunningTopK, checkpoint: str, trigger_s: float | None = None):
    """Start (or go on with) the query that keeps ``ranking`` up to date; ``pane_counts`` is a
    ``windows.stream_pane_counts`` stream with the slide of the ranking.  ``trigger_s`` seconds per
    micro-batch; None: what is available."""
    writer = _flat(pane_counts).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(ranking)
    writer = writer.trigger(availableNow=True) if trigger_s is None else writer.trigger(processingTime=f"{trigger_s} seconds")
    return writer.start()
