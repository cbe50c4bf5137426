"""Output of a stream that stays cheap to read: a manifest, and compaction of its batches.

``batch_dirs_writer`` leaves one folder per micro-batch for ever, and a reader resolves all of them.
A ``BatchTable`` also writes a folder per batch, but what belongs to the table is what its newest
manifest lists.  A manifest is one small file, written under another name and moved, so a batch
counts whole or not at all: a batch that Spark runs again after a failure is recognised by its
number, and a query restarted from its checkpoint goes on where the table stands.

Folders are merged by levels: as soon as ``fan_out`` folders have one level they become one folder
of the next, so a table of n batches has less than ``fan_out`` folders per level and ``log n``
levels, and each row is written again ``log n`` times at most.  Merging resolves updates: of rows
with equal keys the one of the latest batch stays.  Windows that have closed (``closing_column`` at
or before a cut: the highest value seen in earlier batches less ``delay_s``, behind which the
stream's watermark lets no row through) go to folders of their own, which are read as they are,
without grouping; what older folders still have of them is skipped.

Two generations of folders are kept: a frame read before a merge stays readable until the merge
after it.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import delete_path

FAN_OUT = 8


class BatchTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], closing_column: str | None = None, delay_s: float = 0,
                 fan_out: int = FAN_OUT):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.closing_column, self.delay_us, self.fan_out = closing_column, round(delay_s * 1_000_000), fan_out

    # --- manifest ------------------------------------------------------------------------------

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self) -> list[str]:
        files, path = self._files()
        if not files.exists(path):
            return []
        return sorted(s.getPath().getName() for s in files.listStatus(path) if s.getPath().getName().endswith(".json"))

    def manifest(self) -> dict:
        """``last`` batch, ``schema``, the highest closing value (``high``), the one up to which rows are in
        closed folders (``cut``), and the live folders ``{"name", "level", "order", "closed"}``."""
        names = self._names()
        if not names:
            return {"last": -1, "schema": None, "high": None, "cut": None, "folders": [], "old": []}
        files, path = self._files()
        stream = files.open(self.spark._jvm.org.apache.hadoop.fs.Path(path, names[-1]))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        files, path = self._files()
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path
        part = hadoop_path(path, f".{uuid.uuid4().hex}")
        stream = files.create(part, True)
        stream.write(json.dumps(manifest).encode())
        stream.close()
        if not files.rename(part, hadoop_path(path, f"{manifest['last']:012d}.json")):
            raise RuntimeError(f"batch {manifest['last']} of {self.path} was published by another writer")
        for name in self._names()[:-2]:
            files.delete(hadoop_path(path, name), False)

    # --- reading -------------------------------------------------------------------------------

    def _load(self, folders: list[dict], schema: T.StructType, cut: int | None) -> list[DataFrame]:
        """The folders' rows; of open ones those that are not in a closed folder by now."""
        frames = [self.spark.read.schema(schema).parquet(f"{self.path}/{f['name']}").withColumn("_order", F.lit(f["order"])) for f in folders]
        return [df if f["closed"] or cut is None else df.where(~self._over(cut)) for df, f in zip(frames, folders)]

    def _over(self, cut: int):
        value = F.unix_micros(F.col(self.closing_column).cast("timestamp"))
        return F.coalesce(value <= cut, F.lit(False))

    def _resolved(self, frames: list[DataFrame]) -> DataFrame:
        """Of rows with equal keys the one of the latest batch."""
        every = reduce(DataFrame.unionByName, frames)
        if len(frames) == 1:
            return every.drop("_order")
        values = [c for c in every.columns if c not in (*self.keys, "_order")]
        return every.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "_order").alias("_v")).select(*self.keys, "_v.*")

    def read(self, condition=None) -> DataFrame | None:
        """The table as of its last batch, ``None`` before the first one.  ``condition`` on key columns
        is applied to the files, before updates are resolved."""
        state = self.manifest()
        if state["schema"] is None:
            return None
        return self._read(state, condition)

    def _read(self, state: dict, condition=None) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])

        def chosen(closed):
            frames = self._load([f for f in state["folders"] if f["closed"] == closed], schema, state["cut"])
            return [f.where(condition) for f in frames] if condition is not None else frames

        parts = [f.drop("_order") for f in chosen(True)]
        if open_folders := chosen(False):
            parts.append(self._resolved(open_folders))
        parts = [p.select(*schema.names) for p in parts]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def batch(self, batch_id: int) -> DataFrame:
        """The rows of the last batch or of one that was not merged before it."""
        return self.spark.read.parquet(f"{self.path}/batches/{batch_id:012d}")

    # --- writing -------------------------------------------------------------------------------

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        """Add one micro-batch, whose keys are unique; False if the table has it already.

        One writer at a time.  ``delay_s`` must cover the watermark's delay and what the closing value of
        a row can exceed the time of its latest event by (a window's length)."""
        state = self.manifest()
        if batch_id <= state["last"]:
            batch.write.format("noop").mode("overwrite").save()  # the query's state has to be computed all the same
            return False
        name = f"batches/{batch_id:012d}"
        batch.write.mode("overwrite").parquet(f"{self.path}/{name}")
        schema = batch.schema
        folders = [*state["folders"], {"name": name, "level": 0, "order": batch_id, "closed": False}]
        merged, dropped, cut = self._merge(folders, schema, state, batch_id)
        high = self._highest(name, schema, state["high"])
        self._publish({"last": batch_id, "schema": json.loads(schema.json()), "high": high, "cut": cut, "folders": merged, "old": dropped or state["old"]})
        if dropped:  # the folders of the generation before are no longer read
            for old in state["old"]:
                delete_path(self.spark, f"{self.path}/{old}")
        return True

    def _highest(self, name: str, schema: T.StructType, known: int | None) -> int | None:
        if self.closing_column is None:
            return None
        found = self.spark.read.schema(schema).parquet(f"{self.path}/{name}").agg(
            F.max(F.unix_micros(F.col(self.closing_column).cast("timestamp")))).first()[0]
        return max((x for x in (found, known) if x is not None), default=None)

    def _merge(self, folders: list[dict], schema: T.StructType, state: dict, batch_id: int) -> tuple[list[dict], list[str], int | None]:
        """The folders after merging, the names of those no longer listed, and the new cut."""
        dropped: list[str] = []
        cut = state["cut"]

        def full(closed, level):
            found = [f for f in folders if f["closed"] == closed and f["level"] == level]
            return found if len(found) >= self.fan_out else []

        if full(False, 0) and self.closing_column is not None and state["high"] is not None:
            end = state["high"] - self.delay_us
            if cut is None or end > cut:
                done = self._resolved(self._load([f for f in folders if not f["closed"]], schema, cut)).where(self._over(end))
                folders = [*folders, self._store(done, 0, batch_id, True, batch_id)]
                cut = end
        for closed in (False, True):
            level = 0
            while some := full(closed, level):
                frames = self._load(some, schema, cut)
                whole = reduce(DataFrame.unionByName, frames).drop("_order") if closed else self._resolved(frames)
                merged = self._store(whole, level + 1, max(f["order"] for f in some), closed, batch_id)
                folders = [f for f in folders if f not in some] + [merged]
                dropped += [f["name"] for f in some]
                level += 1
        return folders, dropped, cut

    def _store(self, rows: DataFrame, level: int, order: int, closed: bool, batch_id: int) -> dict:
        name = f"merged/{batch_id:012d}-{'closed' if closed else 'open'}-{level}"
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return {"name": name, "level": level, "order": order, "closed": closed}
