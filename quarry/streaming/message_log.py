"""A message log on a shared file system and a streaming source over it.

A log is a folder of segments.  Appending a frame deals its rows over the log's partitions, gives
them consecutive offsets in each, and publishes the segment by one manifest file, so a reader sees
a segment whole or not at all.  A failed append leaves an unlisted folder and no offsets.

The source is a Python stream reader (``spark.readStream.format("message_log")``).  An offset is a
position in every log partition.  A micro-batch reads a range of offsets from the segments that hold
it, split into tasks of at most ``rows_per_task`` messages, and the same range always gives the same
messages: a batch repeated after a failure, and a query restarted from its checkpoint, read every
message once.  ``commit`` records the last offsets a query has finished, for monitoring.

Paths are those of the cluster's shared folder; tasks open them with pyarrow's file systems (local
and mounted folders, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Messages one task reads at most.
ROWS_PER_TASK = 1_000_000

_LOW_BITS = (1 << 33) - 1


def _open(path: str):
    """The file system of a path and the path in it."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _segments(path: str) -> list[dict]:
    """Published segments in order: ``{"name", "partitions": {p: [first offset, rows]}}``."""
    from pyarrow import fs
    files, root = _open(path)
    out = []
    for info in sorted(files.get_file_info(fs.FileSelector(f"{root}/manifest", allow_not_found=True)), key=lambda i: i.base_name):
        if info.base_name.endswith(".json"):
            with files.open_input_stream(info.path) as f:
                out.append(json.loads(f.read()))
    return out


def _ends(segments: list[dict]) -> dict[str, int]:
    ends: dict[str, int] = {}
    for s in segments:
        for p, (first, rows) in s["partitions"].items():
            ends[p] = first + rows
    return ends


def _put(path: str, name: str, content: dict) -> None:
    files, root = _open(path)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{name}") as f:
        f.write(json.dumps(content).encode())


def _publish(path: str, name: str, content: dict) -> None:
    """A new small file that readers see whole: written under another name, then moved."""
    part = f".{name}-{uuid.uuid4().hex}"
    _put(path, part, content)
    files, root = _open(path)
    files.move(f"{root}/{part}", f"{root}/{name}")


def append(rows: DataFrame, path: str, partitions: int = 4, order: str | None = None) -> int:
    """Append the rows as one segment; returns the number of messages.  One writer at a time.

    ``order`` sorts the messages inside each log partition."""
    spark = rows.sparkSession
    known = _segments(path)
    name = f"{len(known):08d}"
    folder = f"{path}/segments/{name}-{uuid.uuid4().hex[:8]}"
    dealt = rows.repartition(partitions)
    if order:
        dealt = dealt.sortWithinPartitions(order)
    position = F.monotonically_increasing_id()
    dealt.withColumn("_partition", F.spark_partition_id()).withColumn("_offset", position.bitwiseAND(F.lit(_LOW_BITS))).write.parquet(folder)
    counts = spark.read.parquet(folder).groupBy("_partition").count().collect()
    ends = _ends(known)
    found = {str(r["_partition"]): [ends.get(str(r["_partition"]), 0), r["count"]] for r in counts}
    _publish(f"{path}/manifest", f"{name}.json", {"name": folder, "partitions": found})
    return sum(rows for _, rows in found.values())


@dataclass
class _Slice(InputPartition):
    """Messages ``low <= offset - first < high`` of one log partition in one segment."""

    folder: str
    partition: int
    low: int
    high: int


class MessageLogReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, path: str, rows_per_task: int, from_end: bool):
        self.schema, self.path, self.rows_per_task, self.from_end = schema, path, rows_per_task, from_end

    def initialOffset(self) -> dict:
        return _ends(_segments(self.path)) if self.from_end else {}

    def latestOffset(self) -> dict:
        return _ends(_segments(self.path))

    def partitions(self, start: dict, end: dict) -> list[_Slice]:
        out = []
        for s in _segments(self.path):
            for p, (first, rows) in s["partitions"].items():
                low, high = max(start.get(p, 0), first), min(end.get(p, 0), first + rows)
                for at in range(low, high, self.rows_per_task):
                    out.append(_Slice(s["name"], int(p), at - first, min(at + self.rows_per_task, high) - first))
        return out

    def read(self, partition: _Slice):
        import pyarrow as pa
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        files, root = _open(partition.folder)
        wanted = (ds.field("_partition") == partition.partition) & (ds.field("_offset") >= partition.low) & (ds.field("_offset") < partition.high)
        for batch in ds.dataset(root, filesystem=files, format="parquet").to_batches(columns=schema.names, filter=wanted):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, schema)], schema=schema)

    def commit(self, end: dict) -> None:
        _put(f"{self.path}/committed", "latest.json", end)


class MessageLog(DataSource):
    """Options: ``path``; ``rows_per_task``; ``startingOffsets`` ``earliest`` (default) or ``latest``."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def streamReader(self, schema: StructType) -> MessageLogReader:
        if "path" not in self.options:
            raise ValueError("the message log needs a path")
        return MessageLogReader(schema, self.options["path"], int(self.options.get("rows_per_task", ROWS_PER_TASK)),
                                self.options.get("startingOffsets", "earliest") == "latest")


def log_stream(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """The messages of a log as a stream."""
    # Spark looks for the name in the active session too, and refuses one that only that session knows
    sessions = spark._jvm.org.apache.spark.sql.classic.SparkSession
    active = sessions.getActiveSession()
    sessions.setActiveSession(spark._jsparkSession)
    try:
        spark.dataSource.register(MessageLog)
    finally:
        if active.isDefined():
            sessions.setActiveSession(active.get())
    return spark.readStream.format("message_log").schema(schema).options(**options).load(path)


def committed(path: str) -> dict[str, int]:
    """Offsets that a query has reported as finished; empty when none has."""
    from pyarrow import fs
    files, root = _open(path)
    if files.get_file_info(f"{root}/committed/latest.json").type == fs.FileType.NotFound:
        return {}
    with files.open_input_stream(f"{root}/committed/latest.json") as f:
        return json.loads(f.read())
