"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir, scratch_path

#: Text bytes handled at once inside a task; bounds the numpy buffers of the operators.
SLICE_BYTES = 4 << 20

#: Fixed 64-bit odd constants of the splitmix finaliser.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser of a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``limit`` (one row at least)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; it yields dictionaries of output columns."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def run(batches):
        for batch in batches:
            for out in fn(batch):
                yield pa.RecordBatch.from_arrays([_array(out[n]) for n in names], names=names)

    return df.mapInArrow(run, schema)


def _array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def pinned(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the shared ``spark.checkpoint.dir``.

    Spark deletes it once nothing refers to it when
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    _release(df.sparkSession)
    return out


def _release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished jobs now: it acts when the
    driver's JVM collects garbage, by default every half hour."""
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, label: str, owner: SparkSession | None = None) -> str:
    """The path of a table with the rows of ``df`` in the shared scratch folder, which the session
    ``owner`` names (that of ``df`` by default)."""
    path = scratch_path(owner or df.sparkSession, label)
    df.write.parquet(path)
    _release(df.sparkSession)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a table in the shared scratch folder: several times smaller than a
    checkpoint.  ``quarry.session.clean_scratch`` deletes what a session has stored."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, label))


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links(a, b)`` (longs) by large-star / small-star rounds.

    Returns ``(node, root)`` for every node that has a link; the root is the smallest
    node of the component.  Both star steps shuffle the links on one end with a minimum
    (pre-aggregated before the shuffle) and never gather a component in one task; every
    round is checkpointed, so a lost executor repeats one round at most."""
    edges = pinned(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = pinned(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if row == state:
            break
        state = row
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it by name in ``body`` (inside one projection)."""
    return F.transform(F.array(value), body)[0]


__all__ = ["SLICE_BYTES", "components", "let", "map_arrow", "mix64", "pinned", "read_table", "slices", "stored", "utf8", "written"]
