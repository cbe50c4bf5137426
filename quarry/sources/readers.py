"""Readers with explicit schemas.

Every reader is a distributed ``spark.read`` call followed by column
expressions: no driver-side loops, no RDD round trip.  ``mode`` is

* ``"strict"``  – a malformed number fails the job (ANSI ``cast``), like the
  reference's ``.toInt``;
* ``"permissive"`` – malformed numbers become NULL (``try_cast``) and callers can
  count them with :func:`count_rejects`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import strip_ws

MODES = ("strict", "permissive")


def _cast(c: Column, type_name: str, mode: str) -> Column:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if type_name == "string":
        return c
    return c.cast(type_name) if mode == "strict" else c.try_cast(type_name)


# ---------------------------------------------------------------------------
# Text lines
# ---------------------------------------------------------------------------
def read_lines(spark: SparkSession, path: str, with_order: bool = False) -> DataFrame:
    """One row per line, column ``value``.

    ``with_order=True`` adds ``file`` and ``line_order``: a key that follows the
    file order within each file split (used for "last one wins" dedupe)."""
    df = spark.read.text(path)
    if with_order:
        df = df.select(F.input_file_name().alias("file"),
                       F.monotonically_increasing_id().alias("line_order"), "value")
    return df


# ---------------------------------------------------------------------------
# Positional delimited files
# ---------------------------------------------------------------------------
def read_positional(spark: SparkSession, path: str, fields: Mapping[int, tuple[str, str]],
                    sep: str = ",", mode: str = "strict") -> DataFrame:
    """Positional delimited reader.

    ``fields`` maps a 0-based position to ``(name, spark type)``; positions not
    listed are read as strings and pruned.  Quoting is off (the reference splits
    on the bare separator), extra trailing fields are ignored and blank lines
    are skipped.  Short rows give NULLs in permissive mode and fail in strict
    mode.
    """
    width = max(fields) + 1
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(width)])
    raw = (spark.read.schema(schema)
           .option("sep", sep).option("quote", "").option("escape", "")
           .option("mode", "PERMISSIVE").option("header", "false")
           .csv(path))
    cols = []
    for pos in sorted(fields):
        name, type_name = fields[pos]
        c = _cast(F.col(f"_c{pos}"), type_name, mode)
        if mode == "strict":
            c = F.when(F.col(f"_c{pos}").isNotNull(), c).otherwise(
                F.raise_error(F.lit(f"short row: field {pos} ({name}) missing")).cast(type_name))
        cols.append(c.alias(name))
    return raw.select(*cols)


def read_weather(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """``station, date, entry_type, value`` rows (value in tenths of °C)."""
    return read_positional(spark, path, {0: ("station", "string"), 2: ("entry_type", "string"),
                                         3: ("value", "int")}, ",", mode)


def read_purchases(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """S3: ``customer_id, item_id, amount``; amount as exact decimal."""
    return read_positional(spark, path, {0: ("customer_id", "int"), 1: ("item_id", "int"),
                                         2: ("amount", "decimal(18,2)")}, ",", mode)


def read_people(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """``id, name, age, num_friends``."""
    return read_positional(spark, path, {0: ("id", "int"), 1: ("name", "string"),
                                         2: ("age", "int"), 3: ("num_friends", "int")}, ",", mode)


def read_ratings(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Tab-separated ``user_id, item_id, rating[, ...]``."""
    return read_positional(spark, path, {0: ("user_id", "int"), 1: ("item_id", "int"),
                                         2: ("rating", "double")}, "\t", mode)


# ---------------------------------------------------------------------------
# Dimension files
# ---------------------------------------------------------------------------
def _last_wins(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key, the value of its last line (file order)."""
    return (df.groupBy(key)
            .agg(F.max_by(value, F.struct("file", "line_order")).alias(value)))


def read_pipe_names(spark: SparkSession, path: str, last_wins: bool = True, mode: str = "permissive") -> DataFrame:
    """``id|name|...`` with bigint ids; rows with fewer than two fields (closing empty
    ones do not count) are skipped, malformed UTF-8 is replaced, a repeated id keeps its
    last name.  An id that is no number fails the query in ``strict`` mode; ``permissive``
    leaves the row out, and :func:`pipe_name_rejects` gives those rows."""
    lines = read_lines(spark, path, with_order=True)
    parts = _pipe_fields()
    number = strip_ws(F.get(parts, 0))
    bad = F.raise_error(F.concat(F.lit("no id in line: "), F.col("value"))).cast("bigint")
    df = (lines.where(F.size(parts) > 1)
          .select("file", "line_order",
                  (F.coalesce(number.try_cast("bigint"), bad) if mode == "strict" else number.try_cast("bigint")).alias("item_id"),
                  F.get(parts, 1).alias("name"))
          .where(F.col("item_id").isNotNull()))
    return _last_wins(df, "item_id", "name") if last_wins else df.drop("file", "line_order")


def pipe_name_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines whose id is no number, which a permissive :func:`read_pipe_names` leaves out."""
    parts = _pipe_fields()
    return read_lines(spark, path, with_order=True).where(
        (F.size(parts) > 1) & strip_ws(F.get(parts, 0)).try_cast("bigint").isNull()).select("file", "value")


def _pipe_fields():
    return F.split(F.regexp_replace(F.col("value"), r"\|+$", ""), r"\|")


QUOTED_NAME = r'^\s*(\d+)\s*"([^"]*)'


def read_quoted_names(spark: SparkSession, path: str, last_wins: bool = True) -> DataFrame:
    """``id "NAME"`` lines; rows without a quote are skipped."""
    lines = read_lines(spark, path, with_order=True)
    df = (lines.where(F.col("value").rlike(QUOTED_NAME))
          .select("file", "line_order",
                  F.regexp_extract("value", QUOTED_NAME, 1).cast("bigint").alias("id"),
                  F.regexp_extract("value", QUOTED_NAME, 2).alias("name")))
    return _last_wins(df, "id", "name") if last_wins else df.drop("file", "line_order")


# ---------------------------------------------------------------------------
# Adjacency lists
# ---------------------------------------------------------------------------
def read_adjacency_lines(spark: SparkSession, path: str) -> DataFrame:
    """S8 as lines: ``vertex`` and its ``neighbours`` array (one vertex may span
    several lines).  Blank lines are skipped."""
    t = F.split(strip_ws("value"), r"\s+")
    return (read_lines(spark, path)
            .where(strip_ws("value") != "")
            .select(t.alias("t"))
            .select(F.get("t", 0).cast("bigint").alias("vertex"),
                    F.transform(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0))),
                                lambda x: x.cast("bigint")).alias("neighbours")))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """S8 as an edge table ``(src, dst)``, one row per listed neighbour."""
    return (read_adjacency_lines(spark, path)
            .select(F.col("vertex").alias("src"), F.explode("neighbours").alias("dst")))


def line_degrees(spark: SparkSession, path: str) -> DataFrame:
    """per vertex, the sum over its lines of ``tokens - 1``."""
    return (read_adjacency_lines(spark, path)
            .groupBy("vertex").agg(F.sum(F.size("neighbours")).cast("bigint").alias("degree")))


# ---------------------------------------------------------------------------
# Labelled points
# ---------------------------------------------------------------------------
def read_labeled_points(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """``label,f1 f2 ...`` -> ``label`` double, ``features`` ml vector."""
    from pyspark.ml.functions import array_to_vector

    parts = F.split(strip_ws("value"), ",")
    feats = F.split(strip_ws(F.get(parts, 1)), r"\s+")
    return (read_lines(spark, path)
            .where(strip_ws("value") != "")
            .select(_cast(F.get(parts, 0), "double", mode).alias("label"),
                    F.transform(feats, lambda x: _cast(x, "double", mode)).alias("f"))
            .select("label", array_to_vector("f").alias("features")))


# ---------------------------------------------------------------------------
# NDJSON
# ---------------------------------------------------------------------------
REVIEW_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
])
BUSINESS_SCHEMA = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("name", T.StringType()),
])


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None,
              infer: bool = False) -> DataFrame:
    """NDJSON with an explicit schema; inference (an extra pass) is opt-in."""
    if schema is None and not infer:
        raise ValueError("pass a schema, or infer=True")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def count_rejects(df: DataFrame, cols: list[str]) -> DataFrame:
    """One-row frame: rows where any of ``cols`` failed to parse (NULL)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.agg(F.count_if(cond).alias("rejects"))
