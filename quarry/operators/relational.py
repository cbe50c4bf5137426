"""Keyed aggregates, HAVING filters and top-k.

All aggregates here are algebraic (count, sum, min, max, min_by), so Spark runs
them as partial (map-side) + final hash aggregates: a hot key costs one row per
map task in the shuffle, not one row per input row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import int_div_mean


def _cols(cols: Sequence[str | Column] | str | Column) -> list:
    return [cols] if isinstance(cols, (str, Column)) else list(cols)


def count_by(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """A1: rows per key (bigint)."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def sum_all_numeric(df: DataFrame, key: str, prefix: str = "sum_") -> DataFrame:
    """A3: ``groupBy(key).sum()`` over every numeric column, key included, with named
    (``sum_<col>``) outputs: bigint for integers, double for float and double,
    decimal for decimal."""
    integral = {"tinyint", "smallint", "int", "bigint"}
    sums = []
    for c, t in df.dtypes:
        if t in integral:
            sums.append(F.sum(c).cast("bigint").alias(prefix + c))
        elif t in ("float", "double") or t.startswith("decimal"):
            sums.append(F.sum(c).alias(prefix + c))
    return df.groupBy(key).agg(*sums)


def extremes_by(df: DataFrame, keys, value: str | Column,
                lo: str = "min_v", hi: str = "max_v") -> DataFrame:
    """A4: both extremes per key (the reference's "minimum" job took the max)."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_cols(keys)).agg(F.min(v).alias(lo), F.max(v).alias(hi))


def int_mean_by(df: DataFrame, keys, value: str, name: str = "int_mean") -> DataFrame:
    """A5: integer mean (sum div count, truncating toward zero)."""
    return (df.groupBy(*_cols(keys))
            .agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
            .select(*_cols(keys), int_div_mean(F.col("_s"), F.col("_n")).alias(name)))


def mean_by(df: DataFrame, keys, value: str | Column, name: str = "mean") -> DataFrame:
    """Real mean per key."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*_cols(keys)).agg(F.avg(v).alias(name))


def any_one_by(df: DataFrame, keys, value: str, order: str | Column, name: str | None = None) -> DataFrame:
    """One value per key - deterministically the one with the smallest
    ``order`` (the reference kept an arbitrary one)."""
    o = F.col(order) if isinstance(order, str) else order
    return df.groupBy(*_cols(keys)).agg(F.min_by(value, o).alias(name or value))


def having(df: DataFrame, cond: Column | str) -> DataFrame:
    """Filter on aggregated columns."""
    return df.where(cond)


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """``orderBy(...).limit(k)``; Spark plans it as TakeOrderedAndProject
    (a bounded heap per task, then a k-row merge), never a full sort.  The order
    must end in a unique key so ties at the cut are deterministic."""
    return df.orderBy(*order).limit(k)


def numbered_top_k(df: DataFrame, k: int, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Top-k with a 1-based running number.  The numbering window spans only
    the k selected rows."""
    top = top_k(df, k, order)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
