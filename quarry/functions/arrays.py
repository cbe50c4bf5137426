"""Array and map column helpers (F22, F23): the list idioms of the reference's
worksheet, applied to array columns with Spark's higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_sum(c: Column | str) -> Column:
    """Left fold ``((0 + x1) + x2) + ...`` in double."""
    return F.aggregate(_c(c), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))


def array_stats(c: Column | str, threshold: float = 0.0) -> list[Column]:
    """The worksheet's list operations as named columns over one array column."""
    a = _c(c)
    return [
        F.size(a).alias("n"),
        F.array_max(a).cast("double").alias("max_v"),
        F.array_min(a).cast("double").alias("min_v"),
        array_sum(a).alias("sum_v"),
        F.size(F.filter(a, lambda x: x > threshold)).alias("n_pos"),
        F.get(F.reverse(a), 0).cast("double").alias("last_v"),
        F.get(a, 0).cast("double").alias("head_v"),
        F.size(F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))).alias("tail_n"),
        F.size(F.array_distinct(a)).alias("n_distinct"),
        F.array_contains(a, F.get(a, 0)).alias("has_head"),
        F.size(F.concat(a, F.reverse(a))).alias("n_concat"),
    ]


def label_map(keys: list, values: list) -> Column:
    """A literal map column."""
    pairs = []
    for k, v in zip(keys, values):
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)
