"""Joins (J1, J4-J8).

Broadcast rule used throughout: a side is hinted for broadcast only when its
row count has a bound we can prove from the plan (a ``limit(k)``, a one-row
scalar) or that we checked at run time.  Everything else is left to AQE, which
converts a join to broadcast from the *measured* shuffle size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest number of rows we hint for broadcast after checking a count.
BROADCAST_ROW_LIMIT = 200_000


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, cols: Sequence[str],
           df_is_bounded: bool = False, strict: bool = False) -> DataFrame:
    """Add dimension columns to ``df`` by key (a left lookup).

    ``df_is_bounded=True`` (``df`` is a top-k or similar): the keys of ``df`` are
    broadcast and the dimension is streamed past them (a left-semi join: one scan,
    no shuffle); the few rows that stay are then broadcast to ``df``.  The
    dimension key must be unique, so that they are at most as many as ``df`` has.
    Otherwise it is a plain left join and AQE picks the strategy from sizes.
    ``strict=True`` fails the query when a key has no dimension row, like the
    reference's map lookup.
    """
    d = dim.select(F.col(dim_key).alias("_dk"), *cols)
    if df_is_bounded:
        wanted = F.broadcast(df.select(F.col(key).alias("_wk")))
        found = d.join(wanted, F.col("_dk") == F.col("_wk"), "left_semi")
        out = df.join(F.broadcast(found), df[key] == F.col("_dk"), "left")
    else:
        out = df.join(d, df[key] == F.col("_dk"), "left")
    if strict:
        # the check lives in the output columns, so column pruning cannot drop it
        missing = F.raise_error(F.concat(F.lit(f"no dimension row for {key}="), df[key].cast("string")))
        return out.select(*df.columns, *[F.when(F.col("_dk").isNull(), missing).otherwise(F.col(c)).alias(c)
                                         for c in cols])
    return out.select(*df.columns, *cols)


def scalar_join(df: DataFrame, one_row: DataFrame, on: str) -> DataFrame:
    """Keep the rows of ``df`` whose ``on`` equals the value in a one-row
    frame (a scalar subquery).  The one-row side is broadcast."""
    return df.join(F.broadcast(one_row.select(on).limit(1)), on, "left_semi")


def within_seconds(a: DataFrame, b: DataFrame, a_ts: str, b_ts: str, delta_s: int,
                   select: Sequence[Column] | None = None) -> DataFrame:
    """Pairs with ``|b_ts - a_ts| <= delta_s`` as an equi-join on time buckets.

    Buckets are ``delta_s`` wide; each ``a`` row is copied to its own bucket and
    its two neighbours (three copies, fixed), so the join is a hash/sort-merge
    equi-join plus an exact residual filter rather than a nested loop.
    """
    ea = F.unix_micros(F.col(a_ts).cast("timestamp"))
    eb = F.unix_micros(F.col(b_ts).cast("timestamp"))
    width = F.lit(delta_s * 1_000_000)
    aa = (a.withColumn("_ta", ea)
          .withColumn("_bk", F.explode(F.array(*[F.floor(F.col("_ta") / width) + i for i in (-1, 0, 1)]))))
    bb = b.withColumn("_tb", eb).withColumn("_bk", F.floor(F.col("_tb") / width))
    joined = aa.join(bb, "_bk").where(F.abs(F.col("_tb") - F.col("_ta")) <= width)
    return joined.select(*select) if select is not None else joined.drop("_bk", "_ta", "_tb")


def around(df: DataFrame, one_row: DataFrame, ts: str, anchor_ts: str, delta_s: int) -> DataFrame:
    """J8 for one anchor: the rows of ``df`` within ``delta_s`` seconds of the time in a one-row
    frame.  The anchor is a scalar subquery, so this is a filter of one scan; without an
    anchor there are no rows."""
    anchor = one_row.select(F.unix_micros(F.col(anchor_ts).cast("timestamp"))).limit(1).scalar()
    here = F.unix_micros(F.col(ts).cast("timestamp"))
    return df.where(F.abs(here - anchor) <= delta_s * 1_000_000)


def substring_matches(haystack: DataFrame, text: str, needles: DataFrame, needle: str,
                      name: str = "matches", needles_are_bounded: bool = False) -> DataFrame:
    """For each needle, how many haystack rows hold it as a substring
    (``text LIKE '%' || needle || '%'``; ``%`` and ``_`` in a needle stand for themselves).

    Each haystack value is expanded to its distinct substrings of the lengths
    that needles have (one pass over the needles finds those lengths) and
    equi-joined with the needles, so no nested-loop join compares every pair.
    ``needles_are_bounded=True`` (a top-k or similar) broadcasts the needles, so the
    substrings are not shuffled.  Needles matching nothing get 0, an empty one matches all.
    """
    t = F.col(text).cast("string")
    wanted = needles.select(F.col(needle).alias("_needle"), F.col(needle).cast("string").alias("_sub")).distinct()
    sizes = wanted.agg(F.collect_set(F.length("_sub"))).first()[0]
    of_size = [F.when(F.length(t) >= n, F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda i: F.substring(t, i, F.lit(n))))
               if n else F.when(t.isNotNull(), F.array(F.lit(""))) for n in sorted(sizes)]
    subs = F.array_distinct(F.flatten(F.array_compact(F.array(*of_size)))) if of_size else F.array().cast("array<string>")
    exploded = haystack.select(F.explode(subs).alias("_sub"))
    side = F.broadcast(wanted) if needles_are_bounded else wanted
    hits = exploded.join(side, "_sub").groupBy("_needle").agg(F.count(F.lit(1)).alias(name))
    return (wanted.join(hits, "_needle", "left")
            .select(F.col("_needle").alias(needle), F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)))
