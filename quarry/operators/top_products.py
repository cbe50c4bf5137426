"""The items with the largest inner products for every user (M7), without scoring every pair.

Items are ordered by their distance from the mean item and cut into blocks.  By Cauchy-Schwarz no item of a
later block scores more than ``user * mean + |user| * largest distance of the block``, so a user stops as soon
as the n-th score so far exceeds that bound.  (What all items have in common says nothing about which is best:
items of about the same length and direction are told apart by what is left.)  Rounds take 1, 2, 4, ... blocks,
the farthest items first: there are as many as the logarithm of the number of blocks, and each only sees the
users that have not stopped.

A round pairs packs of users with panels of its item blocks by an equi-join, multiplies them in numpy and
keeps n candidates of every user and panel, none below the user's n-th score so far; a ranking window (with
Spark's group limit before its shuffle) merges them with the best so far.  Matrix products only tell which
pairs can be among the best, with room for their rounding: these are summed again in the order of the
dimensions, so the rows do not depend on how the matrices are cut.  Tasks hold one pack, one panel and the
scores of a slice.  Rounds are tables in the shared scratch folder, so a lost executor repeats a part of
one round.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.positional import with_global_index
from quarry.session import scratch_path

#: Items of a block, and users of a pack: the bound of what a task multiplies at once.
BLOCK_ITEMS = 4096
PACK_USERS = 4096
#: Numbers in a panel of blocks, and scores that a task holds at once.
PANEL_NUMBERS = 1 << 19
SLICE_SCORES = 1 << 21

#: Room for rounding in the bound, as a share of it.
_SLACK = 1e-9


def _vectors(df: DataFrame, id_col: str, vec_col: str, name: str) -> DataFrame:
    """``(name, vec)`` of the rows whose id and vector have no nulls."""
    out = df.select(F.col(id_col).alias(name), F.col(vec_col).cast("array<double>").alias("vec"))
    return out.where(F.col(name).isNotNull() & F.col("vec").isNotNull() & ~F.exists("vec", F.isnull))


def _norm(vec) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x))


def _mean(vectors: DataFrame) -> list[float]:
    """The mean vector; zero in a dimension that has none."""
    each = vectors.select(F.posexplode("vec").alias("k", "x")).groupBy("k").agg(F.avg("x").alias("x")).orderBy("k").collect()
    return [r["x"] if math.isfinite(r["x"]) else 0.0 for r in each]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, each summed in the order of the dimensions, so that equal vectors tie exactly
    wherever they stand."""
    out = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        out += a[:, k, None] * b[None, :, k]
    return out


def _best(rows: np.ndarray, cols: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``n`` largest scores of every row; of equal ones the first columns."""
    order = np.lexsort((cols, -scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else rows
    own = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows)))) < n
    return rows[own], cols[own], scores[own]


def _candidates(a: np.ndarray, b: np.ndarray, n: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and inner product of the ``n`` largest of every row that are not below ``least``."""
    near = a @ b.T
    room = 8 * (a.shape[1] + 1) * np.finfo(float).eps * np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1).max()
    if np.isfinite(near).all() and np.isfinite(room).all():
        # the n-th largest of the groups' largest is no more than the n-th largest
        share = max(1, len(b) // (32 * n))
        groups = np.maximum.reduceat(near, np.arange(0, len(b), share), axis=1)
        m = groups.shape[1]
        bar = np.partition(groups, m - n, axis=1)[:, m - n] if n <= m else np.full(len(a), -np.inf)
        rows, cols = np.nonzero(near >= (np.maximum(bar, least) - room)[:, None])
        scores = np.zeros(len(rows))
        for k in range(a.shape[1]):
            scores += a[rows, k] * b[cols, k]
    else:
        rows, cols = np.divmod(np.arange(len(a) * len(b)), len(b))
        scores = _products(a, b).ravel()
    kept = scores >= least[rows]
    return _best(rows[kept], cols[kept], scores[kept], n)


def top_products(users: DataFrame, items: DataFrame, n: int, user: str, user_vec: str, item: str, item_vec: str,
                 block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``(user, rank, item, score, scored)``: the ``n`` items of largest inner product for every user, by score,
    then item; ``scored`` is how many items the user was compared with.

    Ids are unique and of any type that Spark can sort; vectors have one length.  Rows with a null id, vector
    or entry are left out.  With fewer than ``n`` items every user gets all; no items or no users give no rows."""
    spark = users.sparkSession
    base = scratch_path(spark, "top-products")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    things = kept(_vectors(items, item, item_vec, "item"), "items")
    mean = _mean(things)
    length = float(np.linalg.norm(mean))
    centre = F.lit(mean).cast("array<double>")
    far = things.withColumn("norm", _norm(F.zip_with("vec", centre, lambda x, m: x - m)))
    ordered = with_global_index(far, [F.col("norm").desc(), F.col("item")], "place")
    ordered = ordered.withColumn("block", F.floor(F.col("place") / block_items))
    rows = ordered.groupBy("block").agg(F.max("norm").alias("norm"), F.array_sort(F.collect_list(F.struct("item", "vec"))).alias("rows"))
    blocks = kept(rows.select("block", "norm", F.col("rows.item").alias("items"), F.col("rows.vec").alias("vecs")), "blocks")
    # the first block of every round: 0, 1, 3, 7, ...
    starts = blocks.where(F.expr("((block + 1) & block) = 0")).select("block", "norm").orderBy("block").collect()
    n_items, n_blocks = blocks.agg(F.coalesce(F.sum(F.size("items")), F.lit(0)), F.count(F.lit(1))).first()
    people = _vectors(users, user, user_vec, "user").withColumn("norm", _norm("vec"))
    shared = F.zip_with("vec", centre, lambda x, m: x * m)
    people = kept(people.withColumn("shared", F.aggregate(shared, F.lit(0.0), lambda s, x: s + x)), "users")
    user_type, item_type = (df.schema[c].dataType for df, c in ((people, "user"), (ordered, "item")))

    dim = max(1, (blocks.select(F.size(F.col("vecs")[0])).first() or [1])[0])
    panel_blocks = max(1, int(PANEL_NUMBERS // (dim * block_items)))

    def pack(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, PACK_USERS):
                batch = whole.slice(at, PACK_USERS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("user").to_pylist()], pa.list_(batch.schema.field("user").type)),
                     pa.array([batch.column("vec").flatten().to_numpy(zero_copy_only=False)], pa.list_(pa.float64())),
                     pa.array([batch.column("least").to_numpy(zero_copy_only=False)], pa.list_(pa.float64()))], names=["users", "pack", "bars"])

    def multiply(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                ids, things = one.column("users").flatten(), one.column("items").flatten()
                a, b = (one.column(c).flatten().to_numpy(zero_copy_only=False).reshape(len(i), -1) for c, i in (("pack", ids), ("flat", things)))
                least = one.column("bars").flatten().to_numpy(zero_copy_only=False)
                step = max(1, SLICE_SCORES // len(b))
                for at in range(0, len(a), step):
                    r, c, s = _candidates(a[at:at + step], b, n, least[at:at + step])
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(r + at)), things.take(pa.array(c)), pa.array(s)], names=["user", "item", "score"])

    names = f"user {user_type.simpleString()}, item {item_type.simpleString()}, score double"
    best = Window.partitionBy("user").orderBy(F.desc("score"), "item")
    tasks = 2 * spark.sparkContext.defaultParallelism
    active, before, done = people.withColumn("least", F.lit(float("-inf"))), None, []
    for r, start in enumerate(starts):
        end = 2 * start["block"] + 1  # of the round; the last one may have fewer blocks
        of_round = blocks.where((F.col("block") >= start["block"]) & (F.col("block") < end))
        # the rows of a panel in the order of the items, as ties need it
        rows = of_round.withColumn("panel", F.floor((F.col("block") - start["block"]) / panel_blocks)).select("panel", F.explode(F.arrays_zip("items", "vecs")).alias("x"))
        panels = rows.groupBy("panel").agg(F.array_sort(F.collect_list("x")).alias("x")).select(
            "panel", F.col("x.items").alias("items"), F.flatten("x.vecs").alias("flat"), F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"))
        packs = active.select("user", "vec", "least").mapInArrow(pack, f"users array<{user_type.simpleString()}>, pack array<double>, bars array<double>")
        n_panels = -(-(min(end, n_blocks) - start["block"]) // panel_blocks)
        packs = packs.withColumn("task", F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).cast("int")).withColumn(
            "panel", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_panels - 1).cast("long"))))
        spread = min(2000, tasks * n_panels)
        found = packs.repartition(spread, "panel", "task").join(panels.repartition(spread, "panel", "task"), ["panel", "task"]).mapInArrow(multiply, names)
        if before is not None:
            found = found.unionByName(before.where("more").select("user", "item", "score"))
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
        if r + 1 < len(starts):  # the n-th score, none yet, or below what the next items can reach
            bound = F.col("shared") + F.col("norm") * (starts[r + 1]["norm"] * (1 + _SLACK) + length * _SLACK)
            found = kept(found, f"best-{r}")
            state = people.select("user", "norm", "shared").join(found.groupBy("user").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("held")), "user")
            state = kept(state.select("user", ((F.col("held") < n) | (F.col("least") <= bound)).alias("more"),
                                      F.when(F.col("held") < n, float("-inf")).otherwise(F.col("least")).alias("least")), f"state-{r}")
            before = found.join(state.select("user", "more"), "user")
            active = people.join(state.where("more").select("user", "least"), "user")
        else:
            before = kept(found, f"best-{r}").withColumn("more", F.lit(False))
        seen = min(end * block_items, n_items)
        done.append(before.where(~F.col("more")).select("user", "rank", "item", "score", F.lit(seen).cast("long").alias("scored")))
        if r + 1 < len(starts) and state.where("more").isEmpty():
            break
    if not done:
        return spark.createDataFrame([], f"user {user_type.simpleString()}, rank int, item {item_type.simpleString()}, score double, scored bigint")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def recommend_for_all(model: ALSModel, n: int, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``recommendForAllUsers`` by the norms of the item factors: ``(user, rank, item, score, scored)``."""
    return top_products(model.userFactors, model.itemFactors, n, "id", "features", "id", "features", block_items)


__all__ = ["recommend_for_all", "top_products"]
