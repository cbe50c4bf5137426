"""ALS recommendations (M6-M9) on ``pyspark.ml``.

ALS itself is Spark's distributed block solver; we only prepare ids, seed it
(the reference did not) and attach names with joins instead of driver maps.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.joins import lookup

# The reference's ALS settings.
ALS_RANK = 8
ALS_ITERATIONS = 20
ALS_LAMBDA = 0.01

# Ratings that one factor block holds when the number of blocks is not given.
RATINGS_PER_BLOCK = 50_000_000

# The same for executors of a few GB: a task that builds a block holds its ratings several times over (as they
# came, sorted, packed).
SMALL_EXECUTOR_RATINGS = 10_000_000

# Blocks of a side when not given.  Every factor is sent to all blocks of the other side that rate it, in
# every iteration, so the shuffle grows with the blocks: ten only for as many ratings as ten small blocks hold.
SMALL_BLOCKS, SMALL_RATINGS = 10, 5_000_000
LEAST_BLOCKS = 4

# Iterations between two checkpoints when not given: shuffles are kept until the next one, so with more than
# ``SMALL_BLOCKS`` blocks they are fewer.
CHECKPOINT_INTERVAL, MANY_BLOCKS_INTERVAL = 10, 2


def train_als(ratings: DataFrame, user: str, item: str, rating: str, rank: int = ALS_RANK,
              max_iter: int = ALS_ITERATIONS, reg: float = ALS_LAMBDA, seed: int = 42,
              checkpoint_interval: int | None = None, blocks: int | None = None,
              ratings_per_block: int = RATINGS_PER_BLOCK) -> ALSModel:
    """M6: explicit-feedback ALS.  Ids must fit in int (use ``dense_ids`` or
    ``hash23`` for string ids).  The factor lineage is checkpointed into
    ``spark.checkpoint.dir`` every ``checkpoint_interval`` iterations (``CHECKPOINT_INTERVAL``, or
    ``MANY_BLOCKS_INTERVAL`` with many blocks, when not given).  ``blocks`` is the
    number of factor blocks on each side: ``SMALL_BLOCKS`` for up to ``SMALL_RATINGS`` ratings, else
    one per ``ratings_per_block``, ``LEAST_BLOCKS`` or more, when not given."""
    if blocks is None:
        n = ratings.count()
        blocks = SMALL_BLOCKS if n <= SMALL_RATINGS else max(LEAST_BLOCKS, -(-n // ratings_per_block))
    if checkpoint_interval is None:
        checkpoint_interval = CHECKPOINT_INTERVAL if blocks <= SMALL_BLOCKS else MANY_BLOCKS_INTERVAL
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, numUserBlocks=blocks, numItemBlocks=blocks,
              userCol=user, itemCol=item, ratingCol=rating,
              coldStartStrategy="drop", checkpointInterval=checkpoint_interval)
    return als.fit(ratings.select(F.col(user).cast("int").alias(user),
                                  F.col(item).cast("int").alias(item),
                                  F.col(rating).cast("float").alias(rating)))


def recommend_for_users(model: ALSModel, users: DataFrame, k: int = 10) -> DataFrame:
    """M7: top ``k`` items per user in ``users`` as flat rows
    ``(user, item, predicted, rank)``; items already rated are *not* excluded
    (as in the reference).  Unknown users yield no rows."""
    ucol, icol = model.getUserCol(), model.getItemCol()
    recs = model.recommendForUserSubset(users.select(F.col(ucol).cast("int").alias(ucol)), k)
    return (recs.select(ucol, F.posexplode("recommendations").alias("pos", "rec"))
            .select(F.col(ucol).alias("user"), F.col(f"rec.{icol}").alias("item"),
                    F.col("rec.rating").cast("double").alias("predicted"),
                    (F.col("pos") + 1).alias("rank")))


def user_history(ratings: DataFrame, user: str, user_id, item: str, names: DataFrame,
                 name_key: str, name_col: str) -> DataFrame:
    """M8: the ratings of one user with item names (P22 + J4)."""
    mine = ratings.where(F.col(user) == F.lit(user_id))
    return lookup(mine, names, item, name_key, [name_col])
