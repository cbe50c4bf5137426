"""Breadth-first search for one target from both ends.

The search keeps a frontier of vertices reached from the start along edges and one of vertices that
reach the target, along reversed edges, and expands the one with fewer edges to read, so a target
at distance D costs two searches of about D / 2 levels instead of one of D.  When a level meets the
other side, the distance is known.  The touch count, edges into the target from vertices one step
nearer, is exact: the meeting vertices are followed forward through the stored backward levels,
which hold just the vertices that can still arrive in time.

Levels are stored in ``spark.checkpoint.dir``; the driver sees one count per level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_path


@dataclass
class Meeting:
    distance: int | None = None   # None: the target cannot be reached
    hits: int = 0                 # edges into the target from vertices at distance - 1
    expanded: int = 0             # edges read by both searches
    levels: list[str] = field(default_factory=list)  # which side each step expanded


class _Side:
    """One search: its visited vertices, its levels, and the degree sum of the last level."""

    def __init__(self, edges: DataFrame, root, store):
        self.edges, self.store = edges, store
        self.levels = [store(edges.sparkSession.range(1).select(F.lit(root).cast("bigint").alias("vertex")))]
        self.visited = self.levels[0]
        self.cost = self._cost()

    def _cost(self) -> int:
        return self.edges.join(self.levels[-1], self.edges.a == F.col("vertex"), "left_semi").count()

    def expand(self) -> None:
        reached = self.edges.join(self.levels[-1], self.edges.a == F.col("vertex"), "left_semi").select(F.col("b").alias("vertex")).distinct()
        self.levels.append(self.store(reached.join(self.visited, "vertex", "left_anti")))
        self.visited = self.visited.unionByName(self.levels[-1])
        self.cost = self._cost()


def meet(edges: DataFrame, start, target) -> Meeting:
    """Distance of ``target`` from ``start`` over directed ``edges(src, dst)``, and its touch count.
    Parallel edges count each; rows with a null end are no edges; ``start == target`` is not a hit."""
    spark, base = edges.sparkSession, scratch_path(edges.sparkSession, "meet")
    stored = []

    def store(df: DataFrame) -> DataFrame:
        path = f"{base}/{len(stored)}"
        stored.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    every = store(edges.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst")).dropna())
    forward = _Side(every.select(F.col("src").alias("a"), F.col("dst").alias("b")), start, store)
    backward = _Side(every.select(F.col("dst").alias("a"), F.col("src").alias("b")), target, store)
    result = Meeting()
    if start == target:
        return result
    while forward.cost and backward.cost:
        side, other = (forward, backward) if forward.cost <= backward.cost else (backward, forward)
        result.expanded += side.cost
        result.levels.append("forward" if side is forward else "backward")
        side.expand()
        if not side.levels[-1].join(other.levels[-1], "vertex", "left_semi").isEmpty():
            result.distance = len(forward.levels) + len(backward.levels) - 2
            result.hits = _touches(forward, backward)
            return result
    return result


def _touches(forward: _Side, backward: _Side) -> int:
    """Edges into the target from vertices one step nearer, along the meeting vertices."""
    if len(backward.levels) == 1:  # the forward search has reached the target itself: its last step made the touches
        near = forward.levels[-2]
    else:
        near = forward.levels[-1].join(backward.levels[-1], "vertex", "left_semi")
        for level in backward.levels[-2:0:-1]:
            step = forward.edges.join(near, F.col("a") == F.col("vertex"), "left_semi").select(F.col("b").alias("vertex")).distinct()
            near = forward.store(step.join(level, "vertex", "left_semi"))
    last = backward.levels[0].select(F.col("vertex").alias("b"))
    return forward.edges.join(near, F.col("a") == F.col("vertex"), "left_semi").join(last, "b", "left_semi").count()
