"""Graph operators over an edge table ``(src, dst)``.

BFS is a frontier loop of DataFrame joins.  Per round:

* ``frontier ⋈ edges`` on ``src`` – the edges are hash-partitioned on ``src``
  (plus a salt on ``dst`` sized from the largest out-degree, so a hub vertex
  spreads over several tasks) once and cached; each round shuffles only the
  frontier, copied once per salt value;
* newly reached vertices = destinations aggregated with their multiplicity,
  ``left_anti`` the visited set (the union of earlier frontiers);
* the new frontier is checkpointed into ``spark.checkpoint.dir`` every round,
  which cuts the lineage: a lost executor recomputes from the last round;
* the target's touch count is read from that checkpoint as an aggregate
  (exact under task retries, unlike an accumulator in a transformation).

A vertex gets the round it is first reached (true BFS; the reference's colour
merge could lose a doubly-reached vertex, which is not reproduced).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_path


@dataclass
class BfsResult:
    distances: DataFrame          # (vertex, distance) of every reached vertex
    rounds: int                   # rounds run
    hit_round: int | None = None  # first round that touched the target
    hits: int = 0                 # edges into the target expanded in that round


EDGES_PER_PARTITION = 2_000_000


def bfs(edges: DataFrame, start, max_rounds: int | None = None, target=None,
        stop_at_target: bool = True, partitions: int | None = None) -> BfsResult:
    """Breadth-first distances from ``start`` over directed edges, until no new
    vertex is reached or, if given, for at most ``max_rounds`` rounds.  With ``target``,
    also the first round that expands an edge into it and how many such edges
    (duplicates count) that round had.

    The loop's partition count is ``partitions`` or one per ``EDGES_PER_PARTITION``
    edges, and the loop's shuffles use it, so a small graph does not pay for hundreds
    of near-empty tasks and checkpoint files per round.  The edges are evaluated once
    (written to the shared folder) and the rounds run in a session of their own, so
    that no setting of the caller's session changes."""
    caller, base = edges.sparkSession, scratch_path(edges.sparkSession, "bfs")
    edges.select(F.col("src").cast("bigint").alias("src"),
                 F.col("dst").cast("bigint").alias("dst")).write.parquet(f"{base}/edges")
    spark = caller.newSession()
    raw = spark.read.parquet(f"{base}/edges")
    stats = (raw.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
             .agg(F.sum("deg").alias("n"), F.max("deg").alias("top")).first())
    n_edges, top = int(stats["n"] or 0), int(stats["top"] or 0)
    p = partitions or max(1, -(-n_edges // EDGES_PER_PARTITION))
    # a hub vertex's edges are spread over `salt` partitions, so that no task
    # expands more than about one partition's share of the edges
    salt = max(1, min(p, -(-top * p // max(n_edges, 1))))
    spark.conf.set("spark.sql.shuffle.partitions", str(p))
    result = _bfs_rounds(spark, raw, p, salt, start, max_rounds, target, stop_at_target)
    result.distances.write.parquet(f"{base}/distances")
    result.distances = caller.read.parquet(f"{base}/distances")
    return result


def _bfs_rounds(spark, raw: DataFrame, p: int, salt: int, start, max_rounds: int, target,
                stop_at_target: bool) -> BfsResult:
    # Cached (not checkpointed) so the plan keeps its hash partitioning on
    # (src, salt): every round then shuffles only the frontier, copied once per
    # salt value.  Its lineage is one scan and one shuffle, cheap to recompute
    # if an executor is lost.
    e = (raw.withColumn("_s", F.pmod(F.xxhash64("dst"), F.lit(salt)).cast("int"))
         .repartition(p, "src", "_s").persist())
    e.count()
    frontier = spark.range(1).select(F.lit(start).cast("bigint").alias("vertex"),
                                     F.lit(0).alias("distance"))
    visited = frontier
    result = BfsResult(distances=visited, rounds=0)
    tgt = F.lit(target).cast("bigint") if target is not None else None
    for r in count(1) if max_rounds is None else range(1, max_rounds + 1):
        # multiplicity of each reached vertex = edges expanded into it this round
        salted = frontier.withColumn("_fs", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        reached = (salted.join(e, (salted.vertex == e.src) & (salted._fs == e._s))
                   .groupBy(F.col("dst").alias("vertex")).agg(F.count(F.lit(1)).alias("mult")))
        cached = (reached.join(visited.select("vertex"), "vertex", "left_anti")
                  .select("vertex", F.lit(r).alias("distance"), "mult").coalesce(p).persist())
        # lazy checkpoint: the stats job below computes (and caches) the frame,
        # then Spark writes the checkpoint from the cache
        new = cached.checkpoint(eager=False)
        stats = new.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.when(F.col("vertex") == tgt, F.col("mult")) if tgt is not None
                              else F.lit(0)).alias("h")).first()
        cached.unpersist()
        result.rounds = r
        if stats["n"] == 0:
            break
        new = new.select("vertex", "distance")
        # earlier frontiers are checkpoints; coalescing keeps the union at p partitions
        visited = visited.unionByName(new).coalesce(p)
        frontier = new
        if stats["h"]:
            result.hit_round, result.hits = r, int(stats["h"])
            if stop_at_target:
                break
    result.distances = visited
    e.unpersist()
    return result


def target_report(spark, result: BfsResult, target) -> DataFrame:
    """One row ``(target, hit_round, hits)``; no row when never touched."""
    rows = [] if result.hit_round is None else [(int(target), result.hit_round, result.hits)]
    return spark.createDataFrame(rows, "target bigint, hit_round int, hits bigint")


def adjacency_lines(edges: DataFrame, order_key: list[str], max_neighbours: int = 1000) -> DataFrame:
    """Edge table -> adjacency text lines ``"src n1 n2 ..."``.

    A vertex with many neighbours is written on several lines of at most about
    ``max_neighbours`` entries (the format allows a vertex to span lines), so no
    line - and no aggregation group - grows with the vertex's degree.  Rows are
    spread over chunks by a hash of ``order_key`` (a unique key of the edge).
    """
    deg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("_deg"))
    with_k = edges.join(deg, "src").withColumn("_k", F.ceil(F.col("_deg") / max_neighbours))
    chunked = with_k.withColumn("_chunk", F.pmod(F.xxhash64(*order_key), F.col("_k")))
    return (chunked.groupBy("src", "_chunk")
            .agg(F.array_join(F.collect_list(F.col("dst").cast("string")), " ").alias("nbrs"))
            .select(F.concat_ws(" ", F.col("src").cast("string"), F.col("nbrs")).alias("value")))
