"""SimHash near-duplicates, linked through a vantage-point tree.

Words are runs without ``[\\x20\\x09-\\x0D]`` after A-Z is lower-cased; a shingle is
``shingle`` words joined by one space (a shorter text is one shingle, a text without words
has fingerprint zero).  A fingerprint bit is set when more than half of the shingle hashes
(XXH64, seed 42) have it.  Two documents link when their fingerprints differ in at most
``max_bits`` bits; a component is what links reach.

Equal fingerprints are folded first, so a group of exact copies is one point however large
it is.  The distinct points are partitioned by a vantage-point tree: a node holds a vantage
point and a radius; points within it go inside, others outside.  By the triangle inequality
two linked points on different sides lie within ``max_bits`` of the boundary, so inside
points of that band are also sent outside, and every linked pair meets in a shard: no pair
is lost and all other branches are pruned.  The tree is built on the driver from a bounded
sample (``sample_points``); the points themselves are dealt by Spark.  A shard that came out
too large is split again by the same rule inside its task, and links leave a shard as
(point, shard-local root) rows, never as all pairs of a group.  Components are joined by
star rounds (``common.components``).

Nulls: a null text counts as empty; rows with a null id get a fingerprint and take the
smallest non-null id of their component.  Rows repeated with the same id are alike.  An
empty table gives no rows.  Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import components, pinned, utf8

SEED = 42


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of UTF-8 text."""
    words = raw.lower().split()
    n = len(words)
    if not n:
        return 0
    text = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(text, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:n - shingle] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(text[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())], np.uint64)
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        count += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp bigint)``, the fingerprint as a signed long."""
    cut = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(raw, shingle) for raw in utf8(batch.column("_text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(prints.view(np.int64))], names=["_id", "fp"])

    return cut.mapInArrow(run, f"`_id` {cut.schema['_id'].dataType.simpleString()}, fp bigint").withColumnRenamed("_id", id_col)


def split_radius(points: np.ndarray, vantage: np.uint64, max_bits: int) -> tuple[int, np.ndarray]:
    """The radius that keeps the larger side smallest, the inside band counted on both."""
    d = np.bitwise_count(points ^ vantage)
    upto = np.cumsum(np.bincount(d, minlength=65))
    inside = upto[:64]
    band = inside - np.concatenate([np.zeros(max_bits, inside.dtype), inside])[:64]
    return int(np.argmin(np.maximum(inside, len(points) - inside + band))), d


class Tree:
    """Vantage points, radii and children as arrays; a negative child is leaf ``-1 - child``."""

    def __init__(self, points: np.ndarray, leaf_points: int, max_bits: int):
        self.max_bits, self.nodes, self.leaves = max_bits, [], 0
        self.root = self._build(np.unique(points), leaf_points)

    def _build(self, points: np.ndarray, leaf_points: int) -> int:
        if len(points) > leaf_points:
            vantage = points[len(points) // 2]
            radius, d = split_radius(points, vantage, self.max_bits)
            inside, outside = points[d <= radius], points[d > radius - self.max_bits]
            if max(len(inside), len(outside)) < 0.9 * len(points):
                at = len(self.nodes)
                self.nodes.append(None)
                self.nodes[at] = (vantage, radius, self._build(inside, leaf_points), self._build(outside, leaf_points))
                return at
        self.leaves += 1
        return -self.leaves

    def deal(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, index) of every point and of its boundary copies."""
        out, todo = [], [(self.root, np.arange(len(points)))]
        while todo:
            node, idx = todo.pop()
            if not len(idx):
                continue
            if node < 0:
                out.append((np.full(len(idx), -1 - node, np.int32), idx))
                continue
            vantage, radius, inside, outside = self.nodes[node]
            d = np.bitwise_count(points[idx] ^ vantage).astype(np.int32)
            todo += [(inside, idx[d <= radius]), (outside, idx[d > radius - self.max_bits])]
        if not out:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def shard_links(points: np.ndarray, max_bits: int, leaf_points: int) -> list[tuple[np.uint64, np.uint64]]:
    """(point, root) links that connect what is linked within one shard."""
    points = np.unique(points)
    if len(points) > leaf_points:
        tree = Tree(points, leaf_points, max_bits)
        if tree.nodes:
            leaf, idx = tree.deal(points)
            order = np.argsort(leaf, kind="stable")
            cuts = np.searchsorted(leaf[order], np.arange(tree.leaves + 1))
            out = []
            for k in range(tree.leaves):
                out += _scan(points[idx[order[cuts[k]:cuts[k + 1]]]], max_bits)
            return out
    return _scan(points, max_bits)


def _scan(points: np.ndarray, max_bits: int) -> list[tuple[np.uint64, np.uint64]]:
    """Breadth-first search by distance to all points not reached yet, 64 at a time."""
    left, out = points, []
    while len(left):
        root, left, frontier = left[0], left[1:], left[:1]
        while len(frontier) and len(left):
            head, frontier = frontier[:64], frontier[64:]
            near = (np.bitwise_count(head[:, None] ^ left[None, :]) <= max_bits).any(0)
            if near.any():
                hit, left = left[near], left[~near]
                out += [(p, root) for p in hit]
                frontier = np.concatenate([frontier, hit])
    return out


def links(points: DataFrame, max_bits: int = 2, leaf_points: int = 4096, sample_points: int = 50_000) -> DataFrame:
    """Links ``(a, b)`` between the distinct ``fp`` of ``points``, enough to give its components."""
    total = points.count()
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(sample_points).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    share = len(sample) / max(total, 1)
    tree = points.sparkSession.sparkContext.broadcast(Tree(sample, max(32, int(leaf_points * share)), max_bits))

    def deal(batches):
        for batch in batches:
            p = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            leaf, idx = tree.value.deal(p)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(p[idx].view(np.int64))], names=["leaf", "fp"])

    def join(table):
        p = table.column("fp").to_numpy().view(np.uint64)
        found = np.array(shard_links(p, max_bits, leaf_points), np.uint64).reshape(-1, 2)
        return pa.table({"a": pa.array(found[:, 0].copy().view(np.int64)), "b": pa.array(found[:, 1].copy().view(np.int64))})

    return points.select("fp").mapInArrow(deal, "leaf int, fp bigint").groupBy("leaf").applyInArrow(join, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
                    leaf_points: int = 4096, sample_points: int = 50_000) -> DataFrame:
    """``(id, fingerprint, component_id)`` per row, the fingerprint as 16 hexadecimal digits."""
    prints = pinned(fingerprints(docs, id_col, text_col, shingle))
    points = pinned(prints.groupBy("fp").agg(F.min(id_col).alias("rep")))
    parts = components(links(points, max_bits, leaf_points, sample_points))
    named = points.join(parts, points["fp"] == parts["node"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = named.join(lowest, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        F.col(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
