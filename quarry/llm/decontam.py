"""Benchmark decontamination: item-sized SimHash windows, multi-index Hamming blocks, exact check.

An item of ``m`` words is compared with every window of ``m`` consecutive words of a
document, and with a document of fewer words as a whole.  Words are runs without white space, A-Z lower-cased; shingles are five words
(the whole sequence when there are fewer).

1. A window that shares no shingle with any item has similarity 0, so only windows that
   cover an item shingle are looked at (a bitmap, then an exact lookup, on rolling hashes).
2. SimHash of such a window from prefix sums of shingle bits.  Its fingerprint is split into
   eight blocks of eight bits: two fingerprints within ``radius`` bits have a block within
   ``radius // 8`` bits, so looking up each block's neighbourhood misses none within the
   radius.  The radius (23 of 64 by default) lies more than four standard deviations above
   the distance expected at similarity 0.8.
3. Every candidate is verified by the exact weighted Jaccard similarity of its shingles
   (weights: how often a shingle occurs), on the words themselves.

The items are a query set.  A block of at most ``items_per_block`` items travels with the
task; a larger benchmark takes more passes over the documents, whose matches are merged, so
no broadcast grows beyond that.

Null and empty texts and items have no words: they match nothing.  Items with equal text
are all reported; a match of an item whose id is null is reported with a null id.  Very long documents are scanned whole, in slices of whole documents.
An empty table gives no rows; an empty benchmark leaves every document clean.  Only the
named columns are read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import mix64, slices, utf8

SHINGLE = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.arange(64, dtype=np.uint64)
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_MAP_BITS = 20


def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Rolling hash of every ``size`` consecutive word hashes."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for k in range(1, size):
        out = out * _BASE + h[k:k + n]
    return mix64(out)


def simhash(counts: np.ndarray, n: int | np.ndarray) -> np.ndarray:
    """Fingerprints from set-bit counts [rows, 64] of ``n`` shingles."""
    return ((2 * counts > n).astype(np.uint64) << _BITS).sum(-1, dtype=np.uint64)


def bit_sums(h: np.ndarray) -> np.ndarray:
    """Prefix sums of the 64 bits of each hash, [len + 1, 64]."""
    out = np.zeros((len(h) + 1, 64), np.int32)
    np.cumsum((h[:, None] >> _BITS) & np.uint64(1), axis=0, dtype=np.int32, out=out[1:])
    return out


def shingles(words: list[bytes]) -> Counter:
    size = min(SHINGLE, len(words))
    return Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def weighted_jaccard(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


class Index:
    """Items grouped by length, with their block neighbourhoods."""

    def __init__(self, items: list[tuple[int, bytes]], radius: int):
        self.radius, per_block = radius, radius // 8
        self.groups, seen = {}, {}
        for item, raw in items:
            words = words_of(raw)
            if words:
                self.groups.setdefault(len(words), []).append((item, words))
        self.known = {}
        for m, group in self.groups.items():
            size = min(SHINGLE, m)
            hashes = [shingle_hashes(word_hashes(w), size) for _, w in group]
            seen.setdefault(size, []).extend(hashes)
            prints = np.array([simhash(bit_sums(h)[-1], len(h)) for h in hashes], np.uint64)
            blocks = prints.view(np.uint8).reshape(-1, 8)
            near = [_POPCOUNT[np.arange(256)[:, None] ^ blocks[None, :, b]] <= per_block for b in range(8)]
            self.groups[m] = ([i for i, _ in group], [shingles(w) for _, w in group], prints, near)
        for size, hashes in seen.items():
            exact = np.unique(np.concatenate(hashes))
            bitmap = np.zeros(1 << _MAP_BITS, bool)
            bitmap[exact >> np.uint64(64 - _MAP_BITS)] = True
            self.known[size] = (bitmap, exact)

    def hits(self, h: np.ndarray, size: int) -> np.ndarray:
        """Positions whose shingle occurs in an item."""
        bitmap, exact = self.known[size]
        s = shingle_hashes(h, size)
        at = np.flatnonzero(bitmap[s >> np.uint64(64 - _MAP_BITS)])
        k = np.minimum(np.searchsorted(exact, s[at]), len(exact) - 1)
        return at[exact[k] == s[at]]

    def matches(self, words: list[bytes], h: np.ndarray, hits: dict[int, np.ndarray], least: float) -> dict[int, tuple[float, int, int]]:
        """Best (similarity, start, end) in words per item of one document."""
        best: dict[int, tuple[float, int, int]] = {}
        for m, (ids, counts, prints, near) in self.groups.items():
            size = min(SHINGLE, m)
            at = hits[size]
            if not len(at):
                continue
            m = min(m, len(words))
            starts = np.unique((at[:, None] - np.arange(m - size + 1)[None, :]).ravel())
            starts = starts[(starts >= 0) & (starts <= len(words) - m)]
            for part in np.array_split(starts, len(starts) // 65536 + 1):
                if not len(part):
                    continue
                lo, hi = int(part[0]), int(part[-1]) + m
                sums = bit_sums(shingle_hashes(h[lo:hi], size))
                n = m - size + 1
                own = simhash(sums[part - lo + n] - sums[part - lo], n)
                blocks = own.view(np.uint8).reshape(-1, 8)
                found = near[0][blocks[:, 0]]
                for b in range(1, 8):
                    found = found | near[b][blocks[:, b]]
                w, j = np.nonzero(found)
                ok = np.bitwise_count(own[w] ^ prints[j]) <= self.radius
                for start, k in zip(part[w[ok]].tolist(), j[ok].tolist()):
                    similar = weighted_jaccard(shingles(words[start:start + m]), counts[k])
                    if similar >= least and similar > best.get(ids[k], (0.0,))[0]:
                        best[ids[k]] = (similar, start, start + m)
        return best


def matches(docs: DataFrame, items: list[tuple[int, str | None]], keep: tuple[str, ...] = (), id_col: str = "doc_id",
            text_col: str = "text", similarity: float = 0.8, radius: int = 23) -> DataFrame:
    """One pass: ``(id, keep..., items array<bigint>, max_similarity, spans)`` for every document,
    ``spans`` as ``item:first word:end word``."""
    index = Index([(i, (t or "").encode()) for i, t in items], radius)
    held = docs.sparkSession.sparkContext.broadcast(index)
    kept = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(k) for k in keep])
    names = ["_id", *keep, "items", "max_similarity", "spans"]
    schema = ", ".join([f"`_id` {kept.schema['_id'].dataType.simpleString()}", *[f"`{k}` {kept.schema[k].dataType.simpleString()}" for k in keep],
                        "items array<bigint>, max_similarity double, spans string"])

    def run(batches):
        index = held.value
        for batch in batches:
            raws = utf8(batch.column("_text"))
            out = [([], 0.0, "")] * len(raws)
            for a, b in slices([len(r) for r in raws]):
                split = [words_of(r) for r in raws[a:b]]
                ends = np.cumsum([len(w) for w in split])
                h = word_hashes([x for w in split for x in w])
                starts = ends - [len(w) for w in split]
                touched = {size: index.hits(h, size) for size in index.known}
                docs_hit = np.unique(np.concatenate([np.searchsorted(ends, p, "right") for p in touched.values()])) if touched else []
                for d in docs_hit:
                    lo, hi = int(starts[d]), int(ends[d])
                    mine = {size: p[(p >= lo) & (p + size <= hi)] - lo for size, p in touched.items()}
                    best = index.matches(split[d], h[lo:hi], mine, similarity)
                    if best:
                        ids = sorted(best, key=lambda i: (i is None, i))
                        out[a + d] = (ids, max(best[i][0] for i in ids), ",".join(f"{'null' if i is None else i}:{best[i][1]}:{best[i][2]}" for i in ids))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *[batch.column(k) for k in keep], pa.array(cols[0], pa.list_(pa.int64())),
                 pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.string())], names=names)

    return kept.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", items_per_block: int = 20_000):
    """The benchmark as blocks of at most ``items_per_block`` ``(id, text)``, in id order."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    block: list[tuple[int, str | None]] = []
    for r in rows.orderBy("i").toLocalIterator():
        block.append((r["i"], r["t"]))
        if len(block) == items_per_block:
            yield block
            block = []
    if block:
        yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = (), items_per_block: int = 20_000, **options) -> DataFrame:
    """``(doc_id, keep..., items, n_items, max_similarity, spans, contaminated)`` for every document."""
    passes = [matches(docs, block, keep, **options) for block in item_blocks(benchmark, items_per_block=items_per_block)] or [
        matches(docs, [], keep, **options)]
    out = passes[0]
    if len(passes) > 1:  # the passes read the same rows; the matches of a document are merged
        id_col = options.get("id_col", "doc_id")
        first, rest = passes[0], passes[1:]
        found = rest[0].select(id_col, "items", "max_similarity", "spans")
        for p in rest[1:]:
            found = found.unionByName(p.select(id_col, "items", "max_similarity", "spans"))
        more = found.where(F.size("items") > 0).distinct().groupBy(F.col(id_col).alias("_id")).agg(
            F.flatten(F.collect_list("items")).alias("_items"), F.max("max_similarity").alias("_max"),
            F.concat_ws(",", F.collect_list("spans")).alias("_spans"))
        joined = first.join(more, first[id_col].eqNullSafe(more["_id"]), "left")
        out = joined.select(
            first[id_col], *[first[k] for k in keep],
            F.array_sort(F.array_distinct(F.concat("items", F.coalesce("_items", F.array().cast("array<bigint>"))))).alias("items"),
            F.greatest("max_similarity", F.coalesce("_max", F.lit(0.0))).alias("max_similarity"),
            F.array_join(F.filter(F.array("spans", F.coalesce("_spans", F.lit(""))), lambda s: s != ""), ",").alias("spans"))
    return out.withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", F.size("items") > 0)
