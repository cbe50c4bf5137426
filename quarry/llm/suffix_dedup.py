"""Repeated byte strings through a sparse, hash-compared suffix sort.

Every byte covered by a ``length``-byte string that also starts anywhere else (overlaps and
the same document included) is removed.  Texts are UTF-8 bytes; matches stay inside one
document.

Sorting the suffix of every byte of a corpus is not affordable, and not needed: each
``length``-byte window has a content-defined anchor (``anchors.pieces``), equal windows have
it at the same place, so it is enough to compare the suffixes that start at anchors.

1. Consecutive windows with one anchor form a piece, kept as (anchor hash, digest, document,
   position).  Pieces whose anchor occurs once are dropped (a join with the counted anchors).
2. Equal pieces are folded (pre-aggregated before the shuffle).  All windows of a piece that
   occurs twice are repeated: interiors of copies end here, however large the group.
3. Where an anchor has several different pieces, one representative of each is cut out with
   its context: the bytes from the anchor on and, reversed, those before it.
4. Spark range-partitions the contexts on (anchor, bytes), once by the right and once by the
   left side, so a hot anchor spreads over tasks.  Inside a task a mergesort orders them;
   prefix polynomial hashes and binary search find the common extension of two suffixes in a
   logarithmic number of hash comparisons.  Afterwards every neighbouring pair is compared
   byte by byte; should a hash collision have misplaced one, the run is sorted plainly.
   Neighbours across a partition boundary are compared from the first and last rows of the
   partitions (two rows each).
5. A neighbour with common extensions L to the left and R to the right of the anchor,
   ``L + R >= length``, marks the bytes from ``-L`` to ``+R``.  No partner reaches beyond the
   largest L and the largest R, which neighbours attain.  If the marks of the four neighbours
   fill that reach the anchor is settled; the anchors that are not settled are finished
   exactly, by counting the digests of the windows within the reach of all their pieces.

Null and empty texts have no bytes.  A row with a null id is no source and stays whole.  Rows
repeated with one id are one document and never repeat each other.  Very long texts are handled whole.  An empty
table gives no rows; only id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.anchors import merged, pieces
from quarry.llm.common import mix64, slices, stored, utf8, written

#: Bytes of an anchor.
GRAM = 16
#: Contexts sorted by one task; each has at most twice ``length`` bytes, each byte a hash of eight.
ROWS_PER_TASK = 8192
#: Whole contexts, times three, that Spark samples on the driver for a task's range.
SAMPLE_PER_TASK = 16
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _grams(buffer: bytes) -> np.ndarray:
    n = len(buffer) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    low = np.ndarray((n,), "<u8", buffer, 0, (1,))
    high = np.ndarray((n,), "<u8", buffer, 8, (1,))
    return mix64(low * _C1 ^ (high + _C1) * _C2)


def _cut(raws: list[bytes], length: int):
    """(bytes, grams, first byte per document, pieces) of some documents."""
    sizes = np.array([len(r) for r in raws], np.int64)
    first = np.cumsum(sizes) - sizes
    buffer = b"".join(raws)
    grams = _grams(buffer)
    return buffer, grams, first, pieces(grams, length - GRAM + 1, first, np.maximum(sizes - length + 1, 0))


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            raws = utf8(batch.column("text"))
            for a, b in slices([len(r) for r in raws]):
                _, grams, _, (_, _, at) = _cut(raws[a:b], length)
                yield pa.RecordBatch.from_arrays([pa.array(grams[at].view(np.int64))], names=["anchor"])

    return docs.select("text").mapInArrow(run, "anchor bigint")


def _pieces(docs: DataFrame, length: int) -> DataFrame:
    """``(anchor, k1, k2, id, start, windows, at)``: ``start`` and ``at`` (the anchor) in bytes of the document."""
    def run(batches):
        for batch in batches:
            raws = utf8(batch.column("text"))
            for a, b in slices([len(r) for r in raws]):
                buffer, grams, first, (start, windows, at) = _cut(raws[a:b], length)
                keys = np.frombuffer(b"".join([xxhash.xxh3_128_digest(buffer[i:j]) for i, j in zip(
                    start.tolist(), (start + windows + length - 1).tolist())]), "<i8").reshape(-1, 2)
                doc = np.searchsorted(first, start, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].view(np.int64)), pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), batch.column("id").take(pa.array(doc + a)),
                     pa.array(start - first[doc]), pa.array(windows), pa.array(at - first[doc])],
                    names=["anchor", "k1", "k2", "id", "start", "windows", "at"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"anchor bigint, k1 bigint, k2 bigint, id {kind}, start bigint, windows bigint, at bigint")


def _contexts(asked: DataFrame, length: int) -> DataFrame:
    """``(id, at, anchor, single, right, left)`` of the pieces asked for: the bytes of the piece's
    windows from the anchor on, and, reversed, those before it."""
    def run(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 128):
                batch = whole.slice(k, 128)
                rows, ats, anchors, singles, rights, lefts = [], [], [], [], [], []
                for row, (raw, wanted) in enumerate(zip(utf8(batch.column("text")), batch.column("wanted").to_pylist())):
                    for w in wanted:
                        at = w["at"]
                        rows.append(row)
                        ats.append(at)
                        anchors.append(w["anchor"])
                        singles.append(w["single"])
                        rights.append(raw[at:w["start"] + w["windows"] + length - 1])
                        lefts.append(raw[w["start"]:at][::-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(rows, pa.int64())), pa.array(ats, pa.int64()), pa.array(anchors, pa.int64()),
                     pa.array(singles, pa.bool_()), pa.array(rights, pa.binary()), pa.array(lefts, pa.binary())], names=["id", "at", "anchor", "single", "right", "left"])

    return asked.mapInArrow(run, f"id {asked.schema['id'].dataType.simpleString()}, at bigint, anchor bigint, single boolean, right binary, left binary")


class HashedStrings:
    """Byte strings with prefix polynomial hashes, compared through their common extension."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        n = len(self.data)
        # the value of a byte is a fixed random odd number; powers of an odd base can be inverted modulo 2^64
        value = mix64(np.arange(1, 257, dtype=np.uint64) * _C2) | np.uint64(1)
        longest = int(self.size.max(initial=0))
        steps = np.full(longest + 1, _C1, np.uint64)
        steps[0] = 1
        self.power = np.cumprod(steps, dtype=np.uint64)
        place = np.arange(n) - np.repeat(self.start, self.size)
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[self.data] * self.power[place], dtype=np.uint64)])

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of strings ``i`` and ``j``, by binary search."""
        a, b = self.start[i], self.start[j]
        low, high = np.zeros(len(i), np.int64), np.minimum(self.size[i], self.size[j])
        base_a, base_b = self.prefix[a], self.prefix[b]
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.prefix[a + mid] - base_a == self.prefix[b + mid] - base_b
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(string i < string j, equal)."""
        n = self.extension(i, j)
        end_i, end_j = n == self.size[i], n == self.size[j]
        last = max(len(self.data) - 1, 0)
        if not len(self.data):
            return np.zeros(len(i), bool), np.ones(len(i), bool)
        x, y = self.data[np.minimum(self.start[i] + n, last)], self.data[np.minimum(self.start[j] + n, last)]
        return np.where(end_i, ~end_j, ~end_j & (x < y)), end_i & end_j


def merge_sort(group: np.ndarray, first: HashedStrings, second: HashedStrings) -> np.ndarray:
    """Order by ``group`` (integers), then ``first``, then ``second``: bottom-up mergesort, all
    merges of a level at once; strings are only compared within a group.

    The place of a row in a merged pair of runs is its place in its own run plus the number
    of rows of the other run before it, found by binary search."""
    n = len(first.strings)
    order = np.argsort(group, kind="stable")

    def before(x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether row y sorts before row x; ``ties``: also when equal."""
        less = group[y] < group[x]
        for strings in (first, second):
            at = np.flatnonzero(group[y] == group[x]) if strings is first else at[equal]
            if not len(at):
                return less
            less[at], equal = strings.less(y[at], x[at])
        less[at[equal]] = ties[at[equal]]
        return less

    width = 1
    while width < n:
        place = np.arange(n)
        block = place // (2 * width) * (2 * width)
        is_left = place < block + width
        low = np.where(is_left, np.minimum(block + width, n), block)
        high = np.where(is_left, np.minimum(block + 2 * width, n), np.minimum(block + width, n))
        other = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            ahead = before(order[open_], order[mid], ~is_left[open_])
            low[open_] = np.where(ahead, mid + 1, low[open_])
            high[open_] = np.where(ahead, high[open_], mid)
        out = np.zeros_like(order)
        own = place - np.where(is_left, block, block + width)
        out[block + own + (low - other)] = order
        order, width = out, 2 * width
    return order


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, on the bytes themselves."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    diff = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(diff.argmax())


def _distinct(table: pa.Table) -> list[int]:
    """First row of each (id, at, anchor): rows repeated with one id are one document."""
    seen, out = set(), []
    for k, key in enumerate(zip(*[table.column(c).to_pylist() for c in ("id", "at", "anchor")])):
        if key not in seen:
            seen.add(key)
            out.append(k)
    return out


def _neighbours(contexts: DataFrame, path: str, side: str) -> DataFrame:
    """``contexts`` are stored at ``path``.  Pairs of neighbours in the order by ``side``: ``(id, at, anchor, l, r)`` for both ends of each pair.

    The last columns (``edge``, ``right``, ``left``) are set on copies of the first and last row of a partition."""
    other = "left" if side == "right" else "right"
    caller = contexts.sparkSession
    tasks = max(contexts.count() // ROWS_PER_TASK + 1, int(caller.conf.get("spark.sql.shuffle.partitions")))
    # read in a session of its own, whose range sample is small: the setting of the caller stays
    sampling = caller.newSession()
    sampling.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", SAMPLE_PER_TASK)
    dealt = sampling.read.schema(contexts.schema).parquet(path).repartitionByRange(tasks, "anchor", side, other, "id", "at")

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        table = table.take(pa.array(_distinct(table))).combine_chunks()
        anchor = table.column("anchor").to_numpy()
        own, rest = table.column(side).to_pylist(), table.column(other).to_pylist()
        order = merge_sort(anchor, HashedStrings(own), HashedStrings(rest))
        rows = list(zip(anchor.tolist(), own, rest))
        if (np.bincount(order, minlength=len(rows)) != 1).any() or any(rows[a] > rows[b] for a, b in zip(order[:-1].tolist(), order[1:].tolist())):
            order = np.array(sorted(range(len(rows)), key=rows.__getitem__), np.int64)
        i, j = order[:-1], order[1:]
        pair = np.flatnonzero(anchor[i] == anchor[j])
        i, j = i[pair].tolist(), j[pair].tolist()
        near = np.array([_common(own[x], own[y]) for x, y in zip(i, j)], np.int64)
        far = np.array([_common(rest[x], rest[y]) for x, y in zip(i, j)], np.int64)
        l, r = (far, near) if side == "right" else (near, far)
        pick = pa.array(i + j, pa.int64())
        none = pa.nulls(len(pick), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [table.column("id").take(pick).combine_chunks(), table.column("at").take(pick).combine_chunks(), table.column("anchor").take(pick).combine_chunks(),
             pa.array(np.concatenate([l, l])), pa.array(np.concatenate([r, r])), pa.nulls(len(pick), pa.int64()), none, none], names=names)
        number = TaskContext.get().partitionId()
        ends = pa.array([order[0], order[-1]], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [table.column("id").take(ends).combine_chunks(), table.column("at").take(ends).combine_chunks(), table.column("anchor").take(ends).combine_chunks(),
             pa.nulls(2, pa.int64()), pa.nulls(2, pa.int64()), pa.array([2 * number, 2 * number + 1]),
             table.column("right").take(ends).combine_chunks().cast(pa.binary()), table.column("left").take(ends).combine_chunks().cast(pa.binary())], names=names)

    names = ["id", "at", "anchor", "l", "r", "edge", "right", "left"]
    kind = contexts.schema["id"].dataType.simpleString()
    pairs = dealt.mapInArrow(run, f"id {kind}, at bigint, anchor bigint, l bigint, r bigint, edge bigint, right binary, left binary")
    found = caller.read.schema(pairs.schema).parquet(written(pairs, "neighbours", caller))

    # the last row of a partition against the first of the next one that has rows; the driver links
    # the numbers of the partitions, the rows meet in a join
    columns = ["id", "at", "anchor", "edge", "right", "left"]
    edges = found.where("edge is not null").select(*columns)
    numbers = sorted(r["n"] for r in edges.select(F.shiftright("edge", 1).alias("n")).distinct().collect())
    links = caller.createDataFrame([(2 * x + 1, 2 * y) for x, y in zip(numbers, numbers[1:])], "_last bigint, _next bigint")
    last, following = (edges.select(*[F.col(c).alias(f"{side}_{c}") for c in columns]) for side in "xy")
    met = last.join(links, F.col("x_edge") == F.col("_last")).join(following, F.col("_next") == F.col("y_edge")).where("x_anchor = y_anchor")

    def across(batches):
        for batch in batches:
            x_left, y_left, x_right, y_right = (batch.column(c).to_pylist() for c in ("x_left", "y_left", "x_right", "y_right"))
            l, r = ([_common(a, b) for a, b in zip(*sides)] for sides in ((x_left, y_left), (x_right, y_right)))
            for side in "xy":
                yield pa.RecordBatch.from_arrays([*[batch.column(f"{side}_{c}") for c in ("id", "at", "anchor")], pa.array(l, pa.int64()), pa.array(r, pa.int64())],
                                                 names=["id", "at", "anchor", "l", "r"])

    more = met.mapInArrow(across, f"id {kind}, at bigint, anchor bigint, l bigint, r bigint")
    return found.where("edge is null").select("id", "at", "anchor", "l", "r").unionByName(more)


def _branch_spans(contexts: DataFrame, path: str, length: int) -> DataFrame:
    """``(id, start, end)`` of what representatives at branches share; ``contexts`` are stored at ``path``."""
    pairs = _neighbours(contexts, path, "right").unionByName(_neighbours(contexts, path, "left"))
    hits = F.collect_list(F.when(F.col("l") + F.col("r") >= length, F.struct("l", "r")))
    reach = stored(pairs.groupBy("id", "at", "anchor").agg(F.max("l").alias("l"), F.max("r").alias("r"), hits.alias("hits")).where(
        F.col("l") + F.col("r") >= length), "reach")
    single = contexts.where("single").select(F.col("id").alias("_id"), F.col("at").alias("_at")).distinct()
    # bytes -l..r are settled when the windows of the pairs follow one another without a gap
    inside = F.aggregate(
        F.array_sort(F.transform("hits", lambda h: F.struct((-h["l"]).alias("a"), h["r"].alias("b")))),
        F.struct((-F.col("l") + (length - 1)).alias("to"), F.lit(True).alias("ok")),
        lambda acc, h: F.struct(F.greatest(acc["to"], h["b"]).alias("to"), (acc["ok"] & (h["a"] + (length - 1) <= acc["to"])).alias("ok")),
        lambda acc: acc["ok"] & (acc["to"] >= F.col("r")))
    judged = reach.withColumn("settled", F.coalesce(inside, F.lit(False)))
    spans = reach.select("id", "at", F.explode("hits").alias("h")).select(
        "id", (F.col("at") - F.col("h")["l"]).alias("start"), (F.col("at") + F.col("h")["r"]).alias("end"))
    # a piece that occurs twice is repeated as a whole and needs no settling
    open_ = judged.where(~F.col("settled")).join(single, (F.col("id") == F.col("_id")) & (F.col("at") == F.col("_at")), "left_semi")
    open_ = open_.select("anchor").distinct()
    wanted = reach.select("id", "at", "anchor", "l", "r").join(open_, "anchor")
    source = contexts.select(F.col("id").alias("_id"), F.col("at").alias("_at"), "right", "left")
    windows = wanted.join(source, (F.col("id") == F.col("_id")) & (F.col("at") == F.col("_at"))).select("id", "at", "l", "r", "right", "left")

    def digests(batches):
        for batch in batches:
            rows, starts, keys = [], [], []
            for row, (at, l, r, right, left) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("at", "l", "r", "right", "left")])):
                text = left[:l][::-1] + right[:r]
                for k in range(len(text) - length + 1):
                    rows.append(row)
                    starts.append(at - l + k)
                    keys.append(xxhash.xxh3_128_digest(text[k:k + length]))
            k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()), batch.column("id").take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64())],
                names=["k1", "k2", "id", "start"])

    each = stored(windows.mapInArrow(digests, f"k1 bigint, k2 bigint, id {contexts.schema['id'].dataType.simpleString()}, start bigint"), "windows")
    place = F.struct("id", "start")
    twice = each.groupBy("k1", "k2").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("k1", "k2")
    rest = each.join(twice, ["k1", "k2"]).select("id", "start", (F.col("start") + length).alias("end"))
    return spans.unionByName(rest)


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """``(id, spans array<struct<start, end>>)`` in bytes, for documents ``(id, text)`` with any."""
    counts = _anchors(docs, length).groupBy("anchor").agg(F.count("*").alias("n"))
    often = stored(counts.where(F.col("n") > 1).select("anchor"), "anchors")  # apart, so that Spark can split a hot anchor's join
    found = stored(_pieces(docs, length).join(often, "anchor"), "pieces")
    place = F.struct("id", "at", "start", "windows")
    source = found.groupBy("anchor", "k1", "k2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    twice = stored(source.where("first <> last").select("anchor", "k1", "k2"), "twice")
    copied = found.join(twice, ["anchor", "k1", "k2"]).select("id", "start", (F.col("start") + F.col("windows") + (length - 1)).alias("end"))
    # anchors with several pieces, one at least of which occurs once (the others are settled)
    branch = source.groupBy("anchor").agg(F.count("*").alias("pieces"), F.max(F.expr("first = last")).alias("any")).where("pieces > 1 AND any").select("anchor")
    wanted = source.join(branch, "anchor").select(F.col("first")["id"].alias("_id"), F.struct("first.at", "first.start", "first.windows", "anchor", F.expr("first = last").alias("single")).alias("w"))
    asked = docs.join(wanted.groupBy("_id").agg(F.collect_list("w").alias("wanted")), F.col("id") == F.col("_id")).select("id", "text", "wanted")
    made = _contexts(asked, length)
    path = written(made, "contexts")
    contexts = docs.sparkSession.read.schema(made.schema).parquet(path)
    # stored one by one, so that their shuffles do not use disk at once
    spans = stored(copied, "copied").unionByName(stored(_branch_spans(contexts, path, length), "branches"))
    return spans.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept binary, kept_sha256)``."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} bytes or more")
    cut = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = cut.where("id is not null")
    spans = stored(repeated_spans(known, length).select(F.col("id").alias("_id"), "spans"), "spans")
    joined = known.join(spans, F.col("id") == F.col("_id"), "left").select("id", "text", "spans")
    joined = joined.unionByName(cut.where("id is null"), allowMissingColumns=True)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = []
                for raw, spans_ in zip(utf8(batch.column("text")), batch.column("spans").to_pylist()):
                    gone = merged([(s["start"], s["end"]) for s in spans_ or ()], len(raw))
                    left, last = [], 0
                    for a, b in gone.tolist():
                        left.append(raw[last:a])
                        last = b
                    left.append(raw[last:])
                    kept = b"".join(left)
                    rows.append((len(raw), len(raw) - len(kept), len(gone), kept, hashlib.sha256(kept).hexdigest()))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.string())],
                                                 names=["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    kind = cut.schema["id"].dataType.simpleString()
    return joined.mapInArrow(run, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string").withColumnRenamed("id", id_col)
