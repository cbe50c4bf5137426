"""Repeated word spans through a compacted de Bruijn graph.

Words are runs without ``[\\x20\\x09-\\x0D]``; every ``window`` consecutive words of a document
are an edge of the graph, between its first and its last ``window - 1`` words.  A word is
removed when an edge that covers it also starts earlier (smaller id, or same document and
earlier position).

Writing out every edge would shuffle the whole corpus many times over, so edges travel
compacted, in pieces: consecutive edges that share one anchor (``anchors.pieces``; equal
edges have equal anchors) form a nonbranching path, kept as (anchor, digest of its words,
source document, position).

1. Anchors are counted; only pieces whose anchor occurs twice or more go on (a join).
2. Equal pieces are folded to the earliest source (pre-aggregated before the shuffle, so a
   passage in a third of all documents is one row per task), and joined back to their
   occurrences: every edge of an occurrence that is not the source is repeated.
3. Where an anchor has several different pieces the graph branches.  There the source of
   each piece is read again at its coordinates and its edges are written out; an edge's
   earliest source decides for the sources themselves.
4. The marked spans of a document are merged into maximal paths and cut from its words.

Digests are XXH3-128 of the words themselves (96 bits beside the 64-bit anchor travel with
a piece, 128 bits with an edge), so that a match is not left to one hash.  All joins can be
split by Spark when a key is hot; what is gathered per document is bounded by that
document.  Nothing is collected on the driver.

Null and empty texts have no words.  A row with a null id is no source and stays whole.  Rows
repeated with one id are one document: they never repeat each other.  Very long documents are handled whole.  An
empty table gives no rows; only id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.anchors import merged, pieces
from quarry.llm.common import mix64, slices, stored, utf8

#: Words of an anchor.
GRAM = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _grams(words: list[bytes]) -> np.ndarray:
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(len(h) - GRAM + 1, 0)
    out = h[:n].copy()
    for k in range(1, GRAM):
        out = out * _BASE + h[k:k + n]
    return mix64(out)


def _bounds(words: list[bytes]) -> tuple[bytes, list[int], list[int]]:
    """The words joined by spaces, and the start and end of each."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(words) else ends
    return b" ".join(words), starts.tolist(), ends.tolist()


#: The low half of a packed piece: its number of edges.
_LOW = (1 << 32) - 1


def _cut(raws: list[bytes], window: int):
    """(words, grams, first word per document, pieces) of some documents."""
    split = [r.split() for r in raws]
    sizes = np.array([len(w) for w in split], np.int64)
    first = np.cumsum(sizes) - sizes
    words = [w for s in split for w in s]
    grams = _grams(words)
    return words, grams, first, pieces(grams, window - GRAM + 1, first, np.maximum(sizes - window + 1, 0))


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """``anchor`` of every piece."""
    def run(batches):
        for batch in batches:
            raws = utf8(batch.column("text"))
            for a, b in slices([len(r) for r in raws]):
                _, grams, _, (_, _, at) = _cut(raws[a:b], window)
                yield pa.RecordBatch.from_arrays([pa.array(grams[at].view(np.int64))], names=["anchor"])

    return docs.select("text").mapInArrow(run, "anchor bigint")


def _pieces(docs: DataFrame, window: int) -> DataFrame:
    """``(anchor, k1, k2, id, at)``: digest of the words, document and ``position << 32 | edges``."""
    def run(batches):
        for batch in batches:
            raws = utf8(batch.column("text"))
            for a, b in slices([len(r) for r in raws]):
                words, grams, first, (start, edges, at) = _cut(raws[a:b], window)
                text, begin, end = _bounds(words)
                digest = xxhash.xxh3_128_digest
                keys = np.frombuffer(b"".join([digest(text[begin[i]:end[j]]) for i, j in zip(
                    start.tolist(), (start + edges + window - 2).tolist())]), "<u8").reshape(-1, 2)
                doc = np.searchsorted(first, start, "right") - 1  # documents without words share a start with the next one
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].view(np.int64)), pa.array(keys[:, 0].astype(np.int64)), pa.array((keys[:, 1] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                     batch.column("id").take(pa.array(doc + a)), pa.array((start - first[doc]).astype(np.int64) << 32 | edges)], names=["anchor", "k1", "k2", "id", "at"])

    return docs.mapInArrow(run, f"anchor bigint, k1 bigint, k2 int, id {docs.schema['id'].dataType.simpleString()}, at bigint")


def _edges(asked: DataFrame, window: int) -> DataFrame:
    """``(e1, e2, id, start)`` for every edge of the pieces asked for in ``(id, text, at array)``."""
    def run(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                ids, starts, digests = [], [], []
                for row, (raw, pieces_) in enumerate(zip(utf8(batch.column("text")), batch.column("at").to_pylist())):
                    text, begin, end = _bounds(raw.split())
                    own = [s for p in sorted(set(pieces_)) for s in range(p >> 32, (p >> 32) + (p & _LOW)) if s + window <= len(end)]
                    digests += [xxhash.xxh3_128_digest(text[begin[s]:end[s + window - 1]]) for s in own]
                    starts += own
                    ids += [row] * len(own)
                keys = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), batch.column("id").take(pa.array(ids, pa.int64())), pa.array(starts, pa.int64())],
                    names=["e1", "e2", "id", "start"])

    return asked.mapInArrow(run, f"e1 bigint, e2 bigint, id {asked.schema['id'].dataType.simpleString()}, start bigint")


def repeated_spans(docs: DataFrame, window: int) -> DataFrame:
    """``(id, spans array<struct<start, end>>)`` in words, for documents ``(id, text)`` with any."""
    counts = _anchors(docs, window).groupBy("anchor").agg(F.count("*").alias("n"))
    often = stored(counts.where(F.col("n") > 1).select("anchor"), "anchors")  # apart, so that Spark can split a hot anchor's join
    found = stored(_pieces(docs, window).join(often, "anchor"), "pieces")
    source = found.groupBy("anchor", "k1", "k2").agg(F.count("*").alias("n"), F.min(F.struct("id", "at")).alias("first"))
    # occurrences of a piece that are not its source
    again = stored(source.where(F.col("n") > 1).select("anchor", "k1", "k2", "first"), "again")
    copies = found.join(again, ["anchor", "k1", "k2"]).where(~((F.col("id") == F.col("first")["id"]) & (F.col("at") == F.col("first")["at"])))
    start = F.shiftright("at", 32)
    copied = copies.select("id", start.alias("start"), (start + F.col("at").bitwiseAND(F.lit(_LOW)) + (window - 1)).alias("end"))
    # sources at branches: anchors with several different pieces
    branch = source.groupBy("anchor").agg(F.count("*").alias("pieces")).where(F.col("pieces") > 1).select("anchor")
    sources = source.join(branch, "anchor").select(F.col("first")["id"].alias("_id"), F.col("first")["at"].alias("at"))
    asked = sources.groupBy("_id").agg(F.collect_list("at").alias("at"))
    edges = stored(_edges(docs.join(asked, F.col("id") == F.col("_id")).select("id", "text", "at"), window), "edges")
    first = edges.groupBy("e1", "e2").agg(F.count("*").alias("n"), F.min(F.struct("id", "start")).alias("first")).where(F.col("n") > 1)
    later = edges.join(first.select("e1", "e2", "first"), ["e1", "e2"]).where(
        ~((F.col("id") == F.col("first")["id"]) & (F.col("start") == F.col("first")["start"])))
    later = later.select("id", "start", (F.col("start") + window).alias("end"))
    # stored one by one, so that the shuffles of both do not use disk at once
    spans = stored(copied, "copied").unionByName(stored(later, "later"))
    return spans.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_removed, n_spans, kept, kept_sha256)``; ``kept`` are the words left, joined by spaces."""
    if window < GRAM:
        raise ValueError(f"window must be {GRAM} words or more")
    cut = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = cut.where("id is not null")
    # stored, so that its shuffles and that of the documents do not use disk at once
    spans = stored(repeated_spans(known, window).select(F.col("id").alias("_id"), "spans"), "spans")
    joined = known.join(spans, F.col("id") == F.col("_id"), "left").select("id", "text", "spans")
    joined = joined.unionByName(cut.where("id is null"), allowMissingColumns=True)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = []
                for raw, spans_ in zip(utf8(batch.column("text")), batch.column("spans").to_pylist()):
                    words = raw.split()
                    gone = merged([(s["start"], s["end"]) for s in spans_ or ()], len(words))
                    left, last = [], 0
                    for a, b in gone.tolist():
                        left += words[last:a]
                        last = b
                    left += words[last:]
                    kept = b" ".join(left)
                    rows.append((len(words), len(words) - len(left), len(gone), kept.decode(), hashlib.sha256(kept).hexdigest()))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())],
                                                 names=["id", "n_words", "n_removed", "n_spans", "kept", "kept_sha256"])

    kind = cut.schema["id"].dataType.simpleString()
    return joined.mapInArrow(run, f"id {kind}, n_words bigint, n_removed bigint, n_spans bigint, kept string, kept_sha256 string").withColumnRenamed("id", id_col)
