"""SentencePiece (BPE type) encoding with seeded merge-dropout, and decoding.

A text is cut before every space that follows a non-space and around line feeds (no piece
of the vocabulary crosses these; that is checked when the vocabulary is read).  Within a
cut the symbols start as characters, and an agenda holds the adjacent pairs whose
concatenation is a piece, best score first, leftmost first among equals.  A pair that comes
up is merged, unless a keyed hash of (seed, row id, ordinal of the cut in the text, piece,
position in the cut) falls under ``dropout``: then that candidate is skipped.  ``dropout=0``
gives the plain encoding, ``dropout=1`` characters.  So every candidate of every place is drawn
for itself.  What is kept in a bounded cache is no outcome of a draw but a word's plain agenda: a
place that skips none of its candidates has the plain ids, any other is merged anew.  Nothing depends on partitions or attempts: a repeated task gives the same ids.

Characters without a piece fall back to bytes, U+2581 (the vocabulary's space mark) too, so
every segmentation decodes to the very text; each row is decoded and compared.

The vocabulary file is read once on the driver (its path is a parameter) and sent to the
executors; its size is that of the vocabulary.

Null text: null ids, n_tokens 0, round_trip true.  Empty text: no ids.  Very long texts are
encoded whole.  Repeated rows with one id get the same ids.  Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import mix64, slices

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_CUT = re.compile(r" *[^ \n]+| +|\n")
_MASK = (1 << 64) - 1
_SLOTS = (1 << 20) - 1
_NEVER = np.int32(1 << 30)
_K1, _K2 = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return ((h ^ (h >> np.uint64(29))) >> np.uint64(12)).astype(np.int64) & _SLOTS


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The indices ``start, start + 1, ...`` of runs, ``count`` of each."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _parted(ids: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    return np.split(ids, np.cumsum(count)[:-1]) if len(count) else []


class _Numbers(dict):
    """Numbers of known cuts, -1 for others."""

    def __missing__(self, cut):
        return -1


def read_vocabulary(path: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind is ``piece``, ``byte`` or ``other`` (controls, unknown)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = ((model.is_byte, "byte"), (model.is_control, "other"), (model.is_unknown, "other"), (model.is_unused, "other"))
    return [(model.id_to_piece(i), model.get_score(i), next((k for f, k in kinds if f(i)), "piece")) for i in range(model.get_piece_size())]


class Codec:
    """Encodes with merge-dropout and decodes; ``cache`` agendas bound the memory."""

    def __init__(self, vocabulary: list[tuple[str, float, str]], dropout: float = 0.1, seed: int = 0, cache: int = 400_000):
        self.ids = {p: i for i, (p, _, kind) in enumerate(vocabulary) if kind == "piece"}
        self.rank = {p: (-vocabulary[i][1], i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(vocabulary) if kind == "byte"}
        if len(self.bytes) < 256:
            raise ValueError("the vocabulary has no byte fallback")
        pieces = [bytes([int(p[3:5], 16)]) if kind == "byte" else p.replace(MARK, " ").encode() if kind == "piece" else b"" for p, _, kind in vocabulary]
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.splits = not any("\n" in p[:-1] + p[1:] or re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.seed, self.limit = seed, cache
        self.cut_off = int(dropout * 2**32)
        self._forget()
        # symbol of every code point (negative: bytes), and an open-addressing table of the pairs
        self.symbol = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        self.symbol[ord(" ")], self.symbol[ord(MARK)] = self.ids.get(MARK, -1), -1
        scores = {x: k for k, x in enumerate(sorted({r for r, _ in self.rank.values()}))}
        pairs = [(self.ids[p[:k]], self.ids[p[k:]], scores[self.rank[p][0]], i) for p, i in self.ids.items()
                 for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        left, right, rank, into = (np.array(x, np.int64) for x in zip(*pairs))
        self.pair_key, self.pair_rank, self.pair_id = np.full(_SLOTS + 1, -1, np.int64), np.zeros(_SLOTS + 1, np.int32), np.zeros(_SLOTS + 1, np.int32)
        key, slot, probe, rows = (left << 32) | right, _slot(left, right), 0, np.arange(len(left))
        while len(rows):  # of the pairs that want a free slot the first gets it, the others probe on
            s = (slot[rows] + probe) & _SLOTS
            free = np.flatnonzero(self.pair_key[s] < 0)
            won = free[np.unique(s[free], return_index=True)[1]]
            self.pair_key[s[won]], self.pair_rank[s[won]], self.pair_id[s[won]] = key[rows[won]], rank[rows[won]], into[rows[won]]
            rows, probe = np.delete(rows, won), probe + 1
        self.probes = probe

    def merged(self, cut: str, variant: int) -> list[int]:
        """Ids of one cut (spaces as spaces) under the draws of the key ``variant``."""
        return self._agenda(cut, self._key(variant))[0]

    def _key(self, variant: int) -> int:
        return (self.seed * 0x9E3779B97F4A7C15 + variant * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) & _MASK

    def _agenda(self, cut: str, key: int | None) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids of one cut, and its candidates (piece, position) in the order they come up.  Those
        drawn under ``key`` are skipped, without a key none."""
        symbols = [MARK if c == " " else None if c == MARK else c for c in cut]  # None never joins a pair
        n, rank = len(symbols), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            if symbols[i] is not None and symbols[i + 1] is not None:
                r = rank.get(symbols[i] + symbols[i + 1])
                if r:
                    agenda.append((r[0], i, i + 1, symbols[i] + symbols[i + 1], r[1]))
        heapify(agenda)
        cut_off, candidates = self.cut_off, []
        while agenda:
            _, i, j, piece, number = heappop(agenda)
            if j >= n or after[i] != j or symbols[i] is None or symbols[j] is None or symbols[i] + symbols[j] != piece:
                continue
            candidates.append((number, i))
            if cut_off and key is not None:
                h = (key ^ (number * _K1) ^ ((i + 1) * _K2)) & _MASK
                h = ((h ^ (h >> 32)) * _K1) & _MASK
                if ((h ^ (h >> 29)) >> 16) & 0xFFFFFFFF < cut_off:
                    continue
            symbols[i], symbols[j] = piece, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if symbols[k] is not None:
                    r = rank.get(piece + symbols[k])
                    if r:
                        heappush(agenda, (r[0], i, k, piece + symbols[k], r[1]))
            h = before[i]
            if h >= 0 and symbols[h] is not None:
                r = rank.get(symbols[h] + piece)
                if r:
                    heappush(agenda, (r[0], h, i, symbols[h] + piece, r[1]))
        out, i = [], 0
        while i < n:
            known = self.ids.get(symbols[i]) if symbols[i] is not None else None
            if known is not None:
                out.append(known)
            else:
                out += [self.bytes[b] for b in cut[i].encode()]
            i = after[i]
        return out, candidates

    def _pairs(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, key: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of symbol pairs; pairs that are no piece, or are skipped, have rank ``_NEVER``."""
        slot = _slot(left, right)
        want = np.where((left >= 0) & (right >= 0), (left.astype(np.int64) << 32) | right, -2)  # -1 is a free slot
        at = np.full(left.shape, -1, np.int64)
        for probe in range(self.probes):
            s = (slot + probe) & _SLOTS
            at = np.where(self.pair_key[s] == want, s, at)
        merged_id = self.pair_id[at]
        rank = np.where(at >= 0, self.pair_rank[at], _NEVER)
        if self.cut_off and key is not None:
            h = key ^ (merged_id.astype(np.uint64) * np.uint64(_K1)) ^ ((place + 1).astype(np.uint64) * np.uint64(_K2))
            h = (h ^ (h >> np.uint64(32))) * np.uint64(_K1)
            skipped = ((h ^ (h >> np.uint64(29))) >> np.uint64(16)) & np.uint64(0xFFFFFFFF) < np.uint64(self.cut_off)
            rank = np.where(skipped, _NEVER, rank)
        return rank, merged_id

    def merged_many(self, cuts: list[tuple[str, int]]) -> list[bytes]:
        """Ids (int32 bytes) of many (cut, variant): the agendas of all cuts advance together, one
        merge each per step; gives exactly what ``merged`` gives one by one."""
        variant = np.array([v for _, v in cuts], np.uint64)
        keys = np.uint64(self.seed * 0x9E3779B97F4A7C15 & _MASK) + variant * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9)
        ids, count, _ = self._advance([c for c, _ in cuts], keys)
        return [x.tobytes() for x in _parted(ids, count)]

    def _advance(self, cuts: list[str], keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Ids of the cuts, one after another, and their number under the draws of their keys.  Without keys
        nothing is skipped, and the merges are listed: (cuts, pieces, positions) of every step, those of
        one cut in the order they come up."""
        done_row, done_count, done_ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        merges: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = np.array([len(c) for c in cuts], np.int64)
        codes = np.frombuffer("".join(cuts).encode("utf-32-le"), np.uint32)
        symbols = self.symbol[codes]
        start = np.cumsum(size) - size
        odd = np.zeros(len(cuts), bool)
        odd[np.repeat(np.arange(len(cuts)), size)[symbols < 0]] = True
        odd |= size > 64
        for i in np.flatnonzero(odd):
            ids, candidates = self._agenda(cuts[i], None if keys is None else int(keys[i]))
            done_row.append(np.array([i]))
            done_count.append(np.array([len(ids)]))
            done_ids.append(np.array(ids, np.int32))
            if keys is None and candidates:
                piece, at = np.array(candidates, np.int64).T
                merges.append((np.full(len(piece), i), piece, at))
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 20), (20, 64)):
            row = np.flatnonzero(~odd & (size > low) & (size <= high))
            if not len(row):
                continue
            width = int(size[row].max())
            column = np.arange(width, dtype=np.int32)
            inside = column < size[row][:, None]
            a = np.where(inside, symbols[np.minimum(start[row][:, None] + column, len(symbols) - 1)], np.int32(-1))
            place = np.broadcast_to(column, a.shape)
            key = None if keys is None else keys[row]
            rank, into = self._pairs(a[:, :-1], a[:, 1:], place[:, :-1], None if key is None else key[:, None]) if width > 1 else (np.zeros((len(row), 0), np.int32),) * 2
            while True:
                best = rank.argmin(1) if rank.shape[1] else np.zeros(len(row), np.int64)
                every = np.arange(len(row))
                going = rank[every, best] < _NEVER if rank.shape[1] else np.zeros(len(row), bool)
                done = np.flatnonzero(~going)
                if len(done):
                    left = a[done]
                    done_row.append(row[done])
                    done_count.append((left >= 0).sum(1))
                    done_ids.append(left[left >= 0].astype(np.int32))
                    if len(done) == len(row):
                        break
                    row, best, a, place, rank, into = (x[going] for x in (row, best, a, place, rank, into))
                    key = None if key is None else key[going]
                    every = np.arange(len(row))
                if key is None:
                    merges.append((row, into[every, best], place[every, best]))
                a[every, best] = into[every, best]
                here, cols = best[:, None], np.arange(a.shape[1] - 1)[None, :]
                shift = cols + (cols > here)
                a, place = np.take_along_axis(a, shift, 1), np.take_along_axis(place, shift, 1)
                cols = np.arange(rank.shape[1] - 1)[None, :]
                shift = cols + (cols >= here)
                rank, into = np.take_along_axis(rank, shift, 1), np.take_along_axis(into, shift, 1)
                for k in (best - 1, best):  # the pairs beside the new piece
                    ok = np.flatnonzero((k >= 0) & (k < rank.shape[1]))
                    if len(ok):
                        c = k[ok]
                        rank[ok, c], into[ok, c] = self._pairs(a[ok, c], a[ok, c + 1], place[ok, c], None if key is None else key[ok])
        row, found = np.concatenate(done_row), np.concatenate(done_count)
        count = np.zeros(len(cuts), np.int64)
        count[row] = found
        ids = np.empty(int(count.sum()), np.int32)
        ids[_spread((np.cumsum(count) - count)[row], found)] = np.concatenate(done_ids)
        return ids, count, merges

    def _forget(self) -> None:
        self.plain = _Numbers()                # number of a cut whose plain agenda is kept
        self.ids_first, self.ids_count, self.ids_held = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)  # of a cut: its candidates in ``drawn``
        self.count = self.first.copy()
        self.drawn = np.zeros((0, 2), np.uint64)

    def _keep(self, cuts: list[str]) -> None:
        """Keep the plain agendas of new cuts: their ids, and the draws that may skip one of their merges."""
        ids, n_ids, merges = self._advance(cuts, None)
        first = len(self.ids_first)
        self.ids_first = np.concatenate([self.ids_first, len(self.ids_held) + np.cumsum(n_ids) - n_ids])
        self.ids_count, self.ids_held = np.concatenate([self.ids_count, n_ids]), np.concatenate([self.ids_held, ids])
        self.plain.update(zip(cuts, range(first, first + len(cuts))))
        row, piece, at = (np.concatenate(x) for x in zip(*merges)) if merges and self.cut_off else (np.zeros(0, np.int64),) * 3
        order = np.argsort(row, kind="stable")
        drawn = np.stack([piece[order].astype(np.uint64) * np.uint64(_K1), (at[order] + 1).astype(np.uint64) * np.uint64(_K2)], axis=1)
        count = np.bincount(row, minlength=len(cuts))
        self.first = np.concatenate([self.first, len(self.drawn) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.drawn = np.concatenate([self.drawn, drawn])

    def merged_each(self, cuts: list[str], variants: np.ndarray) -> list[bytes]:
        """Ids (int32 bytes) of every cut under the draws of its key; exactly those of ``merged``."""
        return [x.tobytes() for x in _parted(*self._each(cuts, variants))]

    def _each(self, cuts: list[str], variants: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same one after another, and their numbers.  A cut none of whose plain candidates is skipped
        has its plain ids; the others are merged anew."""
        if len(self.ids_first) > self.limit:
            self._forget()
        new = [cut for cut in set(cuts).difference(self.plain) if len(cut) <= 64]  # longer cuts rarely come again
        for k in range(0, len(new), 32768):
            self._keep(new[k:k + 32768])
        at = np.fromiter(map(self.plain.__getitem__, cuts), np.int64, len(cuts))
        key = np.uint64(self.seed * 0x9E3779B97F4A7C15 & _MASK) + variants * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9)
        anew = at < 0
        row = np.flatnonzero(~anew)
        row = row[self.count[at[row]] > 0]
        if len(row):
            n = self.count[at[row]]
            start = np.cumsum(n) - n
            drawn = self.drawn[_spread(self.first[at[row]], n)]
            h = np.repeat(key[row], n) ^ drawn[:, 0] ^ drawn[:, 1]
            h = (h ^ (h >> np.uint64(32))) * np.uint64(_K1)
            skipped = ((h ^ (h >> np.uint64(29))) >> np.uint64(16)) & np.uint64(0xFFFFFFFF) < np.uint64(self.cut_off)
            anew[row] = np.logical_or.reduceat(skipped, start)
        count = np.zeros(len(cuts), np.int64)
        same = np.flatnonzero(~anew)
        count[same] = self.ids_count[at[same]]
        parts = []
        for part in np.array_split(np.flatnonzero(anew), int(anew.sum()) // 32768 + 1):
            if len(part):
                ids, n, _ = self._advance([cuts[i] for i in part.tolist()], key[part])
                count[part] = n
                parts.append((part, n, ids))
        out = np.empty(int(count.sum()), np.int32)
        start = np.cumsum(count) - count
        out[_spread(start[same], count[same])] = self.ids_held[_spread(self.ids_first[at[same]], count[same])]
        for part, n, ids in parts:
            out[_spread(start[part], n)] = ids
        return out, count

    def encode_many(self, texts: list[str], keys: list[object]) -> list[np.ndarray]:
        """Ids of the texts; a text's key (the row id) and the ordinal of a cut key its draws."""
        cuts, ends, draws = [], [0], []
        for text, key in zip(texts, keys):
            own = (_CUT.findall(" " + text) if self.splits else [" " + text]) if text else []
            cuts += own
            ends.append(len(cuts))
            of = xxhash.xxh64_intdigest(repr(key).encode(), self.seed & _MASK)
            draws.append(mix64(np.arange(len(own), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(of)))
        ids, count = self._each(cuts, np.concatenate(draws)) if cuts else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        at = np.concatenate([[0], np.cumsum(count)])[ends].tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]

    def encode(self, text: str, key: object = None) -> np.ndarray:
        return self.encode_many([text], [key])[0]

    def decode(self, ids: Iterable[int] | np.ndarray) -> bytes:
        """The UTF-8 bytes that ids stand for."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        size = self.size[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.blob[at].tobytes()[1:]


#: The last codec of this process, with what it was made of: tasks that follow one another share it.
_last: list = []


def _codec(held, dropout: float = 0.1, seed: int = 0) -> Codec:
    """The codec of a broadcast vocabulary.  What it remembers decides nothing but the time."""
    vocabulary = held.value
    if not _last or _last[0] != (dropout, seed) or _last[1] != vocabulary:
        _last[:] = [(dropout, seed), vocabulary, Codec(vocabulary, dropout, seed)]
    return _last[2]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), model_path: str = MODEL_PATH,
           dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """``(id, keep..., ids array<int>, n_tokens, n_bytes, round_trip)`` per row."""
    held = docs.sparkSession.sparkContext.broadcast(read_vocabulary(model_path))
    cut = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(k) for k in keep])
    names = ["_id", *keep, "ids", "n_tokens", "n_bytes", "round_trip"]
    schema = ", ".join([f"`_id` {cut.schema['_id'].dataType.simpleString()}", *[f"`{k}` {cut.schema[k].dataType.simpleString()}" for k in keep],
                        "ids array<int>, n_tokens bigint, n_bytes bigint, round_trip boolean"])

    def run(batches):
        codec = _codec(held, dropout, seed)
        for whole in batches:
            for at, end in slices([len(t) if t else 0 for t in whole.column("_text").to_pylist()], 1 << 20):
                batch = whole.slice(at, end - at)
                texts = batch.column("_text").to_pylist()
                ids = codec.encode_many([t or "" for t in texts], batch.column("_id").to_pylist())
                raw = [(t or "").encode() for t in texts]
                n = np.array([len(i) for i in ids], np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), mask=np.array([t is None for t in texts] + [False])),
                    pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), *[batch.column(k) for k in keep], lists, pa.array(n), pa.array([len(r) for r in raw], pa.int64()),
                     pa.array([codec.decode(i) == r for i, r in zip(ids, raw)], pa.bool_())], names=names)

    return cut.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", model_path: str = MODEL_PATH) -> DataFrame:
    """``encoded`` with ``decoded``: the text its ids stand for (null ids: null)."""
    held = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(model_path))

    @F.pandas_udf("string")
    def text(ids):
        codec = _codec(held)
        return ids.map(lambda x: None if x is None else codec.decode(x).decode())

    return encoded.withColumn("decoded", text(F.col(ids_col)))
