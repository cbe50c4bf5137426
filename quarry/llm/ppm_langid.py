"""Language identification by prediction by partial matching (PPM, escape method C).

Each language has a tree of byte contexts of order 0 to ``order``.  Under frozen counts a
byte costs ``-log2 p``: in the longest context seen with that language,
``count / (total + distinct)`` if the byte followed it, else the escape
``distinct / (total + distinct)`` times the probability in the next shorter context, down
to 1/256 for any byte.  A text's code length per language is the exact sum over its
bytes; the language with the shortest code is predicted, and the score is its posterior
``1 / sum(2^(shortest - length))``.

The model is fitted on a bounded sample of labelled rows: per language at most
``rows_per_lang`` whole texts (those with the smallest id hash) and no further row once
``bytes_per_lang`` bytes are reached.  Counts of rows per language cover all rows.  Frozen
probabilities of all languages are laid out as one table [context, byte, language], whose
size is bounded by the sample, so that scoring is two array lookups per byte.

Rows with a null text or a null label are never learned from.  A null text, and a text
without any letter, gets ``und`` with score 0.  Ties go to the first language by name.
With no row to learn from, every text is ``und``.  An empty table gives no rows, repeated
rows equal answers; only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import slices

UNDETERMINED = "und"
_SLICE = 1 << 20


@dataclass
class Model:
    """``classes`` maps a byte to its class (0: not seen), ``nodes`` a packed context of
    ``order`` classes to its deepest known context, ``bits`` is [context * classes + class, language]."""

    langs: list[str]
    order: int
    n_classes: int
    classes: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows_per_lang: int, bytes_per_lang: int) -> dict[str, list[bytes]]:
    """Whole texts per language, by ascending id hash, within both bounds."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string")).alias("h"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # a hash threshold per language lets about twice the wanted rows through
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2.0 * rows_per_lang / n))])
    part = (F.col("h").cast("double") / F.lit(2.0**64) + 0.5) < F.try_element_at(share, F.col("lang"))
    out: dict[str, list[bytes]] = {lang: [] for lang in counts}
    size = dict.fromkeys(counts, 0)
    near = rows.where(part).orderBy("h", F.xxhash64("text")).limit(3 * rows_per_lang * len(counts))
    for lang, text, _ in near.toLocalIterator():
        if len(out[lang]) < rows_per_lang and size[lang] < bytes_per_lang:
            out[lang].append(text.encode())
            size[lang] += len(out[lang][-1])
    return {lang: texts for lang, texts in sorted(out.items()) if size[lang]}


def _packed(classes: np.ndarray, n: int, order: int) -> np.ndarray:
    """Context of every position that has ``order`` classes before it, packed base ``n``."""
    key = np.zeros(len(classes) - order, np.int64)
    for k in range(order):
        key = key * n + classes[k:len(classes) - order + k]
    return key


def _padded(texts: list[bytes], classes: np.ndarray, order: int) -> np.ndarray:
    """Classes of the texts, each after ``order`` zeros."""
    pad = bytes(order)
    joined = np.frombuffer(pad + pad.join(texts), np.uint8)
    out = classes[joined].astype(np.int64)
    ends = np.cumsum([0] + [len(t) + order for t in texts])[:-1]
    out[(ends[:, None] + np.arange(order)[None, :]).ravel()] = 0
    return out


def fit(texts: dict[str, list[bytes]], order: int = 3, least: int = 2) -> Model | None:
    """Freeze the statistics; contexts of order 2 and more need ``least`` occurrences."""
    if not texts:
        return None
    langs = sorted(texts)
    seen = np.unique(np.concatenate([np.frombuffer(b"".join(t), np.uint8) for t in texts.values()]))
    classes = np.zeros(256, np.int16)
    classes[seen] = np.arange(1, len(seen) + 1)
    n = len(seen) + 1
    coded = {lang: _padded(t, classes, order) for lang, t in texts.items()}
    prob = np.full((1, n, len(langs)), 1 / 256)
    parents = np.zeros(1, np.int64)  # packed contexts of the order below
    tables, where = [], []
    for o in range(order + 1):
        found = []
        for lang in langs:
            c = coded[lang]
            sym, ctx = c[order:], _packed(c[order - o:], n, o)[: len(c) - order]
            ok = sym > 0
            found.append(np.unique(ctx[ok] * n + sym[ok], return_counts=True))
        ctxs, inverse = np.unique(np.concatenate([k // n for k, _ in found]), return_inverse=True)
        counts = np.zeros((len(ctxs), n, len(langs)))
        at = 0
        for j, (k, c) in enumerate(found):
            counts[inverse[at:at + len(k)], k % n, j] = c
            at += len(k)
        if o >= 2:
            keep = counts.sum((1, 2)) >= least
            ctxs, counts = ctxs[keep], counts[keep]
        if o:  # a context's parent lacks its first byte; a missing parent was pruned: use its own
            up = np.searchsorted(parents, ctxs % n ** (o - 1))
            up = np.minimum(up, len(parents) - 1)
            base = prob[up]
        else:
            base = np.broadcast_to(prob, counts.shape)
        totals, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
        with np.errstate(invalid="ignore", divide="ignore"):
            own = counts / (totals + kinds)
            escape = np.where(totals > 0, kinds / (totals + kinds), 1.0)
        prob, parents = np.where(counts > 0, own, escape * base), ctxs
        tables.append(-np.log2(prob).astype(np.float32))
        where.append(ctxs)
    nodes = np.zeros(n**order, np.int32)
    offset = 0
    for o, (ctxs, table) in enumerate(zip(where, tables)):
        if len(ctxs):
            block = nodes.reshape(n ** (order - o), n**o) if o else nodes.reshape(-1, 1)
            block[:, ctxs] = np.arange(offset, offset + len(ctxs), dtype=np.int32)[None, :]
        offset += len(ctxs)
    bits = np.concatenate([t.reshape(-1, len(langs)) for t in tables])
    return Model(langs, order, n, classes, nodes, bits)


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of every (non-empty) text under every language."""
    c = _padded(texts, model.classes, model.order)
    rows = model.nodes[_packed(c, model.n_classes, model.order)].astype(np.int64) * model.n_classes + c[model.order:]
    costs = model.bits[rows]
    starts = np.cumsum([0] + [len(t) + model.order for t in texts])[:-1]
    edges = np.stack([starts, starts + [len(t) for t in texts]], 1).ravel()
    if edges[-1] == len(costs):
        edges = edges[:-1]
    return np.add.reduceat(costs, edges, axis=0, dtype=np.float64)[::2]


def learn(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          order: int = 3, rows_per_lang: int = 400, bytes_per_lang: int = 2_000_000) -> Model | None:
    """The model of the rows for which ``train`` holds; None if there is no row to learn from."""
    return fit(sample(docs.where(train), id_col, text_col, lang_col, rows_per_lang, bytes_per_lang), order)


def usual_rates(docs: DataFrame, model: Model | None, train: Column, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> dict[str, tuple[float, float, float]]:
    """Mean and deviation of the bits per byte, and mean bytes, of all rows for which ``train`` holds and whose
    language is predicted as labelled: one row per learned language."""
    if model is None:
        return {}
    rows = docs.where(train).select(id_col, text_col, F.col(lang_col).alias("_lang"), F.octet_length(text_col).alias("_size"))
    judged = predict(rows, train, id_col, text_col, lang_col, keep=("_lang", "_size"), model=model)
    found = judged.where("lang_pred = _lang and _size > 0").groupBy("lang_pred").agg(
        F.avg("bits_per_byte").alias("mean"), F.stddev_pop("bits_per_byte").alias("spread"), F.avg("_size").alias("size"))
    return {r["lang_pred"]: (r["mean"], r["spread"], r["size"]) for r in found.collect()}


def predict(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            keep: tuple[str, ...] = (), order: int = 3, rows_per_lang: int = 400, bytes_per_lang: int = 2_000_000,
            model: Model | None = None) -> DataFrame:
    """``(id, keep..., lang_pred, score, bits_per_byte)``; the rows for which ``train`` holds
    are learned from, unless a ``model`` is given, and only ``text`` is used to predict."""
    spark = docs.sparkSession
    if model is None:
        model = learn(docs, train, id_col, text_col, lang_col, order, rows_per_lang, bytes_per_lang)
    held = spark.sparkContext.broadcast(model)
    kept = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(k) for k in keep])
    schema = ", ".join([f"`_id` {kept.schema['_id'].dataType.simpleString()}",
                        *[f"`{k}` {kept.schema[k].dataType.simpleString()}" for k in keep],
                        "lang_pred string, score double, bits_per_byte double"])
    names = ["_id", *keep, "lang_pred", "score", "bits_per_byte"]

    def run(batches):
        model = held.value
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            lang, score, rate = [UNDETERMINED] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            todo = [i for i, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
            raw = [texts[i].encode() for i in todo]
            for a, b in slices([len(t) for t in raw], _SLICE):
                bits = code_lengths(model, raw[a:b])
                best = bits.argmin(1)
                low = bits[np.arange(len(best)), best]
                post = 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(1)
                for i, t, k, p, n in zip(todo[a:b], raw[a:b], best.tolist(), post.tolist(), low.tolist()):
                    lang[i], score[i], rate[i] = model.langs[k], p, n / len(t)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *[batch.column(k) for k in keep], pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(rate, pa.float64())], names=names)

    return kept.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


__all__ = ["Model", "UNDETERMINED", "code_lengths", "fit", "learn", "predict", "sample", "usual_rates"]
