"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

The scatter matrix is summed in tasks over rows centred beforehand and added up in Spark; only this
d x d matrix and the 2 d sums reach the driver.  There it is factored as ``L L'`` with pivots, and
the columns of ``L`` are rotated against one another until they are orthogonal: their squared norms
are the eigenvalues of the scatter, the normalised columns its eigenvectors.

Rows whose vector is null or holds null or non-finite entries are dropped, and so are rows whose
length is not the most common one (of equally common ones the shorter).  Components whose
eigenvalue is zero (below ``1e-12`` of the trace), and so all of a table without rows, with one
distinct row or with empty vectors, are left out: nothing can be brought to unit variance there.
Rows with one id are kept apart; a null id is an id like any other.  Scaled entries stop
at 2^62; a deviation that does not fit a long is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows a task turns into doubles at once.
BLOCK = 4096

SCALE, SHIFT = 1024, 100_000
#: Scaled entries stop here, so that an integer fits a long.
LARGEST = float(1 << 62)


def _lengths(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Length of every usable vector, -1 for the others; and all entries as doubles."""
    column = batch.column(1)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    odd = np.repeat(np.arange(len(lengths)), lengths)[~np.isfinite(entries)]
    usable = column.is_valid().to_numpy(zero_copy_only=False)
    usable[odd] = False
    return np.where(usable, lengths, -1), entries


def _integers(batch: pa.RecordBatch, d: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and integer vectors of the usable rows with ``d`` entries: ``floor(1024 c) + 100000``."""
    lengths, entries = _lengths(batch)
    column = batch.column(1)
    every = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    picked = lengths == d
    c = entries[np.repeat(picked, every)].reshape(-1, d)
    x = np.clip(np.floor(c * SCALE), -LARGEST, LARGEST).astype(np.int64) + SHIFT
    return batch.column(0).filter(pa.array(picked)), x


def _blocks(batches, fn):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield fn(batch.slice(start, BLOCK))


def _sums(rows: DataFrame, size: int, fn) -> np.ndarray:
    """``size`` doubles that ``fn`` makes of a block, added up in each task and then by Spark."""
    def run(batches):
        total = np.zeros(size)
        for part in _blocks(batches, fn):
            total += part.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["k", "v"])

    out = np.zeros(size)
    for k, v in rows.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v")).collect():
        out[k] = v
    return out


def _common_length(rows: DataFrame) -> tuple[int, int]:
    """The most common length of usable vectors and their number."""
    def run(batches):
        for lengths in _blocks(batches, lambda b: _lengths(b)[0]):
            d, n = np.unique(lengths[lengths >= 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(n)], names=["d", "n"])

    found = rows.mapInArrow(run, "d long, n long").groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "d").first()
    return (found["d"], found["n"]) if found else (0, 0)


def _exact_sums(rows: DataFrame, d: int) -> list[int]:
    """Sums of the integer vectors by dimension; halves of 32 bits keep them exact."""
    def run(batches):
        for x in _blocks(batches, lambda b: _integers(b, d)[1]):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array((x >> 32).sum(0)), pa.array((x & 0xFFFFFFFF).sum(0))],
                                             names=["k", "high", "low"])

    total = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    out = [0] * d
    for k, high, low in rows.mapInArrow(run, "k long, high long, low long").groupBy("k").agg(*total).collect():
        out[k] = (int(high) << 32) + int(low)
    return out


def pivoted_cholesky(a: np.ndarray, relative: float = 1e-14) -> np.ndarray:
    """``L`` (d x rank, its rows in the order of ``a``) with ``L L' = a``, greatest pivot first."""
    d = len(a)
    left, rest, columns, threshold = np.diag(a).astype(float), np.ones(d, bool), [], relative * np.trace(a)
    while rest.any():
        p = int(np.argmax(np.where(rest, left, -np.inf)))
        if left[p] <= threshold:
            break
        column = a[:, p].astype(float)
        if columns:
            known = np.stack(columns, axis=1)
            column = column - known @ known[p]
        column = np.where(rest, column, 0.0) / np.sqrt(left[p])
        column[p] = np.sqrt(left[p])
        rest[p] = False
        left = np.where(rest, left - column ** 2, 0.0)
        columns.append(column)
    return np.stack(columns, axis=1) if columns else np.zeros((d, 0))


def one_sided_jacobi(factor: np.ndarray, tolerance: float = 1e-15, sweeps: int = 60) -> np.ndarray:
    """Columns of ``factor`` rotated in pairs until they are orthogonal, the longest first.

    A round of a sweep rotates disjoint pairs together, as in a round-robin tournament."""
    u = factor.copy()
    n = u.shape[1]
    seats = np.arange(n + n % 2)
    for _ in range(sweeps if n > 1 else 0):
        largest = 0.0
        for _ in range(len(seats) - 1):
            i, j = seats[:len(seats) // 2], seats[len(seats) // 2:][::-1]
            real = (i < n) & (j < n)
            i, j = i[real], j[real]
            x, y = u[:, i], u[:, j]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            cosine = np.abs(c) / np.maximum(np.sqrt(a * b), np.finfo(float).tiny)
            largest = max(largest, float(cosine.max(initial=0.0)))
            turn = cosine > tolerance
            zeta = (b - a) / np.where(turn, 2 * c, 1.0)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cs = 1 / np.hypot(1.0, t)
            u[:, i], u[:, j] = cs * (x - t * y), cs * (y + t * x)
            seats = np.concatenate([seats[:1], np.roll(seats[1:], 1)])
        if largest <= tolerance * 10:
            break
    return u[:, np.argsort(-(u * u).sum(0), kind="stable")]


def principal_axes(scatter: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of ``scatter`` and their unit eigenvectors as columns."""
    u = one_sided_jacobi(pivoted_cholesky(scatter))
    values = (u * u).sum(0)
    keep = min(components, int((values > 1e-12 * np.trace(scatter)).sum()))
    return values[:keep], u[:, :keep] / np.sqrt(values[:keep])


def _deviations(x: np.ndarray, n: int, s: np.ndarray) -> pa.Array:
    """Exact sums of ``(n x - S)^2``; null where a sum does not fit a long."""
    wide = float(n) * np.abs(x).max(initial=0) + np.abs(s.astype(float)).max(initial=0)
    if wide < 2 ** 62 and (rough := ((n * x - s).astype(float) ** 2).sum(1)).max(initial=0) < 2 ** 62:
        return pa.array(((n * x - s) ** 2).sum(1), pa.int64())
    exact = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s)) for row in x]
    return pa.array([v if v < 2 ** 63 else None for v in exact], pa.int64())


def whiten(rows: DataFrame, components: int = 8, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per usable row and component: ``vec_id``, ``component`` (from 1, by falling
    eigenvalue), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    id_type = rows.schema[key].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = rows.select(key, vector)
    d, n = _common_length(vectors)
    if not d:
        return rows.sparkSession.createDataFrame([], schema)
    total = _exact_sums(vectors, d)
    mean_whole, mean_part = np.array([v // n for v in total], float), np.array([v % n / n for v in total])
    total = np.array(total, np.int64 if max(map(abs, total)) < 2 ** 62 else object)

    def centred(x):
        return x.astype(float) - mean_whole - mean_part

    def scattered(batch):
        y = centred(_integers(batch, d)[1])
        return y.T @ y

    scatter = _sums(vectors, d * d, scattered).reshape(d, d)
    values, axes = principal_axes((scatter + scatter.T) / 2, components)
    m = len(values)
    if not m:
        return rows.sparkSession.createDataFrame([], schema)
    axes = axes / np.sqrt(values / n)

    def projected(batch):
        return centred(_integers(batch, d)[1]) @ axes

    mean = _sums(vectors, m, lambda batch: projected(batch).sum(0)) / n

    def squared(batch):
        w = projected(batch) - mean
        return w.T @ w

    error = float(np.abs(_sums(vectors, m * m, squared).reshape(m, m) / n - np.eye(m)).max())
    explained = values / np.trace(scatter)

    def result(batch):
        ids, x = _integers(batch, d)
        of = pa.array(np.repeat(np.arange(len(x)), m))
        return pa.RecordBatch.from_arrays([
            ids.take(of), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))), pa.array(np.full(len(of), n)),
            _deviations(x, n, total).take(of), pa.array((centred(x) @ axes).ravel()), pa.array(np.tile(explained, len(x))),
            pa.array(np.full(len(of), error))], names=[p.split(" ")[0] for p in schema.split(", ")])

    return vectors.mapInArrow(lambda batches: _blocks(batches, result), schema)
