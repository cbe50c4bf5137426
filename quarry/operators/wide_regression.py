"""Full-batch SGD ridge over many sparse features (M10), and elastic net by coordinate descent.

``sgd_from_moments`` needs the d x d matrix of products, so it is for a moderate number of features.
``sgd_wide`` never forms it: rows with the same few indices are added up once to the sums of their
products, each round sends the weights to the tasks, every task adds up the gradient of its rows and
sums, Spark adds up the tasks' gradients by feature, and the driver makes the step on d numbers.  Both
follow the same recurrence and give the same weights and rounds.

``elastic_net_from_moments`` solves the penalised regression independently of ``pyspark.ml``: cyclic
coordinate descent with soft thresholding on the centred Gram matrix of one pass over the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.regression import (ENET_MIX, ENET_REG, SGD_ITERATIONS, SGD_REG, SGD_STEP, SGD_TOLERANCE, moments)
from quarry.session import ensure_checkpoint_dir

#: The indices of a row that is added up with those of the same indices: their sums hold the square of that.
SUMMED = 3


def _summed(rows: DataFrame, most: int) -> DataFrame:
    """Rows ``(indices, values, label)`` with up to ``most`` indices as rows of the same gradient, one per list of
    indices ``(indices, gram, xy)``: ``gram`` are the sums of the products of the values, row by row, ``xy`` those with
    the label.  A longer row stays as it is: ``(indices, values, label)``."""
    def sums(n):
        v = [F.get("values", k) for k in range(n)]
        some = rows.where(F.size("indices") == n).groupBy("indices")
        return some.agg(F.array(*[F.sum(a * b) for a in v for b in v]).alias("gram"), F.array(*[F.sum(a * F.col("label")) for a in v]).alias("xy"))

    none = {"values": F.lit(None).cast("array<double>"), "label": F.lit(None).cast("double")}
    out = rows.where(F.size("indices") > most).withColumns({"gram": F.lit(None).cast("array<double>"), "xy": F.lit(None).cast("array<double>")})
    for n in range(1, most + 1):
        out = out.unionByName(sums(n).withColumns(none))
    return out.select("indices", "values", "label", "gram", "xy")


def _gradient(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """``X'(X w - y)`` over rows of ``_summed``."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def whole(batch, w):
        indices, values, label = (batch.column(c) for c in ("indices", "values", "label"))
        index = indices.flatten().to_numpy(zero_copy_only=False)
        value = values.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(label)), indices.value_lengths().to_numpy(zero_copy_only=False))
        error = np.bincount(row, weights=value * w[index], minlength=len(label)) - label.to_numpy(zero_copy_only=False)
        return index, value * error[row]

    def summed(batch, w):
        sizes = batch.column("indices").value_lengths().to_numpy(zero_copy_only=False)
        for n in np.unique(sizes):
            some = batch.filter(pa.array(sizes == n))
            index, gram, xy = (some.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("indices", "gram", "xy"))
            yield index, np.einsum("rij,rj->ri", gram.reshape(-1, n, n), w[index].reshape(-1, n)).ravel() - xy

    def run(batches):
        w = sent.value
        total, touched = np.zeros(len(w)), np.zeros(len(w), bool)
        for batch in batches:
            alone = batch.column("gram").is_null()
            parts = [whole(batch.filter(alone), w), *summed(batch.filter(pc.invert(alone)), w)]
            for index, change in parts:
                np.add.at(total, index, change)
                touched[index] = True
        at = np.flatnonzero(touched)
        for k in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[k:k + 100_000], pa.int64()), pa.array(total[at[k:k + 100_000]])], names=["k", "g"])

    out = np.zeros(len(weights))
    found = rows.mapInArrow(run, "k long, g double").groupBy("k").agg(F.sum("g").alias("g")).toArrow()
    out[found.column("k").to_numpy()] = found.column("g").to_numpy()
    sent.destroy()
    return out


def sgd_wide(rows: DataFrame, features: int, iterations: int = SGD_ITERATIONS, step: float = SGD_STEP, reg: float = SGD_REG,
             tol: float = SGD_TOLERANCE) -> tuple[np.ndarray, int]:
    """Weights and rounds of ridge SGD over ``(indices array<int>, values array<double>, label double)``
    with indices below ``features``.  Rows with a null column or a null entry are left out.

    The rows, those of up to ``SUMMED`` indices added up by their indices, are written once to
    ``spark.checkpoint.dir``; a round is one pass over them."""
    ensure_checkpoint_dir(rows.sparkSession)
    whole = F.forall("values", lambda v: v.isNotNull()) & F.forall("indices", lambda k: k.isNotNull()) & (F.size("indices") == F.size("values"))
    rows = (rows.select(F.col("indices").cast("array<int>").alias("indices"), F.col("values").cast("array<double>").alias("values"),
                        F.col("label").cast("double").alias("label")).dropna().where(whole))
    n = rows.count()
    rows = _summed(rows, SUMMED).checkpoint()
    w, prev, rounds = np.zeros(features), None, 0
    for i in range(1, iterations + 1 if n else 1):
        s = step / math.sqrt(i)
        w = w * (1.0 - s * reg) - s * (_gradient(rows, w) / n)
        rounds = i
        if prev is not None and np.linalg.norm(prev - w) < tol * max(np.linalg.norm(w), 1.0):
            break
        prev = w.copy()
    return w, rounds


def weights_of(features: DataFrame, feature: str, weights: np.ndarray) -> DataFrame:
    """``features`` (one integer column) with the ``weight`` of each, looked up in the tasks."""
    sent = features.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            k = batch.column(0)
            yield pa.RecordBatch.from_arrays([k, pa.array(sent.value[k.to_numpy(zero_copy_only=False)])], names=[feature, "weight"])

    return features.select(feature).where(F.col(feature).isNotNull()).mapInArrow(run, f"{feature} {features.schema[feature].dataType.simpleString()}, weight double")


def elastic_net_from_moments(df: DataFrame, features: Sequence[str], label: str, reg: float = ENET_REG, mix: float = ENET_MIX,
                             max_iter: int = 10_000, tol: float = 1e-12) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the least squares with penalty
    ``reg (mix |w|_1 + (1 - mix) / 2 |w|_2^2)`` on standardised features and label.

    Standard deviations are those of the population, as in the solver of ``pyspark.ml`` for up to
    4,096 features; a constant feature gets 0."""
    names = [*features, label]
    n, products, _ = moments(df.withColumn("_one", F.lit(1.0)), [*names, "_one"], label)
    d = len(features)
    mean = products[-1, :-1] / n
    gram = products[:-1, :-1] / n - np.outer(mean, mean)
    deviation = np.sqrt(np.maximum(np.diag(gram), 0))
    if not deviation[d]:
        return np.zeros(d), float(mean[d])
    live = [j for j in range(d) if deviation[j] > 1e-12 * max(abs(mean[j]), 1.0)]
    scale = deviation[live]
    xx = gram[np.ix_(live, live)] / np.outer(scale, scale)
    xy = gram[live, d] / (scale * deviation[d])
    first, second = reg * mix / deviation[d], reg * (1 - mix) / deviation[d]
    w = np.zeros(len(live))
    for _ in range(max_iter):
        change = 0.0
        for j in range(len(live)):
            rest = xy[j] - xx[j] @ w + xx[j, j] * w[j]
            new = math.copysign(max(abs(rest) - first, 0.0), rest) / (xx[j, j] + second)
            change, w[j] = max(change, abs(new - w[j])), new
        if change < tol:
            break
    out = np.zeros(d)
    out[live] = w * deviation[d] / scale
    return out, float(mean[d] - out @ mean[:d])
