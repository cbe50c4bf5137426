"""Regression.

``sgd_ridge`` reproduces ``pyspark.mllib`` full-batch SGD with the squared-L2
updater.  With the whole batch every round, the gradient sum is
``X^T X w - X^T y``, so one distributed pass computes the moments
``(n, X^T X, X^T y)`` and the rounds run on d x d numbers.  For a wide feature
set (d in the thousands) aggregate the gradient per round instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reference's SGD and elastic-net settings.
SGD_ITERATIONS = 100
SGD_STEP = 1.0
SGD_REG = 0.01
SGD_TOLERANCE = 0.001
ENET_REG = 0.3
ENET_MIX = 0.8
ENET_ITER = 100
ENET_TOL = 1e-6


def moments(df: DataFrame, features: Sequence[str], label: str) -> tuple[int, np.ndarray, np.ndarray]:
    """One pass over the rows without a NULL: ``n``, ``X^T X`` (d x d) and ``X^T y`` (d).
    For a moderate number of features: the pass has d (d + 3) / 2 sums."""
    df = df.dropna(subset=[*features, label])
    d = len(features)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(d):
        for j in range(i, d):
            aggs.append(F.sum(F.col(features[i]) * F.col(features[j])).alias(f"xx_{i}_{j}"))
        aggs.append(F.sum(F.col(features[i]) * F.col(label)).alias(f"xy_{i}"))
    row = df.agg(*aggs).first()
    xtx = np.zeros((d, d))
    xty = np.zeros(d)
    for i in range(d):
        for j in range(i, d):
            xtx[i, j] = xtx[j, i] = row[f"xx_{i}_{j}"] or 0.0
        xty[i] = row[f"xy_{i}"] or 0.0
    return int(row["n"]), xtx, xty


def sgd_from_moments(n: int, xtx: np.ndarray, xty: np.ndarray, iterations: int = SGD_ITERATIONS,
                     step: float = SGD_STEP, reg: float = SGD_REG,
                     tol: float = SGD_TOLERANCE) -> tuple[np.ndarray, int]:
    """The mllib recurrence: step ``s = step / sqrt(i)``,
    ``w <- w (1 - s reg) - s (X^T X w - X^T y) / n``; stop when
    ``|w_i - w_{i-1}| < tol * max(|w_i|, 1)``, tested from the second round."""
    w = np.zeros(len(xty))
    prev = None
    rounds = 0
    for i in range(1, iterations + 1):
        if n == 0:
            break
        s = step / math.sqrt(i)
        grad = (xtx @ w - xty) / n
        w = w * (1.0 - s * reg) - s * grad
        rounds = i
        if prev is not None and np.linalg.norm(prev - w) < tol * max(np.linalg.norm(w), 1.0):
            break
        prev = w.copy()
    return w, rounds


def sgd_ridge(df: DataFrame, features: Sequence[str], label: str, **kw) -> tuple[np.ndarray, int]:
    """Weights and rounds of full-batch SGD ridge regression (no intercept)."""
    n, xtx, xty = moments(df, features, label)
    return sgd_from_moments(n, xtx, xty, **kw)


def hash_split(df: DataFrame, key_cols: Sequence[str], train_pct: int = 50,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Deterministic split on a hash of a key (stable under recomputation
    and retries, unlike an unseeded ``randomSplit``)."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols]), F.lit(100))
    return df.where(bucket < train_pct), df.where(bucket >= train_pct)


def modulo_split(df: DataFrame, key: str, train_pct: int = 50) -> tuple[DataFrame, DataFrame]:
    """M12 on an integer key whose last two digits are spread evenly; any SQL engine can repeat it."""
    bucket = F.pmod(F.col(key), F.lit(100))
    return df.where(bucket < train_pct), df.where(bucket >= train_pct)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def scale(df: DataFrame, col: str = "features", out: str = "scaled") -> DataFrame:
    """Zero-mean, unit-variance features (optional stage)."""
    return StandardScaler(inputCol=col, outputCol=out, withMean=True, withStd=True).fit(df).transform(df)


def elastic_net(train: DataFrame, features_col: str = "features", label: str = "label",
                reg: float = ENET_REG, mix: float = ENET_MIX, max_iter: int = ENET_ITER,
                tol: float = ENET_TOL) -> LinearRegressionModel:
    """``pyspark.ml`` linear regression with elastic-net penalty."""
    lr = LinearRegression(featuresCol=features_col, labelCol=label, regParam=reg,
                          elasticNetParam=mix, maxIter=max_iter, tol=tol)
    return lr.fit(train)


def predict(model, df: DataFrame, label: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """``(prediction, label)`` beside any key columns."""
    return model.transform(df).select(*keep, "prediction", F.col(label).alias("label"))
