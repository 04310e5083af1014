"""Logistic regressions of several folds fitted together: every pass over the rows serves all of them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialize

MAX_WIDTH = 64  # features; a pass brings a matrix of their square per fold and task to the driver
MAX_PASSES = 100
ROWS_PER_BLOCK = 4096
TOLERANCE = 1e-12  # of the loss that another step could still gain

BLOCK = "rows int, width int, x binary, y binary, fold binary"


def fold_blocks(table: DataFrame, target: str, features: str) -> DataFrame:
    """``(target, features, fold)`` rows as binary matrices, written once, since every pass reads them; rows without a fold go."""
    size = ROWS_PER_BLOCK

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                batch = whole.slice(at, size)
                n = batch.num_rows
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)  # null: not a number
                fold = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int32)
                values = [n, len(x) // n, x.tobytes(), y.tobytes(), fold.tobytes()]
                types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], ["rows", "width", "x", "y", "fold"])

    rows = table.filter(F.col("fold").isNotNull())
    rows = rows.select("fold", F.col(target).cast("double").alias("y"), vector_to_array(features).alias("x"))
    return materialize(rows.mapInArrow(pack, BLOCK), "blocks")


def _summed(blocks: DataFrame, compute) -> np.ndarray | None:
    """The sum of ``compute(x, y, fold)`` over all blocks, one array a task; None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for rows, width, x, y, fold in zip(*(c.to_pylist() for c in batch.columns)):
                part = compute(np.frombuffer(x).reshape(rows, width), np.frombuffer(y), np.frombuffer(fold, np.int32))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float64).tobytes()], pa.binary())], ["total"])

    parts = [np.frombuffer(r["total"]) for r in blocks.mapInArrow(run, "total binary").collect()]  # bounded by MAX_WIDTH
    return sum(parts[1:], parts[0]) if parts else None


def _counted(blocks: DataFrame, folds: int) -> np.ndarray | None:
    """Per fold, and for all folds beyond, the rows of class 0, of class 1, and others or with values that are no numbers."""

    def count(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        odd = ~np.isfinite(x).all(axis=1) | ~np.isin(y, (0.0, 1.0))
        kinds = np.where(odd, 2, (y == 1.0).astype(int))
        return np.bincount(np.minimum(fold, folds) * 3 + kinds, minlength=3 * (folds + 1))

    total = _summed(blocks, count)
    return None if total is None else total.reshape(-1, 3)


def _step(gradient: np.ndarray, hessian: np.ndarray, theta: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """The step to the least value of the quadratic model plus the penalties; the intercept, the last, has none."""
    ridge = np.full(len(theta), l2)
    ridge[-1] = 0.0
    h = hessian + np.diag(ridge)
    g = gradient + ridge * theta
    if l1 == 0.0:
        return -np.linalg.lstsq(h, g, rcond=1e-14)[0]
    step, pull = np.zeros(len(theta)), g.copy()  # pull: the gradient of the quadratic model at the step
    for _ in range(10_000):
        largest = 0.0
        for j in range(len(theta)):
            if h[j, j] <= 0.0:
                continue
            now = theta[j] + step[j]
            free = now - pull[j] / h[j, j]
            limit = l1 / h[j, j] if j < len(theta) - 1 else 0.0
            moved = math.copysign(max(abs(free) - limit, 0.0), free) - now
            if moved:
                step[j] += moved
                pull += moved * h[:, j]
                largest = max(largest, abs(moved) * math.sqrt(h[j, j]))
        if largest < 1e-10:
            break
    return step


def fit_folds(blocks: DataFrame, folds: int, params: dict, weighted: bool) -> list[tuple[np.ndarray, float]] | None:
    """Coefficients and intercept per fold of a model of all *other* folds.

    The loss is that of Spark's ``LogisticRegression`` without standardization: the weighted mean of the logistic loss plus
    ``1 / (C·n)`` times the mixed penalty. Newton steps find its least value, with coordinate descent for an absolute penalty;
    each pass over the blocks gives loss, gradient and curvature of all folds that have not arrived. None if this is no
    case for it: a side with one class, other labels, values that are no numbers, too many features, no convergence.
    """
    counts = _counted(blocks, folds)
    width = blocks.select("width").first()
    if counts is None or counts[:, 2].any() or width["width"] > MAX_WIDTH:
        return None
    size = width["width"] + 1
    classes = counts[:, :2].sum(axis=0) - counts[:folds, :2]  # per fold of the others: rows of class 0, of class 1
    if (classes == 0).any():
        return None
    n = classes.sum(axis=1)
    weights = n[:, None] / (2 * classes) if weighted else np.ones((folds, 2))
    mass = (weights * classes).sum(axis=1)
    mix = {"l2": 0.0, "l1": 1.0, "elasticnet": params.get("l1_ratio", 0.5)}[params["penalty"]]
    strength = 1.0 / (params["C"] * n)
    l1, l2 = strength * mix, strength * (1 - mix)

    def measured(active: list[int], points: np.ndarray) -> np.ndarray:
        own = weights[active]

        def compute(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
            a = np.column_stack([x, np.ones(len(x))])
            out = np.empty((len(active), 1 + size + size * size))
            for i, f in enumerate(active):
                z = a @ points[i]
                w = np.where(y == 1.0, own[i, 1], own[i, 0]) * (fold != f)
                small = np.exp(-np.abs(z))
                p = np.where(z >= 0, 1.0, small) / (1.0 + small)
                out[i, 0] = w @ (np.maximum(z, 0.0) + np.log1p(small) - y * z)
                out[i, 1 : 1 + size] = (w * (p - y)) @ a
                out[i, 1 + size :] = ((a * (w * p * (1.0 - p))[:, None]).T @ a).reshape(-1)
            return out.reshape(-1)

        return _summed(blocks, compute).reshape(len(active), -1) / mass[active, None]

    def penalty(f: int, theta: np.ndarray) -> float:
        return l1[f] * np.abs(theta[:-1]).sum() + l2[f] / 2 * (theta[:-1] ** 2).sum()

    best = np.zeros((folds, size))
    best[:, -1] = np.log(weights[:, 1] * classes[:, 1]) - np.log(weights[:, 0] * classes[:, 0])
    loss = np.full(folds, np.inf)
    step, gain, taken = np.zeros((folds, size)), np.zeros(folds), np.zeros(folds, dtype=int)
    active = list(range(folds))
    for _ in range(MAX_PASSES):
        points = best[active] + step[active]
        if not np.isfinite(points).all():
            return None
        found = measured(active, points)
        left = []
        for f, point, row in zip(active, points, found):
            value = row[0] + penalty(f, point)
            if not np.isfinite(value):
                return None
            if value > loss[f] - 1e-4 * gain[f] and value > loss[f] + 1e-15 * abs(loss[f]):  # too far: half the way
                step[f] /= 2
                gain[f] /= 2
                left.append(f)
                continue
            best[f], loss[f] = point, value
            g, h = row[1 : 1 + size], row[1 + size :].reshape(size, size)
            step[f] = _step(g, h, point, l1[f], l2[f])
            gain[f] = -(g @ step[f] + step[f] @ h @ step[f] / 2 + penalty(f, point + step[f]) - penalty(f, point))
            taken[f] += 1
            if gain[f] > TOLERANCE * abs(value) and taken[f] <= params["max_iter"]:
                left.append(f)
        active = left
        if not active:
            return [(theta[:-1], float(theta[-1])) for theta in best]
    return None


def model_of(blocks: DataFrame, coefficients: np.ndarray, intercept: float, features: str) -> LogisticRegressionModel:
    """Spark's model with these coefficients."""
    from pyspark.ml.common import _py2java

    sc = blocks.sparkSession.sparkContext
    java = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"folds_{id(coefficients):x}", _py2java(sc, Vectors.dense(coefficients)), intercept
    )
    model = LogisticRegressionModel(java)
    model._resetUid(java.uid())
    return model.setFeaturesCol(features)
