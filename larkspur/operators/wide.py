"""Binary logistic regression over vectors that are made as they are read.

A wide dense table may be hundreds of times its source, and Spark's own fit
keeps a scaled copy of every row, in memory and on disk.  Here each pass makes
the vectors of a few rows at a time from narrow staged columns, adds up what it
needs and drops them.  A task gives one vector of sums, the JVM adds these up,
and the driver holds the coefficients and takes the quasi-Newton steps.  What is
minimised is what Spark's estimator minimises: mean log loss, and half the L2
strength times the squared weights of features of unit sample deviation.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame

from larkspur.operators.sgd import summed

# Bytes of vectors that a task holds at a time.
HELD_BYTES = 4 << 20
# Pairs that the quasi-Newton steps remember, and the most trials of one step.
MEMORY, TRIALS = 10, 30

# From an Arrow batch of staged rows to their matrix of 64-bit floats, without this package.
Expand = Callable[[pa.RecordBatch], np.ndarray]


@dataclass
class WideModel:
    """Coefficients of the vectors as they are, and the objective at the start and after each step."""

    coefficients: np.ndarray
    intercept: float
    objective: list


def _pieces(expand: Expand, width: int):
    """A function from Arrow batches to ``(matrix, rows)`` pieces of about ``HELD_BYTES``, as a closure."""
    at_once = max(1, HELD_BYTES // (8 * width))

    def pieces(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, at_once):
                rows = batch.slice(low, at_once)
                yield expand(rows), rows

    return pieces


def _totals(rows: DataFrame, label: str, pieces, add, size: int) -> np.ndarray:
    """The sum over all rows of what ``add`` puts into a vector of ``size`` numbers."""

    def partial(batches):
        total, some = np.zeros(size), False
        for x, piece in pieces(batches):
            y = piece.column(label).to_numpy(zero_copy_only=False).astype(np.float64)
            if not ((y == 0) | (y == 1)).all():
                raise ValueError("labels must be 0 or 1")
            add(total, x, y)
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["part"])

    tasks = rows.mapInArrow(partial, "part ARRAY<DOUBLE>").withColumn("part", array_to_vector("part"))
    return summed(tasks, rows.sparkSession.sparkContext.defaultParallelism).first()["total"].toArray()


def moments(rows: DataFrame, expand: Expand, width: int, label: str = "label") -> tuple[int, float, np.ndarray, np.ndarray]:
    """Row count, share of label 1, and mean and sample deviation of each slot, in two passes."""
    if rows.isEmpty():
        raise ValueError("the training table is empty")
    pieces = _pieces(expand, width)

    def sums(total, x, y):
        total[:-2] += x.sum(axis=0)
        total[-2:] += len(y), y.sum()

    found = _totals(rows, label, pieces, sums, width + 2)
    if not np.isfinite(found).all():
        raise ValueError("vectors must be finite numbers")
    n = int(found[-2])
    mean = found[:-2] / n

    def squares(total, x, y):
        x = x - mean
        total += np.einsum("ij,ij->j", x, x)

    spread = np.sqrt(_totals(rows, label, pieces, squares, width) / max(1, n - 1))
    return n, float(found[-1] / n), mean, spread


def fit(rows: DataFrame, expand: Expand, width: int, estimator: LogisticRegression, label: str = "label") -> WideModel:
    """Scale and fit as ``estimator`` is set (L2 only); ``expand`` gives the ``width`` slots of staged ``rows``.

    Each evaluation is one job over the staged rows.  Slots that do not vary get no weight.
    """
    if estimator.getRegParam() and estimator.getElasticNetParam():
        raise ValueError("wide fits have no L1 penalty")
    n, share, mean, spread = moments(rows, expand, width, label)
    if share in (0.0, 1.0):
        return WideModel(np.zeros(width), float("inf") if share else float("-inf"), [0.0])
    scale = np.divide(1.0, spread, out=np.zeros(width), where=spread > 0)
    strength, pieces = estimator.getRegParam(), _pieces(expand, width)

    def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
        slopes = weights[:-1] * scale
        base = weights[-1] - float(mean @ slopes)

        def add(total, x, y):
            margin = x @ slopes + base
            pull = 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700))) - y
            total[:-2] += pull @ x
            total[-2:] += pull.sum(), (np.logaddexp(0.0, margin) - y * margin).sum()

        total = _totals(rows, label, pieces, add, width + 2) / n
        gradient = np.append((total[:-2] - mean * total[-2]) * scale + strength * weights[:-1], total[-2])
        return float(total[-1] + 0.5 * strength * (weights[:-1] @ weights[:-1])), gradient

    start = np.append(np.zeros(width), np.log(share / (1.0 - share)))
    weights, objective = minimise(evaluate, start, estimator.getMaxIter(), estimator.getTol())
    slopes = weights[:-1] * scale
    return WideModel(slopes, float(weights[-1] - mean @ slopes), objective)


def minimise(evaluate: Callable, point: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, list]:
    """L-BFGS: the last point, and the values at the start and after each step; no step raises the value."""
    value, gradient = evaluate(point)
    values, pairs = [value], deque(maxlen=MEMORY)
    for _ in range(max_iter):
        if np.linalg.norm(gradient) <= tol * max(1.0, abs(value)):
            break
        way = -_curved(gradient, pairs)
        slope, low, high = float(gradient @ way), 0.0, float("inf")
        step, best = (1.0 if pairs else 1.0 / np.linalg.norm(way)), None
        for _ in range(TRIALS):
            there, pull = evaluate(point + step * way)
            if there > value + 1e-4 * step * slope:
                high = step
            else:
                best = step, there, pull
                if pull @ way >= 0.9 * slope:
                    break
                low = step
            step = 2.0 * low if high == float("inf") else (low + high) / 2.0
        if best is None:
            break
        step, there, pull = best
        change, turn = step * way, pull - gradient
        if change @ turn > 0:
            pairs.append((change, turn))
        settled = value - there <= tol * max(abs(value), abs(there), 1e-6)
        point, value, gradient = point + change, there, pull
        values.append(value)
        if settled:
            break
    return point, values


def _curved(gradient: np.ndarray, pairs: deque) -> np.ndarray:
    """The gradient times the inverse curvature that the remembered pairs give."""
    way, used = gradient.copy(), []
    for change, turn in reversed(pairs):
        share = (change @ way) / (change @ turn)
        way -= share * turn
        used.append(share)
    if pairs:
        change, turn = pairs[-1]
        way *= (change @ turn) / (turn @ turn)
    for (change, turn), share in zip(pairs, reversed(used)):
        way += (share - (turn @ way) / (change @ turn)) * change
    return way


def evaluate_rows(model: WideModel, rows: DataFrame, expand: Expand, label: str = "label") -> DataFrame:
    """``(label, prediction)`` of staged rows, for the evaluation operators."""
    slopes, intercept = model.coefficients, model.intercept
    pieces = _pieces(expand, len(slopes))

    def predict(batches):
        for x, piece in pieces(batches):
            found = (x @ slopes + intercept > 0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([piece.column(label), pa.array(found)], ["label", "prediction"])

    kind = rows.schema[label].dataType.simpleString()
    return rows.mapInArrow(predict, f"label {kind}, prediction DOUBLE")
