"""A linear multi-class model over array features: scoring and weight tables.

The model is one matrix with a row per class: the feature weights, then the
bias.  It is the only thing shipped to tasks, and its size is fixed by the
number of classes and features, never by the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T


def zero_weights(n_classes: int, n_features: int) -> np.ndarray:
    """A model that gives every class the same score."""
    return np.zeros((n_classes, n_features + 1))


def matrix_reader(n_features: int):
    """A function turning an Arrow list column into a float64 matrix.

    Returned as a closure so that tasks need no copy of this package.
    """
    def to_matrix(column):
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        if len(flat) != len(column) * n_features:
            raise ValueError(f"every row needs {n_features} features")
        return flat.reshape(len(column), n_features)
    return to_matrix


def score_arrays(df: DataFrame, weights: np.ndarray, features: str = "features",
                 scores: str = "scores") -> DataFrame:
    """The other columns of ``df`` with a ``scores`` array, one entry per class.

    The features go to Python once, in Arrow batches, and are not sent back.
    """
    kept = [c for c in df.columns if c != features]
    score_batch = _scorer(weights, features)
    n_classes = len(weights)

    def run(record_batches):
        for batch in record_batches:
            out = score_batch(batch)
            ends = np.arange(0, out.size + 1, n_classes, dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), column], [*kept, scores])

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(scores, T.ArrayType(T.DoubleType()))])
    return df.mapInArrow(run, schema)


def predict_arrays(df: DataFrame, weights: np.ndarray, key: str = "id",
                   features: str = "features") -> DataFrame:
    """``(key, prediction)``: the class with the largest score, the first one on a tie."""
    score_batch = _scorer(weights, features)

    def run(record_batches):
        for batch in record_batches:
            best = score_batch(batch).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(best)], [key, "prediction"])

    schema = T.StructType([df.schema[key], T.StructField("prediction", T.IntegerType())])
    return df.select(key, features).mapInArrow(run, schema)


def _scorer(weights: np.ndarray, features: str):
    to_matrix = matrix_reader(weights.shape[1] - 1)
    slopes, bias = np.ascontiguousarray(weights[:, :-1].T), weights[:, -1].copy()

    def score_batch(batch):
        return to_matrix(batch.column(features)) @ slopes + bias
    return score_batch


def save_weights(spark: SparkSession, weights: np.ndarray, path: str) -> None:
    """One row per class, replacing an older model at ``path``."""
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(weights)]
    (spark.createDataFrame(rows, "class INT, weights ARRAY<DOUBLE>")
     .coalesce(1).write.mode("overwrite").parquet(path))


def load_weights(spark: SparkSession, path: str) -> np.ndarray:
    """The matrix saved by :func:`save_weights`."""
    rows = spark.read.schema("class INT, weights ARRAY<DOUBLE>").parquet(path).collect()
    return np.array([r["weights"] for r in sorted(rows, key=lambda r: r["class"])])
