"""Accuracy, loss and spread: single-pass aggregates over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from larkspur.functions.vectors import argmax_class, cross_entropy


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: ``(rows, correct, accuracy)``."""
    hit = (F.col(prediction).cast("double") == F.col(label).cast("double")).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(hit).cast("bigint").alias("correct"),
        F.avg(hit).alias("accuracy"),
    )


def mean_cross_entropy(df: DataFrame, scores: str = "scores", label: str = "label") -> DataFrame:
    """One row: summed loss over all rows, divided by all rows, and accuracy.

    The division is by the rows that were scored, however many shards hold
    them.
    """
    s, y = F.col(scores), F.col(label)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(cross_entropy(s, y)).alias("loss"),
        F.avg((argmax_class(s) == y.cast("int")).cast("double")).alias("accuracy"),
    )


def column_deviation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, deviation)``: sample standard deviation of each column, in one pass."""
    wide = df.agg(*(F.stddev_samp(F.col(c).cast("double")).alias(c) for c in columns))
    return wide.unpivot([], list(columns), "feature", "deviation")


def vector_deviation(df: DataFrame, features: str = "features") -> DataFrame:
    """One row with the sample standard deviation of each vector slot."""
    return df.select(Summarizer.std(F.col(features)).alias("deviation"))
