"""Fitted models and predictions on Hadoop paths."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def save_model(model: PipelineModel, path: str) -> None:
    """Save a fitted model, replacing an older one under the same path."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a model saved by :func:`save_model`."""
    return PipelineModel.load(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Headed CSV part files, written by the tasks that scored the rows."""
    predictions.write.mode("overwrite").option("header", True).csv(path)
