"""Metric points: ``(ts, measurement, namespace, pod, value, point_id)`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

POINT_COLUMNS = ("point_id", "ts", "measurement", "namespace", "pod", "value")


def read_points_stream(spark: SparkSession, path: str, schema: T.StructType,
                       files_per_trigger: int | None = None) -> DataFrame:
    """An unbounded scan over Parquet files as they land at ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def to_points(raw: DataFrame, point_id: str, ts: str, measurement, namespace, pod, value) -> DataFrame:
    """Name the columns of a raw table as metric points.

    ``ts`` keeps its type; streams need it cast with :func:`with_event_time`.
    """
    return raw.select(
        raw[point_id].alias("point_id"),
        raw[ts].alias("ts"),
        measurement.alias("measurement"),
        namespace.alias("namespace"),
        pod.alias("pod"),
        value.alias("value"),
    )


def with_event_time(points: DataFrame) -> DataFrame:
    """Cast ``ts`` to the zoned timestamp type that watermarks require."""
    return points.withColumn("ts", points["ts"].cast("timestamp"))
