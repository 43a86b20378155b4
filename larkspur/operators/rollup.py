"""Metric-point reports: inventory, rollups over time, latest usage, alerts.

Every report aggregates before it shuffles, so a node, pod or measurement that
holds most of the points costs no more than an even one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def measurements(points: DataFrame) -> DataFrame:
    """Each measurement with its number of points."""
    return points.groupBy("measurement").agg(F.count(F.lit(1)).alias("points"))


def in_range(points: DataFrame, start=None, end=None) -> DataFrame:
    """Points with ``start <= ts < end``; either end may be open.

    Ends are times, or text read as one, in the wall-clock of the ``ts`` column.
    """
    kind = points.schema["ts"].dataType
    if start is not None:
        points = points.filter(F.col("ts") >= F.lit(str(start)).cast(kind))
    return points if end is None else points.filter(F.col("ts") < F.lit(str(end)).cast(kind))


def pick(points: DataFrame, namespace=None, pod=None, measurement=None) -> DataFrame:
    """Points of one namespace, one pod and/or one measurement."""
    if measurement is not None:
        points = points.filter(F.col("measurement") == F.lit(measurement))
    if namespace is not None:
        points = points.filter(F.col("namespace") == F.lit(namespace))
    return points if pod is None else points.filter(F.col("pod") == F.lit(pod))


def usage_over_time(points: DataFrame, width: str = "10 seconds", *tags: str) -> DataFrame:
    """Mean, peak and number of points per window, measurement and tag."""
    return (
        points.groupBy(F.window("ts", width).alias("w"), "measurement", *tags)
        .agg(F.avg("value").alias("mean_value"), F.max("value").alias("peak_value"),
             F.count(F.lit(1)).alias("points"))
        .select(F.col("w.start").alias("window_start"), "measurement", *tags,
                "mean_value", "peak_value", "points")
    )


def pod_usage(points: DataFrame, width: str = "10 seconds", namespace=None, pod=None,
              start=None, end=None) -> DataFrame:
    """:func:`usage_over_time` by namespace and pod, for the chosen ones."""
    return usage_over_time(in_range(pick(points, namespace, pod), start, end), width, "namespace", "pod")


def latest_usage(points: DataFrame, *tags: str) -> DataFrame:
    """Newest value per tag; points of one instant are settled by the larger id.

    Two rounds of maxima, the newest time of each tag and then the largest id
    at it, need no sort of the points, whatever the type of the id.
    """
    newest = points.groupBy(*(F.col(t).alias(f"__{t}") for t in tags)).agg(F.max("ts").alias("__ts"))
    same = [F.col(t).eqNullSafe(F.col(f"__{t}")) for t in tags]
    at_newest = points.join(newest, [*same, F.col("ts") == F.col("__ts")])
    return at_newest.groupBy(*tags).agg(F.max_by("value", "point_id").alias("value"), F.max("ts").alias("ts"))


def top_usage(points: DataFrame, k: int, *tags: str) -> DataFrame:
    """For each measurement the ``k`` tags with the largest newest value; ties go by tag."""
    return top_of(latest_usage(points, "measurement", *tags), k, *tags)


def top_of(latest: DataFrame, k: int, *tags: str) -> DataFrame:
    """The ``k`` tags of each measurement with the largest value."""
    order = Window.partitionBy("measurement").orderBy(F.desc("value"), *tags)
    return latest.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def alerts(rollup: DataFrame, limit: float, on: str = "mean_value") -> DataFrame:
    """Windows of a rollup whose value is over the limit."""
    return rollup.filter(F.col(on) > limit)
