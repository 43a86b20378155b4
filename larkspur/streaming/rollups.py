"""Streams of metric points: copy to a table, roll up by window, alert."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.operators.rollup import top_of, usage_over_time
from larkspur.sources.points import with_event_time

BATCH = "batch_id"


def copy_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all rows now available to a Parquet table, each exactly once."""
    (stream.writeStream.format("parquet").option("path", path)
     .option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def rollup_stream(points: DataFrame, width: str, delay: str, *tags: str) -> DataFrame:
    """Windowed rollup of an unbounded table.

    ``delay`` is how long a window stays open for late points; a point later
    than that is left out, and :func:`late_points` counts them.  State is one
    row per open window, measurement and tag.
    """
    timed = with_event_time(points).withWatermark("ts", delay)
    return usage_over_time(timed, width, *tags)


def with_alerts(rollup: DataFrame, limit: float, on: str = "mean_value") -> DataFrame:
    """A rollup whose windows say whether they are over the limit.

    It filters nothing, so that on a stream a window that falls to the limit
    again is written once more and withdraws its alert.
    """
    return rollup.withColumn("over", F.col(on) > limit)


def write_updates(rollup: DataFrame, path: str, checkpoint: str) -> int:
    """Write the windows each micro-batch changed to a partition of its own.

    A batch that is run again after a failure replaces its own partition, so
    the table never holds a change twice.  Returns the number of points that
    this run read.
    """
    def save(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    running = (rollup.writeStream.outputMode("update").foreachBatch(save)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    # Only the newest reports are kept, so they are read while the stream runs.
    read: dict[int, int] = {}
    ended = False
    while not ended:
        ended = running.awaitTermination(1)
        read.update((p.batchId, p.numInputRows) for p in running.recentProgress if p.numInputRows)
    return sum(read.values())


def late_points(spark: SparkSession, path: str, read: int) -> int:
    """Points that came after their window was closed: those read by all runs, less those counted."""
    counted = read_updates(spark, path, *_tags(spark, path)).agg(F.sum("points")).first()[0]
    return read - (counted or 0)


def _tags(spark: SparkSession, path: str) -> list[str]:
    fixed = {"window_start", "measurement", "mean_value", "peak_value", "points", "over", BATCH}
    return [c for c in spark.read.parquet(path).columns if c not in fixed]


def compact(spark: SparkSession, path: str, into: str, *tags: str) -> None:
    """Write the newest version of each window to another table, for readers of windows that are closed."""
    read_updates(spark, path, *tags).write.mode("overwrite").parquet(into)


def write_closed(rollup: DataFrame, path: str, checkpoint: str) -> None:
    """Append windows once, when the watermark has passed their end."""
    (rollup.writeStream.outputMode("append").format("parquet").option("path", path)
     .option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def read_updates(spark: SparkSession, path: str, *tags: str) -> DataFrame:
    """The newest version of each window written by :func:`write_updates`."""
    rows = spark.read.parquet(path)
    newest = [F.max_by(v, BATCH).alias(v) for v in ("mean_value", "peak_value", "points", "over") if v in rows.columns]
    return rows.groupBy("window_start", "measurement", *tags).agg(*newest)


def read_alerts(spark: SparkSession, path: str, *tags: str) -> DataFrame:
    """Windows of :func:`with_alerts` that are over the limit in their newest version."""
    return read_updates(spark, path, *tags).filter("over").drop("over")


def write_usage_and_late(points: DataFrame, path: str, checkpoint: str, width: str, delay: str, *tags: str) -> None:
    """A rollup that loses no point: what comes after its window was closed goes to a table of its own.

    A micro-batch's watermark is the newest time of the batches before it, less
    ``delay``.  Points of windows that end after it are added up per window and
    written under ``path/windows``; the others go, as they are, to
    ``path/late``.  Each batch owns one partition of either table and of
    ``path/marks``, which holds its newest time, so that a batch run again after
    a failure replaces what it wrote and sees the same watermark.
    """
    spark = points.sparkSession
    marks_path = f"{path}/marks"

    def save(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            newest = batch.agg(F.max("ts").alias("newest"))
            earlier = _partition_rows(spark, marks_path, "newest TIMESTAMP")
            mark = None if earlier is None else earlier.filter(F.col(BATCH) < batch_id).agg(F.max("newest")).first()[0]
            end = F.window("ts", width).getField("end")
            closed = F.lit(False) if mark is None else end <= F.lit(mark) - F.expr(f"INTERVAL {delay}")
            split = batch.withColumn("__closed", closed)
            sums = split.filter(~F.col("__closed")).groupBy(F.window("ts", width).alias("w"), "measurement", *tags).agg(
                F.sum("value").alias("total"), F.max("value").alias("peak_value"), F.count(F.lit(1)).alias("points"))
            named = sums.select(F.col("w.start").alias("window_start"), "measurement", *tags, "total", "peak_value", "points")
            named.write.mode("overwrite").parquet(f"{path}/windows/{BATCH}={batch_id}")
            split.filter("__closed").drop("__closed").write.mode("overwrite").parquet(f"{path}/late/{BATCH}={batch_id}")
            newest.write.mode("overwrite").parquet(f"{marks_path}/{BATCH}={batch_id}")
        finally:
            batch.unpersist()

    (with_event_time(points).writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def _partition_rows(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Rows of all batches' partitions, or None before the first."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(f"{schema}, {BATCH} BIGINT").parquet(path)


def read_usage(spark: SparkSession, path: str, *tags: str) -> DataFrame:
    """Windows of :func:`write_usage_and_late`, the batches' shares added up."""
    rows = spark.read.parquet(f"{path}/windows")
    return rows.groupBy("window_start", "measurement", *tags).agg(
        (F.sum("total") / F.sum("points")).alias("mean_value"), F.max("peak_value").alias("peak_value"), F.sum("points").alias("points"))


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Points of :func:`write_usage_and_late` that came after their window was closed."""
    return spark.read.parquet(f"{path}/late").drop(BATCH)


def latest_stream(points: DataFrame, *tags: str) -> DataFrame:
    """The newest value of each tag as a stream's state: one row a tag, whatever order points come in."""
    newest = F.max(F.struct("ts", "point_id", "value")).alias("newest")
    return with_event_time(points).groupBy(*tags).agg(newest).select(*tags, "newest.ts", "newest.point_id", "newest.value")


def write_latest(latest: DataFrame, path: str, checkpoint: str) -> None:
    """Write the tags that each micro-batch changed to a partition of its own."""
    def save(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    (latest.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def read_latest(spark: SparkSession, path: str, *tags: str) -> DataFrame:
    """Newest value and time of each tag, from the versions that the batches wrote."""
    newest = F.max(F.struct("ts", "point_id", "value")).alias("newest")
    return spark.read.parquet(path).groupBy(*tags).agg(newest).select(*tags, "newest.value", "newest.ts")


def top_latest(spark: SparkSession, path: str, k: int, *tags: str) -> DataFrame:
    """For each measurement the ``k`` tags with the largest newest value now; ties go by tag."""
    return top_of(read_latest(spark, path, "measurement", *tags), k, *tags)
