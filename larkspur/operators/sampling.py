"""Deterministic epoch order, rank shards and mini-batches.

The order of an epoch is the order of ``md5(seed:epoch:key)``.  A row's exact
place in it is found without a global sort: rows are split by the leading hex
digits of the digest, each bucket numbers its own rows, and a table of bucket
starts (at most ``16 ** digits`` rows, whatever the input size) is broadcast
to shift them.  Keys must be unique, so digests, and with them buckets, spread
evenly whatever the data; a repeated key has no place of its own and fails the
query.  ``read_keyed_parquet`` gives a key to a table that has none.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from larkspur.sources.shared import work_path

# Rows that one bucket's window should hold, about.
ROWS_PER_BUCKET = 50_000
BUCKET, ORDER = "__bucket", "__order"
POSITION, TOTAL = "pos", "n_rows"


def epoch_digest(key: Column, seed: int, epoch: int) -> Column:
    """The digest whose order is the row order of an epoch."""
    return F.md5(F.concat(F.lit(f"{seed}:{epoch}:"), key.cast("string")))


def shuffled_positions(df: DataFrame, key: str, seed: int, epoch: int, digits: int | None = None) -> DataFrame:
    """``df`` with each row's place ``pos`` in the epoch and the row count ``n_rows``.

    One shuffle, plus a count per bucket that reads the key column only.
    ``digits`` sets the number of buckets, ``16 ** digits``; without it, it
    follows from the number of rows.
    """
    if digits is None:
        digits = min(5, max(1, math.ceil(math.log(max(1, df.count() / ROWS_PER_BUCKET), 16))))
    if not 1 <= digits <= 5:
        raise ValueError("digits must be 1..5: the table of bucket starts is broadcast")
    tagged = df.withColumn(ORDER, epoch_digest(F.col(key), seed, epoch))
    tagged = tagged.withColumn(BUCKET, F.substring(ORDER, 1, digits))
    return _number(tagged, ORDER).drop(ORDER)


def ordered_positions(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """As :func:`shuffled_positions`, but in the order of a unique key.

    Buckets are ranges of the key, their number follows from the number of
    rows unless it is given, and positions are exact wherever the edges fall.
    Edges of a numeric key come from a quantile sketch; rows with any other
    key are range-partitioned by it and written once to the work folder, which
    keeps their buckets fixed for the count and the numbering.
    """
    buckets = buckets or max(1, math.ceil(df.count() / ROWS_PER_BUCKET))
    if not isinstance(df.schema[key].dataType, T.NumericType):
        path = work_path(df.sparkSession, "ranges")
        ranged = df.repartitionByRange(buckets, key).withColumn(BUCKET, F.spark_partition_id())
        ranged.write.parquet(path)
        return _number(df.sparkSession.read.schema(ranged.schema).parquet(path), key)
    as_number = df.withColumn(ORDER, F.col(key).cast("double"))
    shares = [i / buckets for i in range(1, buckets)]
    inner = sorted(set(as_number.approxQuantile(ORDER, shares, 0.5 / buckets) if shares else []))
    edges = [float("-inf"), *inner, float("inf")]
    if len(edges) < 3:
        tagged = as_number.withColumn(BUCKET, F.lit(0))
    else:
        tagged = Bucketizer(splits=edges, inputCol=ORDER, outputCol=BUCKET).transform(as_number)
        tagged = tagged.withColumn(BUCKET, F.col(BUCKET).cast("int"))
    return _number(tagged.drop(ORDER), key)


def _number(tagged: DataFrame, order: str) -> DataFrame:
    counts = tagged.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("__count"))
    # Unpartitioned windows, but over one row per bucket only.
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        BUCKET,
        F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__start"),
        F.sum("__count").over(Window.partitionBy()).alias(TOTAL),
    )
    in_bucket = Window.partitionBy(BUCKET).orderBy(order)
    unusable = F.col(order).isNull() | (F.col("__last") == F.col(order))
    refuse = F.raise_error(F.lit("sampling needs a unique key without NULL; "
                                 "see find_repeated_keys and read_keyed_parquet"))
    place = F.col("__start") + F.col("__row") - 1
    return (
        tagged.withColumns({"__row": F.row_number().over(in_bucket), "__last": F.lag(order).over(in_bucket)})
        # Every bucket has a start; an inner join would only add a test that digests anew.
        .join(F.broadcast(starts), BUCKET, "left")
        .withColumn(POSITION, F.when(unusable, refuse.cast("bigint")).otherwise(place))
        .drop(BUCKET, "__row", "__last", "__start")
    )


def shard(positions: DataFrame, world: int) -> DataFrame:
    """Deal positioned rows out to ``world`` ranks, all of equal size.

    Position ``p`` goes to rank ``p % world`` as its row number ``slot``.  When
    the count does not divide evenly, the first rows are repeated behind the
    last one, so a repeated row appears in more than one output row.
    """
    if world < 1:
        raise ValueError("world must be at least 1")
    n = F.col(TOTAL)
    padded = F.expr(f"({TOTAL} + {int(world) - 1}) div {int(world)}") * world
    # Row p also stands at p + n, p + 2n, ... while that is below the padded count.
    places = F.explode(F.sequence(F.col(POSITION), padded - 1, n))
    return (
        positions.withColumn(POSITION, places)
        .withColumn("rank", (F.col(POSITION) % world).cast("int"))
        .withColumn("slot", F.expr(f"{POSITION} div {int(world)}"))
    )


def batches(shards: DataFrame, batch_size: int) -> DataFrame:
    """Number the mini-batches of each rank; the short last one is kept."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    return shards.withColumn("batch", F.expr(f"slot div {int(batch_size)}"))


def epoch_batches(df: DataFrame, key: str, seed: int, epoch: int, world: int, batch_size: int,
                  shuffle: bool = True, digits: int | None = None, buckets: int | None = None) -> DataFrame:
    """Order, shard and batch one epoch: adds ``pos, n_rows, rank, slot, batch``."""
    if shuffle:
        placed = shuffled_positions(df, key, seed, epoch, digits)
    else:
        placed = ordered_positions(df, key, buckets)
    return batches(shard(placed, world), batch_size)
