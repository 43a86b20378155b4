"""How a training table is cut: by its size and its rows' content, never by the cluster."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

# A slice holds about SMALL bytes until there are FEW slices, and about LARGE beyond them.
SMALL, FEW, LARGE = 1 << 20, 64, 64 << 20
# Copies of one row that are dealt together.
TOGETHER = 4096


def planned_slices(n_rows: int, row_bytes: int) -> int:
    """Number of slices for a table of ``n_rows`` staged rows; it never falls when the table grows."""
    total = n_rows * row_bytes
    return max(1, min(FEW, math.ceil(total / SMALL)), math.ceil(total / LARGE))


def deal_rows(rows: DataFrame, n: int, label: str, vector: str) -> DataFrame:
    """``(label, vector)`` rows in ``n`` slices by their content, sorted in each.

    The same rows give the same slices from any number of files, in any order,
    on any cluster.  A row that is there more than ``TOGETHER`` times is counted
    before it is shuffled and its copies are dealt in runs, so that a table of
    few different rows fills all slices.
    """
    values = vector_to_array(vector)
    content = F.xxhash64(label, values)
    if rows.groupBy(content).count().filter(F.col("count") > TOGETHER).isEmpty():
        keyed = rows.withColumn("__content", content)
        return keyed.repartition(n, "__content").sortWithinPartitions("__content").select(label, vector)
    counted = rows.groupBy(label, values.alias("__values")).agg(F.count(F.lit(1)).alias("__n"))
    runs = counted.select("*", F.xxhash64(label, "__values").alias("__content"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / TOGETHER))).alias("__run"))
    dealt = runs.repartition(n, "__content", "__run").sortWithinPartitions("__content", "__run")
    copies = F.least(F.lit(TOGETHER).cast("long"), F.col("__n") - F.col("__run") * TOGETHER)
    return dealt.select(label, array_to_vector("__values").alias(vector), F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("__copy")).drop("__copy")
