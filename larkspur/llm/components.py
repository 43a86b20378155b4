"""Connected components of a graph of links, as a series of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larkspur.llm.common import staged


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node that ``(u, v)`` edges name; ``root`` is the least node reached.

    Large-star and small-star steps turn each component into a star around its
    least node in a logarithmic number of rounds.  Each round is written to the
    shared folder; minima are partial sums, and joins on a node of very high
    degree can be split, so no component meets in one task.
    """
    edges = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while (mark := _mark(edges)) != before:
        before = mark
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
        edges = staged(small, "links")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
