"""Mix sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source are dealt into blocks by a hash of their id.  A source
whose target is ``q`` times its size and something more gives every block
``q`` times, and for the rest further blocks in a permuted order, the last
one only in part.  The number of such drawn blocks of each source is split
among the output shards by a tree: each node hands half of its shards a
multivariate-hypergeometric share of its blocks, so quotas are exact and
every shard looks like a random draw without replacement.  Shards then take
disjoint runs of their sources' permuted blocks and are shuffled locally.

Only counts by source and by block move before the final shuffle.  The driver
holds one row per source (mixing weights are settings, one per source); with
``n`` documents a source has about ``sqrt(n)`` blocks, so no window holds more
than that many rows, whatever share of the table one source has.

NULL texts have no words and are never taken; a NULL source is a source of its
own, last in order; equal rows are separate rows; an empty table gives an
empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.llm.common import n_words, without

MIX_COLUMNS = ("mix_shard", "mix_place", "mix_copy", "mix_words", "mix_size")
INNER = ("_mix_block", "_mix_source", "_mix_target", "_mix_passes", "_mix_need", "_mix_part", "_mix_order",
         "_mix_draws", "_mix_draw")


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = 3.0) -> list[float]:
    """Words wanted from each source.

    Together they are all words; none exceeds ``most`` times its source, and
    what a capped source cannot give is shared by weight among the others.
    """
    total, capped = float(sum(sizes)), {}
    while len(capped) < len(sizes):
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        unit = max(0.0, total - sum(capped.values())) / weight
        over = [i for i in range(len(sizes)) if i not in capped and weights[i] * unit > most * sizes[i]]
        if not over:
            break
        capped.update((i, most * sizes[i]) for i in over)
    return [capped.get(i, weights[i] * unit if len(capped) < len(sizes) else 0.0) for i in range(len(sizes))]


def split_quotas(counts: Sequence[int], n_shards: int, seed: int) -> np.ndarray:
    """``(shard, source)`` numbers of blocks, drawn down a binary tree of shards.

    Shards hold equal numbers of blocks, give or take one; columns sum to ``counts``.
    """
    counts = np.asarray(counts, dtype=np.int64)
    quotas = np.zeros((n_shards, len(counts)), dtype=np.int64)
    bounds = [int(counts.sum()) * i // n_shards for i in range(n_shards + 1)]
    nodes = [(0, n_shards, counts)]
    while nodes:
        first, last, have = nodes.pop()
        if last - first == 1:
            quotas[first] = have
            continue
        middle = (first + last) // 2
        rng = np.random.default_rng([seed, first, last])
        left = rng.multivariate_hypergeometric(have, bounds[middle] - bounds[first], method="marginals")
        nodes += [(middle, last, have - left), (first, middle, left)]
    return quotas


def _hash(*cols: str | Column, seed: int) -> Column:
    return F.xxhash64(*cols, F.lit(seed))


def allocate(docs: DataFrame, cycle: Sequence[float] = (1, 2, 3), most: float = 3.0, seed: int = 0,
             size: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents with what the mix takes of each, and the drawn blocks of each source.

    ``docs`` needs ``doc_id`` and ``source``, and ``text`` unless ``size`` is
    given.  Sources in code-point order, NULL last, weigh ``cycle`` repeating.
    The first frame adds ``mix_size``, ``_mix_source`` (words of its source),
    ``_mix_target``, ``_mix_passes`` (whole times taken) and ``_mix_part``
    (further words taken, from the last and partial pass).
    """
    spark = docs.sparkSession
    sized = without(docs, [*MIX_COLUMNS, *INNER]).withColumn("mix_size", size if size is not None else n_words(F.col("text")))
    n_blocks = max(1, 2 ** round(math.log2(math.sqrt(docs.count()) + 1)))
    block = F.pmod(_hash("doc_id", seed=seed), F.lit(n_blocks)).cast("int")
    blocks = sized.groupBy("source", block.alias("_mix_block")).agg(F.sum("mix_size").alias("words"))
    rows = blocks.groupBy("source").agg(F.sum("words").alias("words"), F.count("*").alias("blocks")).collect()
    rows = sorted(rows, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["words"] for r in rows]
    wanted = targets(sizes, [cycle[i % len(cycle)] for i in range(len(rows))], most)
    settings = spark.createDataFrame(
        [(r["source"], i, s, t, *(divmod(round(t), s) if s else (0, 0)))
         for i, (r, s, t) in enumerate(zip(rows, sizes, wanted))],
        "source STRING, source_no INT, _mix_source BIGINT, _mix_target DOUBLE, _mix_passes BIGINT, rest BIGINT")
    in_order = Window.partitionBy("source").orderBy(_hash("source", "_mix_block", seed=seed + 1), "_mix_block")
    drawn = (
        blocks.alias("b").join(settings.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
        .select("b.source", "_mix_block", "source_no", "words", "_mix_source", "_mix_target", "_mix_passes", "rest")
        .withColumn("before", F.sum("words").over(in_order) - F.col("words"))
        # Words of the last pass: the whole block, a part of it, or nothing.
        .withColumn("_mix_need", F.greatest(F.lit(0), F.least(F.col("words"), F.col("rest") - F.col("before"))))
    )
    plan = drawn.select(F.col("source").alias("_b_source"), F.col("_mix_block").alias("_b_block"), "_mix_source",
                        "_mix_target", "_mix_passes", "_mix_need")
    placed = sized.withColumn("_mix_block", block).join(
        plan, F.col("source").eqNullSafe(F.col("_b_source")) & (F.col("_mix_block") == F.col("_b_block"))
    ).drop("_b_source", "_b_block")
    # Blocks are small, so one running sum serves whole, partly taken and left out ones alike.
    in_block = Window.partitionBy("source", "_mix_block").orderBy(
        _hash("doc_id", seed=seed + 2), "doc_id", "mix_size").rowsBetween(Window.unboundedPreceding, 0)
    part = F.greatest(F.lit(0), F.least(
        F.col("mix_size"), F.col("_mix_need") - F.sum("mix_size").over(in_block) + F.col("mix_size")))
    return placed.withColumn("_mix_part", part), drawn


def mix(docs: DataFrame, n_shards: int = 64, cycle: Sequence[float] = (1, 2, 3), most: float = 3.0, seed: int = 0,
        size: Column | None = None) -> DataFrame:
    """One row per taken copy of a document.

    Columns of ``docs`` and ``mix_shard``, ``mix_place`` (rows of a shard in
    the order of this number are shuffled), ``mix_copy``, ``mix_size`` (words
    of the document) and ``mix_words`` (those taken; fewer only in the last
    document of a source's last pass).  Columns of ``docs`` with these names
    are replaced.
    """
    spark = docs.sparkSession
    taken, drawn = allocate(docs, cycle, most, seed, size)
    draws = (
        drawn.withColumn("n", F.col("_mix_passes") + (F.col("_mix_need") > 0).cast("int")).filter("n > 0")
        .select("source", "source_no", "_mix_block", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_mix_draw"))
    )
    counts = {r["source_no"]: r["n"] for r in draws.groupBy("source_no").agg(F.count("*").alias("n")).collect()}
    present = sorted(counts)
    quotas = split_quotas([counts[i] for i in present], n_shards, seed)
    ends = spark.createDataFrame([(i, [int(x) for x in np.cumsum(quotas[:, k])]) for k, i in enumerate(present)],
                                 "source_no INT, ends ARRAY<BIGINT>")
    permuted = Window.partitionBy("source_no").orderBy(
        _hash("source_no", "_mix_block", "_mix_draw", seed=seed + 3), "_mix_block", "_mix_draw")
    shards = (
        draws.withColumn("place", F.row_number().over(permuted) - 1).join(ends, "source_no")
        .select(F.col("source").alias("_b_source"), F.col("_mix_block").alias("_b_block"), "_mix_draw",
                F.expr("size(filter(ends, e -> e <= place))").alias("mix_shard"))
        .groupBy("_b_source", "_b_block")
        .agg(F.map_from_entries(F.collect_list(F.struct("_mix_draw", "mix_shard"))).alias("_mix_draws"))
    )
    copies = (
        taken.withColumn("mix_copy", F.explode(F.sequence(
            F.lit(1), (F.col("_mix_passes") + (F.col("_mix_part") > 0).cast("int")).cast("int"))))
        .filter((F.col("_mix_passes") > 0) | (F.col("_mix_part") > 0))
        .withColumn("mix_words", F.when(F.col("mix_copy") > F.col("_mix_passes"), F.col("_mix_part")).otherwise(F.col("mix_size")))
        .filter("mix_words > 0")
        .join(shards, F.col("source").eqNullSafe(F.col("_b_source")) & (F.col("_mix_block") == F.col("_b_block")))
        .withColumn("mix_shard", F.col("_mix_draws")[F.col("mix_copy")])
        .withColumn("mix_place", _hash("mix_shard", "doc_id", "mix_copy", seed=seed + 4))
    )
    return copies.drop("_b_source", "_b_block", *INNER)


def cut_texts(mixed: DataFrame) -> DataFrame:
    """A mix whose partly taken documents have only the words taken, joined by single spaces."""
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    part = F.array_join(F.slice(words, F.lit(1), F.col("mix_words").cast("int")), " ")
    return mixed.withColumn("text", F.when(F.col("mix_words") < F.col("mix_size"), part).otherwise(F.col("text")))


def write_shards(mixed: DataFrame, path: str) -> None:
    """Write a mix, one folder per shard, each shuffled; a shard may span several files."""
    (mixed.repartition("mix_shard", F.pmod(F.col("mix_place"), F.lit(16)))
     .sortWithinPartitions("mix_shard", "mix_place").write.partitionBy("mix_shard").parquet(path))
