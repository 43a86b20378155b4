"""A corpus pipeline: quality, near copies, repeated strings, leaks, mixture.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; it is written as Parquet and read again before the next one
starts, so a lost executor never costs more than one stage.  All stages but
the last return the columns of ``documents``.

Defined results: NULL and empty texts are scored like any other text and count
as copies of each other; rows that repeat are copies; extra columns of
``documents`` pass through; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.llm import decontaminate, mixing, near_duplicates, quality, suffixes
from larkspur.llm.common import read_table, staged


def _with_text(docs: DataFrame, rows: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs``, with a new text and its number of characters."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = quality.score_documents(docs, read_table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return near_duplicates.keep_one_of_each(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that also start anywhere else."""
    return _with_text(docs, suffixes.remove_repeated_bytes(docs, as_text=True), "kept")


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that are mostly such passages go."""
    clean = decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return _with_text(docs, clean, "text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents in the mixture's shards, with the words taken of each."""
    return mixing.cut_texts(mixing.mix(docs)).withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", keep_one_of_near_copies),
    ("suffix-array dedup", cut_repeated_strings),
    ("benchmark decontamination", cut_benchmark_passages),
    ("mixing sources", mix_sources),
]

# A trained classifier and permuted draws have no SQL; tests/llm/test_pipeline.py holds stages 2 to 5
# against plain versions of them, and every score of the classifier against its rules.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES, SQL = {"pipeline": run}, {}
