"""Array data sets: Parquet rows holding an array column and a label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_arrays(spark: SparkSession, path: str, part: str | None = None, key: str = "id",
                train_share: float = 0.8) -> DataFrame:
    """Array rows, all of them or one fixed part, ``"train"`` or ``"test"``.

    A row's part depends on its key alone, so parts never overlap, never
    change between reads, and need no shuffle.
    """
    rows = spark.read.parquet(path)
    if part is None:
        return rows
    if part not in ("train", "test"):
        raise ValueError(f"part must be 'train' or 'test', not {part!r}")
    chosen = in_train_part(F.col(key), train_share)
    return rows.filter(chosen if part == "train" else ~chosen)


def part_of(key: Column, train_share: float = 0.8) -> Column:
    """The part of a key, ``"train"`` or ``"test"``, for one scan that tells both."""
    return F.when(in_train_part(key, train_share), "train").otherwise("test")


def in_train_part(key: Column, train_share: float = 0.8) -> Column:
    """True for the share of keys whose digest falls below the cut."""
    if not 0.0 < train_share < 1.0:
        raise ValueError("train_share must lie between 0 and 1")
    return F.substring(F.md5(key.cast("string")), 1, 8) < F.lit(share_cut(train_share))


def share_cut(train_share: float) -> str:
    """The eight-hex-digit digest prefix that splits off ``train_share`` of the keys."""
    return f"{int(train_share * 0x100000000):08x}"


def write_arrays(df: DataFrame, path: str) -> None:
    """Array rows or array predictions, replacing what was at ``path``."""
    df.write.mode("overwrite").parquet(path)
