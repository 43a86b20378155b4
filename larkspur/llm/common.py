"""What the operators of this package share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from larkspur.sources.shared import work_path

# A word is a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 512


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared work folder and read back.

    It cuts the lineage: a lost executor costs a re-read.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow column as UTF-8; NULL becomes empty."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""


def map_texts(df: DataFrame, function: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow(function, schema)`` for rows that hold whole texts.

    Spark's default of 10,000 rows a batch is far too many of them, so a
    session that has not chosen its own number gets ``BATCH_ROWS``.
    """
    conf = df.sparkSession.conf
    if conf.get(_ROWS_SETTING) == "10000":
        conf.set(_ROWS_SETTING, str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def blocks(batches: Iterable[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches joined or cut so that their texts are together about ``limit`` bytes long."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        low, before = 0, 0
        while low < batch.num_rows:
            high = max(low + (not held), int(np.searchsorted(ends, before + limit - size, side="right")))
            if high > low:
                held.append(batch.slice(low, high - low))
                size += int(ends[high - 1]) - before
            if high < batch.num_rows:
                yield _joined(held)
                held, size = [], 0
            low, before = high, int(ends[high - 1]) if high else 0
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def mix64(values: np.ndarray) -> np.ndarray:
    """A fixed bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns whose names (in any case) would clash with ``names``."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
