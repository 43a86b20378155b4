"""Embedding whitening: leading components of a centred covariance that Spark sums up.

Entries become whole numbers ``floor(scale * c) + shift``.  The fit list is each
different vector once, found by a ``groupBy`` (which combines before it
shuffles) and written; over it run three sums: whole-number totals of every
dimension, the products of centred entries, and those of whitened entries.  The
driver holds one matrix of the vector's width: it is made tridiagonal by
Householder reflections, its leading eigenvalues are bisected by Sturm counts,
and their vectors found by inverse iteration (``eigen``).  The components go to
all rows, which are projected where they lie.

Rows whose vector is NULL, holds a NULL, NaN or infinite entry, or one that is
no 64-bit number after scaling (2^50 and beyond), are left out; of vectors of
different widths those of the commonest width (the wider one of two) remain.
Repeated rows and ids are rows of their own; a NULL id stays NULL.  Components
whose eigenvalue is 0 to double precision have no whitened values, so a table
of one vector, or an empty one, gives none.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from larkspur.llm.common import staged
from larkspur.llm.eigen import EPS, leading_components

_LOW = (1 << 32) - 1
BLOCK_ROWS = 4096


@dataclass
class Whitening:
    """A fitted projection."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def whole_numbers(df: DataFrame, vector: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """The rows that remain, with ``x``: the vector as whole numbers."""
    c = F.col(f"`{vector}`")
    fits = F.forall(c, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e.cast("double")) < float(1 << 50)), F.lit(False)))
    fine = df.filter(c.isNotNull() & F.coalesce(fits, F.lit(False)))
    widths = fine.groupBy(F.size(c).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = widths["width"] if widths else 0
    x = F.transform(c, lambda e: F.floor(e.cast("double") * scale).cast("long") + F.lit(shift).cast("long"))
    return fine.filter(F.size(c) == width).withColumn("x", x)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(low, BLOCK_ROWS)
            flat = part.column("x").flatten().to_numpy()
            yield part, flat.reshape(part.num_rows, -1)


def _totals(fit_list: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their entries."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for _, x in _matrices(batches):
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & _LOW).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(high), dtype=np.int32)), pa.array(high), pa.array(low), pa.array(np.full(len(high), n))],
                names=["place", "high", "low", "n"])

    exact = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low", "n")]
    rows = fit_list.mapInArrow(add, "place INT, high BIGINT, low BIGINT, n BIGINT").groupBy("place").agg(*exact).orderBy("place").collect()
    return int(rows[0]["n"]) if rows else 0, [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n``, the whole part taken away exactly."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    return (x - whole).astype(float) - np.array([(s % n) / n for s in sums])


def _products(fit_list: DataFrame, rows_of, width: int) -> np.ndarray:
    """Sum of the outer products of the rows that ``rows_of`` makes of each block."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, x in _matrices(batches):
            y = rows_of(x)
            total += y.T @ y
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["place", "part"])

    parts = fit_list.mapInArrow(multiply, "place INT, part ARRAY<DOUBLE>")
    summed = parts.groupBy("place").agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("row"))
    found = np.zeros((width, width))
    for row in summed.collect():
        found[row["place"]] = row["row"]
    return (found + found.T) / 2


def fit(rows: DataFrame, k: int = 16) -> Whitening:
    """Fit on the different vectors of ``whole_numbers``' rows."""
    fit_list = staged(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit-list")
    n, sums = _totals(fit_list)
    width = len(sums)
    if not n or not width:
        return Whitening(0, [], np.zeros(0), np.zeros((0, width)), 0.0)
    covariance = _products(fit_list, lambda x: centred(x, n, sums), width) / n
    values, components = leading_components(covariance, k)
    some = values > max(4 * width * EPS * max(values[0], 0.0), np.finfo(float).tiny)
    found = Whitening(n, sums, values[some], components[some], float(np.trace(covariance)))
    if some.any():
        white = _products(fit_list, lambda x: project(x, found), int(some.sum())) / n
        found.identity_error = float(np.abs(white - np.eye(len(white))).max())
    return found


def project(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened values of whole-number vectors."""
    return centred(x, model.n, model.sums) @ model.components.T / np.sqrt(model.values)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of ``(n x - sums)^2``, exact; None where they are no 64-bit number."""
    whole, rest = np.array([s // n for s in sums], dtype=np.int64), np.array([s % n for s in sums], dtype=np.int64)
    y = x - whole
    if len(y) and (float(np.abs(y).max()) + 1) ** 2 * float(n) ** 2 * len(sums) < 2.0 ** 62:
        return ((n * y - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(v) - int(r)) ** 2 for v, r in zip(row, rest)) for row in y]
    return [v if v < 1 << 63 else None for v in exact]


def transform(rows: DataFrame, model: Whitening, vec_id: str = "vec_id") -> DataFrame:
    """``(vec_id, deviation, whitened)`` of every row of ``whole_numbers``."""
    id_type = rows.schema[vec_id].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches):
            white = project(x, model)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(deviations(x, model.n, model.sums), pa.int64()), pa.array(list(white), pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "whitened"])

    return rows.select(F.col(f"`{vec_id}`").alias("vec_id"), "x").mapInArrow(
        emit, f"vec_id {id_type}, deviation BIGINT, whitened ARRAY<DOUBLE>")


def whitened_components(df: DataFrame, k: int = 16) -> DataFrame:
    """A row for every remaining row and component: ``(vec_id, component, n, deviation, whitened, explained, identity_error)``."""
    rows = whole_numbers(df.select("vec_id", "embedding"))
    model = fit(rows, k)
    if not len(model.values):
        empty = rows.limit(0)
        return empty.select("vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
                            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])
    shares = F.array(*[F.lit(v) for v in model.explained])
    each = transform(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.element_at(shares, F.col("place") + 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
