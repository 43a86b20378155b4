"""Functions of array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Dtype names and the element types they stand for.
DTYPES = {"fp32": "float", "fp64": "double"}


def to_dtype(values: Column, dtype: str) -> Column:
    """Array elements as ``fp32`` or ``fp64``; no other name is accepted."""
    if dtype not in DTYPES:
        raise NotImplementedError(f"dtype {dtype!r}: use one of {sorted(DTYPES)}")
    return values.cast(f"array<{DTYPES[dtype]}>")


def scale_pixels(values: Column, top: float = 255.0) -> Column:
    """Byte intensities 0..``top`` as numbers in [0, 1]."""
    return F.transform(values, lambda v: v.cast("double") / F.lit(top))


def argmax_class(scores: Column) -> Column:
    """Zero-based place of the largest score; the first one on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def log_sum_exp(scores: Column) -> Column:
    """log(sum(exp(scores))), shifted by the maximum so that it cannot overflow."""
    def shifted_by(top: Column) -> Column:
        return F.log(F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s.cast("double") - top))) + top

    # A one-element array binds the maximum, so that it is not found anew for each score.
    return F.element_at(F.transform(F.array(F.array_max(scores).cast("double")), shifted_by), 1)


def cross_entropy(scores: Column, label: Column) -> Column:
    """Loss of one row: log-sum-exp of its scores minus its label's score."""
    return log_sum_exp(scores) - F.element_at(scores, label.cast("int") + 1)
