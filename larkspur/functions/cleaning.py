"""Typing, missing values and label coding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def to_id(text: Column, from_text: bool = True) -> Column:
    """A 64-bit id; NULL when the value does not read as a number in range.

    For text the fraction of a decimal is cut off, which ``try_cast`` alone
    would reject.  The pattern only runs on values the plain cast refuses.
    """
    whole = text.try_cast("bigint")
    if not from_text:
        return whole
    cut = F.regexp_extract(text, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(whole, cut.try_cast("bigint"))


def to_float(value: Column) -> Column:
    """A 32-bit float; NULL when the value does not read as a number."""
    return value.try_cast("float")


def missing_to_null(value: Column, dtype: T.DataType) -> Column:
    """NULL for NULL, NaN and blank text; every other value unchanged."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        is_nan = F.coalesce(F.isnan(value.try_cast("double")), F.lit(False))
        return F.when((F.trim(value) != "") & ~is_nan, value)
    return value


def to_binary_label(label: Column) -> Column:
    """Labels coded -1/1 become 0/1; labels coded 0/1 stay."""
    return F.when(label < 0, F.lit(0.0)).otherwise(label.cast("double"))
