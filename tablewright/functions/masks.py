"""Row predicates that never yield NULL, so ``~mask`` keeps rows with missing values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def _false_if_null(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def damaged_text(text: Column | str, run: int = 3) -> Column:
    """A run of at least ``run`` replacement characters or question marks."""
    return _false_if_null(F.col(text).rlike(f"[\\x{{FFFD}}?]{{{run},}}") if isinstance(text, str)
                          else text.rlike(f"[\\x{{FFFD}}?]{{{run},}}"))


def short_text(text: Column | str, min_len: int = 50) -> Column:
    """Fewer than ``min_len`` characters (code points)."""
    return _false_if_null(F.length(text) < F.lit(min_len))


def number(value: Column | str) -> Column:
    """A number as double, with NaN as NULL; every figure over numbers reads its input through this."""
    column = F.col(value) if isinstance(value, str) else value
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def missing(name: str, data_type: T.DataType) -> Column:
    """NULL, or NaN in a floating-point column."""
    column = F.col(f"`{name}`")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()
