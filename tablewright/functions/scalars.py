"""Numbers, dates and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(value: Column | str, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(_col(value), digits)


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def entropy(probabilities: Column | str) -> Column:
    """Shannon entropy (natural logarithm) of an array of probabilities."""
    return F.aggregate(
        _col(probabilities),
        F.lit(0.0),
        lambda total, p: total - F.when(p > 0, p * F.ln(p)).otherwise(F.lit(0.0)),
    )


def margin(probabilities: Column | str) -> Column:
    """Gap between the two largest probabilities."""
    ranked = F.sort_array(_col(probabilities), asc=False)
    return F.get(ranked, 0) - F.coalesce(F.get(ranked, 1), F.lit(0.0))


def safe_log1p(value: Column | str) -> Column:
    """``log1p`` for non-negative values, NULL below zero."""
    v = _col(value)
    return F.when(v >= 0, F.log1p(v))


def to_double(value: Column | str) -> Column:
    return _col(value).try_cast("double")


def to_long(value: Column | str) -> Column:
    return _col(value).try_cast("bigint")


def parse_day(value: Column | str, pattern: str = "d.M.yyyy") -> Column:
    """Date from text; an impossible date becomes NULL, not an error."""
    return F.try_to_timestamp(_col(value), F.lit(pattern)).cast("date")


def month_of(value: Column | str) -> Column:
    return F.trunc(_col(value), "MM")


def value_band(value: Column | str, cuts: Sequence[float], names: Sequence[str]) -> Column:
    """Name of the half-open band ``[cut, next cut)``; NULL stays NULL.

    ``names`` has one entry more than the ascending ``cuts``.
    """
    if len(names) != len(cuts) + 1:
        raise ValueError("need one name more than cuts")
    v = _col(value)
    band = F.when(v.isNull(), F.lit(None).cast("string"))
    for cut, name in zip(cuts, names):
        band = band.when(v < F.lit(float(cut)), F.lit(name))
    return band.otherwise(F.lit(names[-1]))


def exceeds_band(value: Column | str, low: float, high: float) -> Column:
    """Severity of a share or ratio: above ``high``, above or at ``low``, below."""
    v = _col(value)
    return F.when(v > high, "high").when(v >= low, "medium").when(v.isNotNull(), "low")
