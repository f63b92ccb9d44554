"""Stored sketches: approximate distinct counts and quantiles that merge without another scan.

A sketch table has one row per part of a table (a day, a source, a load). Parts
are sketched once; figures of any set of parts come from their sketches alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

LOG_SIZE = 12  # registers of a distinct-count sketch, as a power of two
QUANTILE_SIZE = 800  # items per level of a quantile sketch

# three standard errors of a distinct count, relative; and the rank error that 99 of 100 quantiles keep
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_SIZE / 2)
RANK_ERROR = 0.01


def sketch_parts(
    df: DataFrame, parts: Sequence[str], distinct: Sequence[str] = (), values: Sequence[str] = (),
    log_size: int = LOG_SIZE, size: int = QUANTILE_SIZE,
) -> DataFrame:
    """One row per part: ``n_rows``, ``distinct_<c>`` and ``values_<c>``, binary columns to store.

    Missing values are left out of the sketches; a part without any has NULL in
    place of a quantile sketch.
    """
    return df.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.hll_sketch_agg(F.col(c), log_size).alias(f"distinct_{c}") for c in distinct],
        *[
            F.when(F.count(_number(c)) > 0, F.kll_sketch_agg_double(_number(c), size)).alias(f"values_{c}") for c in values
        ],
    )


def _number(column: str):
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def merged(
    sketches: DataFrame, by: Sequence[str], distinct: Sequence[str] = (), values: Sequence[str] = (),
    quantiles: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """Figures of all parts that agree in ``by``: ``n_rows``, ``n_<c>`` and ``q_<c>``, an array of the quantiles, NULL without values."""
    united = sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"distinct_{c}")).alias(f"n_{c}") for c in distinct],
        *[F.kll_merge_agg_double(f"values_{c}").alias(f"_s_{c}") for c in values],
        *[F.count(f"values_{c}").alias(f"_n_{c}") for c in values],
    )
    return united.select(
        *by, "n_rows", *[f"n_{c}" for c in distinct],
        *[
            F.when(
                F.col(f"_n_{c}") > 0, F.array(*[F.kll_sketch_get_quantile_double(f"_s_{c}", F.lit(float(q))) for q in quantiles])
            ).alias(f"q_{c}") for c in values
        ],
    )
