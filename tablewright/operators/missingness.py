"""Are values missing at random? Little's test from one aggregate over the patterns of missing values.

All that the test needs of the rows are, for every pattern, their number, the
sums and the products of the values that are there. Means and covariances under
missing values are then estimated by EM over the patterns, and each pattern's
means are compared with the estimate: if values are missing completely at
random they differ only by chance.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tablewright.functions import masks

MOST_COLUMNS = 12  # so at most 4,096 patterns of 90 figures reach the driver


def pattern_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per pattern: ``pattern`` (a bit per missing column), ``n``, ``sums`` and ``products`` of standardised values.

    A missing value counts as zero; products run over column pairs (i, j), i <= j, row by row.
    """
    stats = df.agg(F.struct(*[
        F.struct(F.avg(masks.number(c)).alias("m"), F.stddev_pop(masks.number(c)).alias("s")).alias(f"c{i}")
        for i, c in enumerate(columns)
    ])).scalar()
    scaled = [
        ((masks.number(c) - stats[f"c{i}"]["m"]) / F.when(stats[f"c{i}"]["s"] > 0, stats[f"c{i}"]["s"]).otherwise(1.0)).alias(f"z{i}")
        for i, c in enumerate(columns)
    ]
    z = [F.col(f"z{i}") for i in range(len(columns))]
    bits = sum((F.when(x.isNull(), 1 << i).otherwise(0) for i, x in enumerate(z)), F.lit(0))
    zero = F.lit(0.0)
    return df.select(*scaled).groupBy(bits.alias("pattern")).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.coalesce(F.sum(x), zero) for x in z]).alias("sums"),
        F.array(*[F.coalesce(F.sum(x * y), zero) for i, x in enumerate(z) for y in z[i:]]).alias("products"),
    )


def em_estimate(
    patterns: Sequence[tuple[np.ndarray, int, np.ndarray, np.ndarray]], max_iter: int = 5000, tolerance: float = 1e-11
) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood mean and covariance from patterns (observed columns, rows, sums, products)."""
    p = len(patterns[0][2])
    total = sum(n for _, n, _, _ in patterns)
    mean, cov = np.zeros(p), np.eye(p)
    for _ in range(max_iter):
        first, second = np.zeros(p), np.zeros((p, p))
        for seen, n, sums, products in patterns:
            gone = np.setdiff1d(np.arange(p), seen)
            s, c = sums[seen], products[np.ix_(seen, seen)]
            slope = cov[np.ix_(gone, seen)] @ np.linalg.pinv(cov[np.ix_(seen, seen)])
            base = mean[gone] - slope @ mean[seen]
            first[seen] += s
            first[gone] += n * base + slope @ s
            second[np.ix_(seen, seen)] += c
            across = np.outer(base, s) + slope @ c
            second[np.ix_(gone, seen)] += across
            second[np.ix_(seen, gone)] += across.T
            half = np.outer(base, slope @ s)
            rest = cov[np.ix_(gone, gone)] - slope @ cov[np.ix_(seen, gone)]
            second[np.ix_(gone, gone)] += n * (rest + np.outer(base, base)) + half + half.T + slope @ c @ slope.T
        new_mean = first / total
        new_cov = second / total - np.outer(new_mean, new_mean)
        moved = max(np.abs(new_mean - mean).max(), np.abs(new_cov - cov).max())
        mean, cov = new_mean, new_cov
        if moved < tolerance:
            break
    return mean, cov


def chi_square_tail(x: float, degrees: int) -> float:
    """Probability of a chi-square value above ``x``."""
    a, x = degrees / 2.0, x / 2.0
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * scale)
    # continued fraction
    b, c = x + 1 - a, 1e300
    d = 1 / b
    out = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or 1e-300)
        c = b + step / c or 1e-300
        out *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return out * scale


def missing_at_random(df: DataFrame, columns: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Little's test over numeric columns as one row.

    ``(n_patterns, statistic, degrees, pvalue, at_random)``: ``at_random`` says
    that nothing speaks against values missing completely at random; it and the
    p-value are NULL where there is only one pattern. NULL and NaN are missing;
    rows without any value say nothing. Covariances are maximum-likelihood
    estimates under normality.
    """
    if not 0 < len(columns) <= MOST_COLUMNS:
        raise ValueError(f"the test takes 1 to {MOST_COLUMNS} columns")
    p = len(columns)
    upper = np.triu_indices(p)
    patterns = []
    for row in pattern_sums(df, columns).collect():
        seen = np.array([i for i in range(p) if not row["pattern"] >> i & 1], dtype=int)
        if len(seen):
            products = np.zeros((p, p))
            products[upper] = row["products"]
            products = products + products.T - np.diag(np.diag(products))
            patterns.append((seen, row["n"], np.array(row["sums"]), products))
    patterns.sort(key=lambda x: x[0].tolist())
    statistic, degrees = 0.0, sum(len(seen) for seen, *_ in patterns) - len({i for seen, *_ in patterns for i in seen.tolist()})
    if degrees > 0:
        mean, cov = em_estimate(patterns)
        for seen, n, sums, _ in patterns:
            away = sums[seen] / n - mean[seen]
            statistic += n * float(away @ np.linalg.pinv(cov[np.ix_(seen, seen)]) @ away)
    pvalue = chi_square_tail(statistic, degrees) if degrees > 0 else None
    return df.sparkSession.createDataFrame(
        [(len(patterns), statistic, degrees, pvalue, None if pvalue is None else pvalue >= alpha)],
        "n_patterns int, statistic double, degrees int, pvalue double, at_random boolean",
    )
