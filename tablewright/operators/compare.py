"""Before and after: distribution tests, profiles and strategy comparison."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tablewright.functions import masks, scalars
from tablewright.operators import profile
from tablewright.operators.ordered import running_totals
from tablewright.operators.quality import loss_percent, quality_report
from tablewright.session import cut_lineage

def _equal_sizes_p(reach: int, n: int) -> float:
    """The same for two samples of ``n``: paths that reach ``reach`` steps from the diagonal, by reflection."""
    total, term, k = 0.0, 1.0, 1
    middle = 2 * math.lgamma(n + 1)
    while k * reach <= n and abs(term) > abs(total) * 1e-17:
        term = math.exp(middle - math.lgamma(n - k * reach + 1) - math.lgamma(n + k * reach + 1))
        total += term if k % 2 else -term
        k += 1
    return min(1.0, max(0.0, 2.0 * total))


def _exact_p(d: float, n1: int, n2: int) -> float:
    """Share of monotone lattice paths from (0,0) to (n1,n2) that reach distance ``d``.

    A random path takes n1 + n2 steps. Only the places inside the band around
    the diagonal are followed, about 2 d n1 n2 / (n1 + n2) after each step, each
    with the share of paths that are there and have not left the band; what
    leaves it adds up to the result. Beyond what a double can tell from zero the
    bound 2 exp(-2 d^2 n1 n2 / (n1 + n2)) stands for it.
    """
    if n1 > n2:
        n1, n2 = n2, n1
    common = math.lcm(n1, n2)
    up, right = common // n1, common // n2
    reach = round(d * common)
    if reach <= 0:
        return 1.0
    if n1 == n2:
        return _equal_sizes_p(reach, n1)
    bound = 2.0 * math.exp(-2.0 * d * d * n1 * n2 / (n1 + n2))
    if bound < 1e-15:
        return bound
    steps, both = n1 + n2, up + right
    lo, shares, left = 0, np.ones(1), 0.0
    for t in range(1, steps + 1):
        # from i steps up and t - 1 - i to the right; a step goes up in proportion to those left to go
        to_go = float(steps - t + 1)
        rise = shares * (np.arange(n1 - lo, n1 - lo - len(shares), -1) / to_go)
        moved = np.zeros(len(shares) + 1)
        moved[1:] = rise
        moved[:-1] += shares - rise
        # inside: |i * up - (t - i) * right| < reach
        first, last = max(0, t - n2, (t * right - reach) // both + 1), min(n1, t, (t * right + reach - 1) // both)
        if first > last:
            return 1.0
        begin, end = first - lo, min(len(moved), last - lo + 1)
        left += moved[:begin].sum() + moved[end:].sum()
        lo, shares = first, moved[begin:end]
    return min(1.0, max(0.0, float(left)))


def _asymptotic_p(d: float, n1: int, n2: int) -> float:
    x = d * math.sqrt(n1 * n2 / (n1 + n2))
    if x < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * x * x) for k in range(1, 101))
    return min(1.0, max(0.0, 2.0 * total))


def ks_p_value(statistic: float, n1: int, n2: int, method: str = "asymptotic") -> float:
    """Two-sided p-value from the statistic and the sample sizes alone.

    ``method`` is asymptotic (the limit distribution's series) or exact (lattice
    paths over a band, work in proportion to ``statistic * n1 * n2``, and to
    ``1 / statistic`` for equal sizes); the sizes never choose it.
    """
    return {"exact": _exact_p, "asymptotic": _asymptotic_p}[method](statistic, n1, n2)


@F.pandas_udf(T.DoubleType())
def _exact_p_values(statistic: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([_exact_p(d, int(a), int(b)) for d, a, b in zip(statistic, n1, n2)])


def _asymptotic_p_values(statistic: Column, n1: Column, n2: Column) -> Column:
    """The series of the limit distribution as one expression."""
    x = statistic * F.sqrt(n1.cast("double") * n2 / (n1 + n2))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x),
    )
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * terms)))


def ks_two_sample(
    first: DataFrame, second: DataFrame, value: Column, alpha: float = 0.05, method: str = "asymptotic"
) -> DataFrame:
    """Kolmogorov-Smirnov statistic and p-value for ``value`` in two tables.

    Both samples collapse to counts per value before the running sums; the
    p-value is arithmetic on the three figures of the one result row, by
    ``method`` as in ``ks_p_value``.
    """
    if method not in ("asymptotic", "exact"):
        raise ValueError(f"unknown method {method!r}")

    def counts(df: DataFrame, a: int, b: int) -> DataFrame:
        return df.select(masks.number(value).alias("v")).where("v IS NOT NULL").select(
            "v", F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))

    per_value = counts(first, 1, 0).unionByName(counts(second, 0, 1)).groupBy("v").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")
    )
    ranked = running_totals(per_value, "v", ["a", "b"])
    gap = F.abs(F.col("a_cum") / F.col("a_total") - F.col("b_cum") / F.col("b_total"))
    figures = ranked.agg(
        F.max(gap).alias("statistic"), F.max("a_total").alias("n1"), F.max("b_total").alias("n2")
    )
    if method == "exact":
        p = _exact_p_values("statistic", "n1", "n2")
    else:
        p = _asymptotic_p_values(F.col("statistic"), F.col("n1"), F.col("n2"))
    return figures.withColumn("pvalue", p).withColumn(
        "differs", F.col("pvalue") < alpha
    )


def profile_change(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, deviation and range of numeric columns before and after."""
    def named(df: DataFrame, tag: str) -> DataFrame:
        p = profile.numeric_profile(df, columns)
        return p.withColumnsRenamed({c: f"{c}_{tag}" for c in p.columns if c != "column"})

    return named(before, "before").join(named(after, "after"), "column").withColumn(
        "mean_shift", F.col("mean_after") - F.col("mean_before")
    )


def correlation_change(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    a = profile.correlation_matrix(before, columns).withColumnRenamed("r", "r_before")
    b = profile.correlation_matrix(after, columns).withColumnRenamed("r", "r_after")
    return a.join(b, ["x", "y"])


def _dataset_metrics(name: str, df: DataFrame, base: DataFrame, label: str | None, score: Column | None):
    numeric = [c for c in profile.numeric_columns(df) if c != label]
    gaps = profile.missing_profile(df).agg(
        F.struct(F.sum("n_missing").cast("double").alias("n"), F.avg("pct_missing").alias("pct"))
    ).scalar()
    copies = profile.full_duplicates(df).select(F.col("n_duplicates").cast("double")).scalar()
    n0 = base.agg(F.count(F.lit(1))).scalar()
    metrics = [
        ("rows", F.col("n").cast("double")),
        ("cols", F.lit(float(len(df.columns)))),
        ("missing", gaps["n"]),
        ("missing_pct", gaps["pct"]),
        ("duplicates", copies),
        ("loss_pct", loss_percent(n0, F.col("n"))),
    ]
    if numeric:
        out = profile.outlier_counts(df, numeric).agg(
            F.struct(F.sum("n_iqr").cast("double").alias("i"), F.sum("n_zscore").cast("double").alias("z"))
        ).scalar()
        metrics += [("outliers_iqr", out["i"]), ("outliers_zscore", out["z"])]
    if label:
        metrics.append(("imbalance_ratio", profile.imbalance(df, label).select("ratio").scalar()))
    if score is not None:
        metrics.append(("quality_score", score))
    cells = [F.struct(F.lit(m).alias("metric"), F.lit(name).alias("dataset"), v.alias("value"))
             for m, v in metrics]
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(*cells)))


def comparison_table(
    datasets: Mapping[str, DataFrame], base: str, label: str | None = None,
    roles: Mapping[str, str] | None = None, wide: bool = False,
) -> DataFrame:
    """Size, gaps, duplicates, outliers, imbalance, loss and score of each dataset.

    Long form ``(metric, dataset, value)``, or one column per dataset. ``roles``
    names the text, key, group and target columns for the score.
    """
    columns = datasets[base].columns
    parts = []
    for name, df in datasets.items():
        # stored once: every figure reads its columns of the stored table, not the steps before it
        table = cut_lineage(df.select(*[c for c in columns if c in df.columns]))
        score = quality_report(table, **roles).select("quality_score").scalar() if roles else None
        parts.append(_dataset_metrics(name, table, datasets[base], label, score))
    long = reduce(DataFrame.unionByName, parts)
    if not wide:
        return long
    return long.groupBy("metric").pivot("dataset", list(datasets)).agg(F.first("value"))


def strategy_comparison(
    original: DataFrame, strategies: Mapping[str, DataFrame], text: str, key: str, group: str,
    target: str,
) -> DataFrame:
    """Score, loss and length test per strategy; the winner has the best score, then the least loss."""
    length = F.length(text)
    n0 = original.agg(F.count(F.lit(1))).scalar()
    parts, stored = [], {}
    for name, df in {"original": original, **strategies}.items():
        table = stored[name] = cut_lineage(df.select(*original.columns))
        report = quality_report(table, text, key, group, target)
        row = report.select(
            F.lit(name).alias("strategy"), F.col("n_rows").alias("rows"),
            F.bround(loss_percent(n0, F.col("n_rows")), 2).alias("loss_pct"), "quality_score",
        )
        if name == "original":
            row = row.select("*", F.lit(None).cast("double").alias("ks_statistic"),
                             F.lit(None).cast("double").alias("ks_pvalue"))
        else:
            test = ks_two_sample(stored["original"], table, length).select(F.struct("statistic", "pvalue")).scalar()
            row = row.select("*", F.bround(test["statistic"], 4).alias("ks_statistic"),
                             F.bround(test["pvalue"], 4).alias("ks_pvalue"))
        parts.append(row)
    table = reduce(DataFrame.unionByName, parts)
    candidates = table.where("strategy <> 'original'")
    best = candidates.agg(
        F.min(F.struct((-F.col("quality_score")).alias("s"), F.col("loss_pct"), F.col("strategy")))
        .alias("b")
    ).select("b.strategy").scalar()
    return table.withColumn("recommended", F.col("strategy") == best)


def length_summary(df: DataFrame, text: str, bins: int = 40) -> DataFrame:
    """Histogram of text lengths."""
    return profile.histogram(df.select(F.length(text).alias("len")), "len", bins)


def score_band(score: Column | str) -> Column:
    """Good from 80, fair from 60, else poor."""
    return scalars.value_band(score, [60.0, 80.0], ["poor", "fair", "good"])
