"""Quality score of a text table and a generic issue scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions import masks, scalars
from tablewright.operators import profile
from tablewright.operators.skew import key_counts

# Issue name, severity, penalty per percent, penalty cap.
ISSUE_RULES = [
    ("encoding_corruption", "critical", 25.0, 30.0),
    ("short_review", "medium", 15.0, 15.0),
    ("duplicate_reviewer", "high", 10.0, 15.0),
    ("perfume_level_rating", "high", None, 10.0),
    ("missing_values", "high", 20.0, 20.0),
]
ISSUE_TEXT = {
    "encoding_corruption": "text holds runs of replacement characters",
    "short_review": "text is shorter than the minimum length",
    "duplicate_reviewer": "the author key occurs on more than one row",
    "perfume_level_rating": "the target is constant within every group",
    "missing_values": "cells without a value",
}


def quality_facts(
    df: DataFrame, text: str, key: str, group: str, target: str, min_len: int = 50, run: int = 3
) -> DataFrame:
    """One row with every count behind the score.

    The texts are scanned once; keys and groups come from narrow
    aggregations that combine before their shuffle.
    """
    damaged = masks.damaged_text(text, run)
    short_only = masks.short_text(text, min_len) & ~damaged
    cells = sum(
        (masks.missing(f.name, f.dataType).cast("bigint") for f in df.schema), F.lit(0).cast("bigint")
    )
    duplicates = key_counts(df, [key]).where("n > 1").agg(F.sum("n"))
    leak = profile.group_constant(df, group, target).select(F.struct("n_groups", "is_constant"))
    n_cols = len(df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(damaged).alias("n_damaged"),
        F.count_if(short_only).alias("n_short"),
        F.coalesce(F.sum(cells), F.lit(0)).alias("n_missing"),
    ).select(
        "*",
        F.coalesce(duplicates.scalar(), F.lit(0)).alias("n_duplicate"),
        leak.scalar().alias("_leak"),
        F.lit(n_cols).alias("n_cols"),
    ).select("*", F.col("_leak")["n_groups"].alias("n_groups"),
             F.col("_leak")["is_constant"].alias("is_constant")).drop("_leak")


def _issues() -> Column:
    """All five issues in order as unrounded structs, absent ones with count 0."""
    n = F.col("n_rows")
    counts = {
        "encoding_corruption": F.col("n_damaged"),
        "short_review": F.col("n_short"),
        "duplicate_reviewer": F.col("n_duplicate"),
        "perfume_level_rating": F.when(F.col("is_constant"), F.col("n_groups")).otherwise(0),
        "missing_values": F.col("n_missing"),
    }
    shares = {name: scalars.percent(count, n) for name, count in counts.items()}
    shares["perfume_level_rating"] = F.lit(100.0)
    shares["missing_values"] = scalars.percent(F.col("n_missing"), n * F.col("n_cols"))
    found = []
    for place, (name, severity, rate, cap) in enumerate(ISSUE_RULES, start=1):
        cost = F.lit(cap) if rate is None else F.least(shares[name] * F.lit(rate), F.lit(cap))
        present = F.col("is_constant") if rate is None else counts[name] > 0
        found.append(
            F.struct(
                F.lit(place).alias("place"),
                F.lit(name).alias("type"),
                F.lit(severity).alias("severity"),
                counts[name].cast("bigint").alias("count"),
                shares[name].alias("pct"),
                F.lit(ISSUE_TEXT[name]).alias("description"),
                cost.alias("penalty"),
                present.alias("present"),
            )
        )
    return F.filter(F.array(*found), lambda issue: issue["present"])


def quality_issues(
    df: DataFrame, text: str, key: str, group: str, target: str, min_len: int = 50, run: int = 3
) -> DataFrame:
    """One row per issue found, figures unrounded."""
    facts = quality_facts(df, text, key, group, target, min_len, run)
    return facts.select(F.inline(_issues())).drop("present")


def quality_report(
    df: DataFrame, text: str, key: str, group: str, target: str, min_len: int = 50, run: int = 3
) -> DataFrame:
    """One nested row: score from 0 to 100, shape, total penalty and the issue list."""
    facts = quality_facts(df, text, key, group, target, min_len, run)
    scored = facts.withColumn("_found", _issues()).withColumn(
        "_total", F.aggregate("_found", F.lit(0.0), lambda total, issue: total + issue["penalty"])
    )
    rounded = F.transform(
        "_found",
        lambda issue: F.struct(
            issue["type"].alias("type"),
            issue["severity"].alias("severity"),
            issue["count"].alias("count"),
            F.bround(issue["pct"], 2).alias("pct"),
            issue["description"].alias("description"),
            F.bround(issue["penalty"], 1).alias("penalty"),
        ),
    )
    return scored.select(
        F.greatest(F.lit(0.0), F.bround(F.lit(100.0) - F.col("_total"), 1)).alias("quality_score"),
        "n_rows",
        "n_cols",
        F.bround("_total", 1).alias("total_penalty"),
        rounded.alias("issues"),
    )


def strategy_metrics(
    original: DataFrame, cleaned: DataFrame, text: str, key: str, group: str, target: str,
    score_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows before and after, loss, score and remaining issues of one cleaning strategy.

    Flag columns added by the strategy are left out of the score by default.
    """
    columns = list(score_columns or [c for c in cleaned.columns if c in original.columns])
    report = quality_report(cleaned.select(*columns), text, key, group, target)
    before = original.agg(F.count(F.lit(1))).scalar()
    return report.select(
        before.alias("rows_before"),
        F.col("n_rows").alias("rows_after"),
        F.bround(loss_percent(before, F.col("n_rows")), 2).alias("loss_pct"),
        "quality_score",
        F.col("issues").alias("issues_remaining"),
    )


def loss_percent(before: Column, after: Column) -> Column:
    return (F.lit(1.0) - F.try_divide(after.cast("double"), before.cast("double"))) * 100.0


def data_loss(original: DataFrame, cleaned: DataFrame, warn_above: float = 30.0) -> DataFrame:
    """Share of rows a strategy removed, and whether that is above the warning limit."""
    before = original.agg(F.count(F.lit(1))).scalar()
    return cleaned.agg(F.count(F.lit(1)).alias("rows_after")).select(
        before.alias("rows_before"),
        "rows_after",
        loss_percent(before, F.col("rows_after")).alias("loss_pct"),
        (loss_percent(before, F.col("rows_after")) > warn_above).alias("too_much"),
    )


def decision_log(df: DataFrame, text: str, min_len: int = 50, run: int = 3) -> DataFrame:
    """Rows dropped by each cleaning decision; a row counts for the first that hits it."""
    damaged = masks.damaged_text(text, run)
    short = masks.short_text(text, min_len)
    counted = df.agg(
        F.count_if(damaged).alias("d"),
        F.count_if(short & ~damaged).alias("s"),
        F.count_if(short & damaged).alias("b"),
    )
    rows = [
        F.struct(F.lit(issue).alias("issue"), F.lit(action).alias("action"), F.col(c).alias("rows"))
        for issue, action, c in [
            ("encoding_corruption", "drop", "d"),
            ("short_review", "drop", "s"),
            ("encoding_and_short", "overlap", "b"),
        ]
    ]
    return counted.select(F.inline(F.array(*rows)))


def fix_report(
    original: DataFrame, strategies: Mapping[str, DataFrame], text: str, key: str, group: str,
    target: str, min_len: int = 50,
) -> DataFrame:
    """One nested row: original shape, cleaning decisions, and each strategy's rows, loss and score."""
    decisions = decision_log(original, text, min_len).where("action = 'drop'").agg(
        # one entry per decision
        F.array_sort(F.collect_list(F.struct("issue", "action", F.col("rows").alias("rows_dropped"))))
    )
    entries = []
    for name, cleaned in strategies.items():
        metrics = strategy_metrics(original, cleaned, text, key, group, target).select(
            F.struct(
                F.lit(name).alias("name"), F.col("rows_after").alias("rows"), "loss_pct", "quality_score"
            )
        )
        entries.append(metrics.scalar())
    return original.agg(F.count(F.lit(1)).alias("_n")).select(
        F.array(F.col("_n"), F.lit(len(original.columns)).cast("bigint")).alias("original_shape"),
        decisions.scalar().alias("decisions"),
        F.array(*entries).alias("strategies"),
    )


# Our choice: points taken off per issue of each severity in the generic scan.
SEVERITY_POINTS = {"high": 10.0, "medium": 5.0, "low": 2.0}


def detect_all(df: DataFrame, target: str | None = None) -> DataFrame:
    """Missing values, duplicates, outliers by both rules and class imbalance of any table.

    Long form ``(type, severity, column, count, pct)``; only issues that occur.
    """
    n = df.agg(F.count(F.lit(1))).scalar()
    shape = ["type", "severity", "column", "count", "pct"]
    gaps = profile.missing_profile(df).select(
        F.lit("missing").alias("type"), "severity", "column",
        F.col("n_missing").alias("count"), F.col("pct_missing").alias("pct"),
    )
    copies = profile.full_duplicates(df).select(
        F.lit("duplicates").alias("type"), "severity", F.lit(None).cast("string").alias("column"),
        F.col("n_duplicates").alias("count"), F.col("pct_duplicates").alias("pct"),
    )
    parts = [gaps, copies]
    numeric = [c for c in profile.numeric_columns(df) if c != target]
    if numeric:
        counted = profile.outlier_counts(df, numeric)
        for rule in ("iqr", "zscore"):
            pct = scalars.percent(F.col(f"n_{rule}"), n)
            parts.append(
                counted.select(
                    F.lit(f"outliers_{rule}").alias("type"),
                    scalars.exceeds_band(pct, 1.0, 5.0).alias("severity"),
                    "column", F.col(f"n_{rule}").alias("count"), pct.alias("pct"),
                )
            )
    if target:
        parts.append(
            profile.imbalance(df, target).select(
                F.lit("imbalance").alias("type"), "severity", F.lit(target).alias("column"),
                F.col("majority").alias("count"), F.col("ratio").alias("pct"),
            ).where("pct > 1")
        )
    found = parts[0].select(*shape)
    for part in parts[1:]:
        found = found.unionByName(part.select(*shape))
    return found.where("count > 0")


def scan_score(issues: DataFrame) -> DataFrame:
    """Score of a generic scan: 100 minus the points of each issue, not below 0."""
    points = F.lit(0.0)
    for severity, cost in SEVERITY_POINTS.items():
        points = points + F.when(F.col("severity") == severity, cost).otherwise(0.0)
    return issues.agg(
        F.count(F.lit(1)).alias("n_issues"),
        F.greatest(F.lit(0.0), F.lit(100.0) - F.coalesce(F.sum(points), F.lit(0.0))).alias("score"),
    )
