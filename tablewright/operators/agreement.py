"""Agreement between two labelings: everything follows from counts per label pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.labels import agreement_band, merge_to_binary
from tablewright.operators.labeling import quality_summary


def pair_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows per pair of labels; rows without both labels are left out."""
    return (
        df.where(F.col(first).isNotNull() & F.col(second).isNotNull())
        .groupBy(F.col(first).alias("a"), F.col(second).alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _grid(df: DataFrame, labels: Sequence) -> DataFrame:
    names = F.array(*[F.lit(x) for x in labels])
    return df.sparkSession.range(1).select(F.explode(names).alias("a")).select(
        "a", F.explode(names).alias("b")
    )


def confusion_matrix(
    df: DataFrame, first: str, second: str, labels: Sequence, wide: bool = False
) -> DataFrame:
    """Counts for every pair of the given labels, 0 where none occurred."""
    counts = pair_counts(df, first, second)
    filled = _grid(df, labels).join(counts, ["a", "b"], "left").na.fill(0, ["n"])
    if not wide:
        return filled
    return filled.groupBy("a").pivot("b", list(labels)).agg(F.first("n"))


def _margins(counts: DataFrame) -> DataFrame:
    """Per label: rows the first gave it, rows the second gave it, rows both did."""
    sides = F.array(
        F.struct(F.col("a").alias("label"), F.col("n").alias("x"), F.lit(0).cast("bigint").alias("y"),
                 F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0).alias("z")),
        F.struct(F.col("b").alias("label"), F.lit(0).cast("bigint").alias("x"), F.col("n").alias("y"),
                 F.lit(0).cast("bigint").alias("z")),
    )
    return counts.select(F.inline(sides)).groupBy("label").agg(
        F.sum("x").alias("n_first"), F.sum("y").alias("n_second"), F.sum("z").alias("n_both")
    )


def _kappa(n: Column, agreed: Column, crossed: Column) -> Column:
    """One minus observed over expected disagreement."""
    observed = (n - agreed).cast("double")
    expected = n.cast("double") - crossed / n.cast("double")
    return F.lit(1.0) - F.try_divide(observed, expected)


def agreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """One row: rows, agreements, disagreements, percent agreement, Cohen's kappa and its band."""
    margins = _margins(pair_counts(df, first, second))
    totals = margins.agg(
        F.coalesce(F.sum("n_first"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("n_both"), F.lit(0)).alias("agreed"),
        F.sum(F.col("n_first").cast("double") * F.col("n_second").cast("double")).alias("_c"),
    )
    kappa = F.when(F.col("n") > 0, _kappa(F.col("n"), F.col("agreed"), F.col("_c")))
    return totals.select(
        "n",
        "agreed",
        (F.col("n") - F.col("agreed")).alias("disagreed"),
        (F.try_divide(F.col("agreed").cast("double"), F.col("n").cast("double")) * 100.0)
        .alias("agreement_pct"),
        kappa.alias("kappa"),
    ).withColumn("band", agreement_band("kappa"))


def binary_agreement(df: DataFrame, first: str, second: str, positive: str) -> DataFrame:
    """The same after merging every other label into one class."""
    rest = f"not_{positive}"
    merged = df.select(
        merge_to_binary(first, positive, rest).alias("a"), merge_to_binary(second, positive, rest).alias("b")
    )
    return agreement(merged, "a", "b")


def fit_for_training(agreed: DataFrame, minimum: float = 0.6) -> DataFrame:
    """Quality gate on the kappa of an agreement row."""
    return agreed.withColumn("fit", F.coalesce(F.col("kappa") >= minimum, F.lit(False)))


def labeling_report(
    df: DataFrame, label: str = "label", confidence: str = "confidence", second: str | None = None,
    threshold: float = 0.5, minimum: float = 0.6, pairs: int = 10,
) -> DataFrame:
    """Everything about one labeling in one nested row.

    Columns: ``summary`` (rows, mean confidence, uncertain rows, distribution)
    and ``fit``. With a ``second`` labeling also ``agreement`` (kappa, percent,
    band) and the most frequent ``disagreements``, and ``fit`` is the gate on
    kappa; without one both are NULL and the mean confidence is gated.
    """
    summary = quality_summary(df, label, confidence, threshold)
    row = summary.select(F.struct(*summary.columns).alias("summary"))
    if second is None:
        return row.select(
            "summary", F.lit(None).cast("struct<kappa:double>").alias("agreement"),
            F.lit(None).cast("array<struct<a:string,b:string,n:bigint>>").alias("disagreements"),
            F.coalesce(F.col("summary.mean_confidence") >= minimum, F.lit(False)).alias("fit"),
        )
    agreed = fit_for_training(agreement(df, label, second), minimum)
    # at most ``pairs`` entries
    worst = confusion_pairs(df, label, second, pairs).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("_n"), "a", "b", "n"))).alias("p")
    ).select(F.transform("p", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["n"].alias("n"))))
    figures = agreed.select(F.struct(*agreed.columns)).scalar()
    return row.select(
        "summary", figures.alias("agreement"), worst.scalar().alias("disagreements"), figures["fit"].alias("fit")
    )


def disagreements(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows on which the labelings differ; a missing label differs from any present one."""
    return df.where(~F.col(first).eqNullSafe(F.col(second)))


def confusion_pairs(df: DataFrame, first: str, second: str, k: int = 10) -> DataFrame:
    """The most frequent kinds of disagreement."""
    return pair_counts(df, first, second).where("a <> b").orderBy(F.desc("n"), "a", "b").limit(k)


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support of every label either side used."""
    def ratio(part: str, whole: str) -> Column:
        return F.coalesce(
            F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0)
        )

    f1 = F.coalesce(
        F.try_divide(F.col("n_both") * F.lit(2.0), (F.col("n_first") + F.col("n_second")).cast("double")),
        F.lit(0.0),
    )
    return _margins(pair_counts(df, actual, predicted)).select(
        "label",
        ratio("n_both", "n_second").alias("precision"),
        ratio("n_both", "n_first").alias("recall"),
        f1.alias("f1"),
        F.col("n_first").alias("support"),
        "n_both",
    )


def report_summary(report: DataFrame) -> DataFrame:
    """Accuracy, and macro and support-weighted means of a class report, as one row."""
    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / F.sum("support")

    return report.agg(
        (F.sum("n_both").cast("double") / F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(f"{c}_macro") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"{c}_weighted") for c in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
    )


def evaluate(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy and macro F1 rounded to four places."""
    return report_summary(class_report(df, actual, predicted)).select(
        F.bround("accuracy", 4).alias("accuracy"), F.bround("f1_macro", 4).alias("f1")
    )


def label_shares_side_by_side(df: DataFrame, first: str, second: str) -> DataFrame:
    """How often each labeling used each label."""
    return _margins(pair_counts(df, first, second)).select("label", "n_first", "n_second")
