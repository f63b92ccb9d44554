"""Labels: classifiers, keyword rules, distributions, review samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions import scalars, text as tx
from tablewright.functions.labels import confidence_status, sentiment_to_label
from tablewright.operators.ordered import exact_quantiles
from tablewright.operators.sampling import largest_remainder, sample_quota
from tablewright.operators.skew import row_hash

# Substrings counted for each side by the keyword annotator.
LIKED_KEYWORDS = [
    "нравится", "понравился", "понравилась", "обожаю", "люблю", "отличный",
    "отличная", "шедевр", "рекомендую", "куплю", "прекрасный", "прекрасно",
    "великолепный", "восхитительный", "обожать", "моя любовь", "буду брать",
    "стал фаворитом", "в коллекцию", "мой любимый", "замечательный",
    "потрясающий", "потрясающе", "лучший", "лучшее", "блестящий", "кайф",
    "кайфую", "офигенный", "топ", "супер", "классный", "шикарный",
]
NOT_LIKED_KEYWORDS = [
    "не понравился", "не понравилась", "не нравится", "отвратительный",
    "отвратительно", "ужасный", "ужасно", "продал", "продала", "вернул",
    "вернула", "невыносимо", "невыносимый", "не куплю", "не возьму",
    "не рекомендую", "разочарован", "разочарована", "пожалел", "пожалела",
    "не для меня", "не моё", "мерзко", "мерзкий", "воняет", "вонь",
    "тошнит", "тошнота", "плохо", "кошмар", "кошмарный", "дикость",
]

Classifier = Callable[[list[str]], list[Mapping]]


def keyword_label(
    text: Column | str,
    liked: Sequence[str] = LIKED_KEYWORDS,
    disliked: Sequence[str] = NOT_LIKED_KEYWORDS,
    names: tuple[str, str, str] = ("liked", "mixed", "not_liked"),
) -> Column:
    """Label by which list has more substrings in the text; a tie is mixed."""
    plus, minus = tx.keyword_hits(text, liked), tx.keyword_hits(text, disliked)
    return F.when(plus > minus, names[0]).when(minus > plus, names[2]).otherwise(names[1])


def rule_label(text: Column | str, rules: Sequence[tuple[str, str]], fallback: str) -> Column:
    """Label of the rules ``(label, pattern)`` matching most often; ties and none give the fallback."""
    column = F.lower(F.col(text) if isinstance(text, str) else text)
    labels = list(dict.fromkeys(label for label, _ in rules))
    scores = [
        sum((F.coalesce(column.rlike(p), F.lit(False)).cast("int") for l, p in rules if l == label), F.lit(0))
        for label in labels
    ]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    winners = sum(((s == best).cast("int") for s in scores), F.lit(0))
    picked = F.lit(fallback)
    for label, score in zip(labels, scores):
        picked = F.when((best > 0) & (winners == 1) & (score == best), label).otherwise(picked)
    return picked


def classify(
    df: DataFrame, make_classifier: Callable[[], Classifier], text: str, batch_size: int = 32
) -> Column:
    """Struct column ``(sentiment, score)`` from a pluggable classifier.

    ``make_classifier`` is called once per Python worker stream. Only the text
    column crosses to Python, in Arrow batches cut into model batches.
    """

    @F.pandas_udf("sentiment string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make_classifier()
        for texts in batches:
            values = texts.tolist()
            found = []
            for start in range(0, len(values), batch_size):
                found.extend(model(values[start: start + batch_size]))
            yield pd.DataFrame(
                {"sentiment": [str(p["label"]).lower() for p in found],
                 "score": [float(p["score"]) for p in found]}
            )

    return predict(F.col(text))


def auto_label(
    df: DataFrame, make_classifier: Callable[[], Classifier], text: str, batch_size: int = 32
) -> DataFrame:
    """Add ``sentiment_raw``, ``label`` and ``confidence`` (four places)."""
    scored = df.withColumn("_p", classify(df, make_classifier, text, batch_size))
    return scored.select(
        *df.columns,
        F.col("_p.sentiment").alias("sentiment_raw"),
        sentiment_to_label("_p.sentiment").alias("label"),
        F.bround("_p.score", 4).alias("confidence"),
    )


def with_label_record(
    labeled: DataFrame, method: str, raw: Column | None = None, threshold: float = 0.5
) -> DataFrame:
    """Add method, raw output, time and status to labeled rows; other columns stay as they are."""
    output = raw if raw is not None else F.to_json(F.struct("label", "confidence"))
    return labeled.withColumns(
        {
            "method": F.lit(method),
            "raw_output": output,
            "labeled_at": F.current_timestamp(),
            "status": confidence_status("confidence", threshold),
        }
    )


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Count and percentage per label."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", scalars.percent(F.col("count"), total))


def quality_summary(
    df: DataFrame, label: str = "label", confidence: str = "confidence", threshold: float = 0.5
) -> DataFrame:
    """One row: total, mean confidence, uncertain rows and the nested distribution."""
    spread = label_distribution(df, label).agg(
        # one entry per label
        F.array_sort(F.collect_list(F.struct(label, "count", F.bround("pct", 1).alias("pct"))))
    )
    uncertain = F.count_if(F.col(confidence) < threshold)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(label).alias("labeled"),
        F.bround(F.avg(confidence), 4).alias("mean_confidence"),
        uncertain.alias("uncertain_count"),
        F.bround(scalars.percent(uncertain, F.count(F.lit(1))), 1).alias("uncertain_pct"),
    ).withColumn("distribution", spread.scalar())


def distribution_checks(
    df: DataFrame, label: str, expected: Mapping[str, float] | None = None, rare_below: float = 5.0
) -> DataFrame:
    """Percentage, rare-class warning and difference to an expected percentage per label."""
    shares = label_distribution(df, label).withColumn("rare", F.col("pct") < rare_below)
    if expected is None:
        return shares
    wanted = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])
    return shares.withColumn(
        "difference", F.col("pct") - F.coalesce(F.try_element_at(wanted, F.col(label)), F.lit(0.0))
    )


def distribution_entropy(df: DataFrame, label: str) -> DataFrame:
    """Entropy of the label distribution in nats, and its share of the maximum."""
    p = F.col("pct") / 100.0
    return label_distribution(df, label).agg(
        F.sum(-p * F.ln(p)).alias("entropy"), F.count(F.lit(1)).alias("n_labels")
    ).withColumn("evenness", F.try_divide("entropy", F.ln("n_labels")))


def confidence_stats(
    df: DataFrame, label: str = "label", confidence: str = "confidence",
    low: float = 0.5, high: float = 0.9,
) -> DataFrame:
    """Mean, deviation, median and shares of low and high confidence per label."""
    known = df.where(F.col(label).isNotNull() & F.col(confidence).isNotNull())
    n = F.count(F.lit(1))
    stats = known.groupBy(label).agg(
        n.alias("n"),
        F.avg(confidence).alias("mean"),
        F.stddev_samp(confidence).alias("std"),
        scalars.percent(F.count_if(F.col(confidence) < low), n).alias("pct_low"),
        scalars.percent(F.count_if(F.col(confidence) > high), n).alias("pct_high"),
    )
    return stats.join(exact_quantiles(known, confidence, {"median": 0.5}, [label]), label)


def uncertain_rows(df: DataFrame, confidence: str = "confidence", threshold: float = 0.5) -> DataFrame:
    return df.where(F.col(confidence) < threshold)


def confident_rows(df: DataFrame, confidence: str = "confidence", above: float = 0.9) -> DataFrame:
    return df.where(F.col(confidence) > above)


def border_rows(
    df: DataFrame, confidence: str = "confidence", low: float = 0.3, high: float = 0.6
) -> DataFrame:
    return df.where(F.col(confidence).between(low, high))


def export_subset(
    df: DataFrame, mode: str, confidence: str = "confidence", low: float = 0.5, high: float = 0.9
) -> DataFrame:
    """``all``, ``uncertain`` or ``confident`` rows."""
    if mode == "all":
        return df
    if mode == "uncertain":
        return uncertain_rows(df, confidence, low)
    if mode == "confident":
        return confident_rows(df, confidence, high)
    raise ValueError(f"unknown export mode {mode!r}")


def top_confident(
    df: DataFrame, row_id: str, n: int = 2, label: str = "label", confidence: str = "confidence"
) -> DataFrame:
    """The ``n`` most confident rows of each label; map tasks keep ``n`` rows per label."""
    order = Window.partitionBy(label).orderBy(F.desc(confidence), F.asc(row_id))
    return df.where(F.col(label).isNotNull()).withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= n
    )


def least_confident(
    df: DataFrame, row_id: str, n: int = 10, confidence: str = "confidence"
) -> DataFrame:
    return df.where(F.col(confidence).isNotNull()).orderBy(F.asc(confidence), F.asc(row_id)).limit(n)


def guideline_examples(
    df: DataFrame, row_id: str, per_class: int = 3, border: int = 5,
    label: str = "label", confidence: str = "confidence",
) -> DataFrame:
    """Clear examples per class and the least confident rows overall."""
    clear = top_confident(df, row_id, per_class, label, confidence).drop("place")
    edge = least_confident(df, row_id, border, confidence)
    return clear.withColumn("kind", F.lit("example")).unionByName(edge.withColumn("kind", F.lit("border")))


def guideline_summary(examples: DataFrame, label: str = "label") -> DataFrame:
    """Examples per class, with the date of the summary."""
    return examples.groupBy(label).agg(
        F.count_if(F.col("kind") == "example").alias("n_examples"),
        F.count_if(F.col("kind") == "border").alias("n_border"),
    ).withColumn("created", F.current_date())


def ambiguous_rows(df: DataFrame, probabilities: str, gap: float = 0.1) -> DataFrame:
    """Rows whose two best classes are closer than ``gap``."""
    return df.withColumn("margin", scalars.margin(probabilities)).where(F.col("margin") < gap)


def review_sample(
    df: DataFrame, row_id: str, label: str, second: str, confidence: str,
    size: int = 50, low: int = 10, per_pair: int = 2, seed: int = 42,
) -> DataFrame:
    """Rows for manual review, each once, with an empty ``human_label``.

    A sample in proportion to the classes, the least confident rows, and some
    rows of every kind of disagreement.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    quotas = largest_remainder(counts, label, "_n", F.lit(size), "take")
    by_class = sample_quota(df, [row_id], label, quotas, "take", seed).select(row_id)
    lowest = least_confident(df, row_id, low, confidence).select(row_id)
    order = Window.partitionBy(label, second).orderBy(row_hash([row_id], seed), row_id)
    pairs = (
        df.where(F.col(label) != F.col(second))
        .select(row_id, label, second)
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= per_pair)
        .select(row_id)
    )
    chosen = by_class.unionByName(lowest).unionByName(pairs).distinct()
    return df.join(chosen, row_id, "left_semi").withColumn("human_label", F.lit(None).cast("string"))


# File extensions and the kind of data they hold.
MODALITIES = {
    "csv": "text", "txt": "text", "json": "text", "parquet": "text",
    "wav": "audio", "mp3": "audio", "flac": "audio",
    "jpg": "image", "png": "image", "webp": "image",
}


def modality_of(path: Column | str) -> Column:
    """Kind of data by file extension, ``unknown`` otherwise."""
    column = F.col(path) if isinstance(path, str) else path
    kinds = F.create_map(*[F.lit(x) for pair in MODALITIES.items() for x in pair])
    extension = F.lower(F.regexp_extract(column, r"\.([A-Za-z0-9]+)$", 1))
    return F.coalesce(F.try_element_at(kinds, extension), F.lit("unknown"))


def inspect_paths(df: DataFrame, path: str) -> DataFrame:
    """Records per kind of data."""
    return df.groupBy(modality_of(path).alias("modality")).agg(F.count(F.lit(1)).alias("n"))


def pilot_rows(df: DataFrame, row_id: str, size: int = 100, seed: int = 42) -> DataFrame:
    """The first ``size`` rows by seeded hash; whether a pilot is wanted is the caller's decision."""
    return df.orderBy(row_hash([row_id], seed), row_id).limit(size)
