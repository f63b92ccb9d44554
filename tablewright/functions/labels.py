"""Label vocabularies and their mappings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Sentiment names of the classifier and the labels they stand for.
SENTIMENT_LABELS = {
    "positive": "liked",
    "neutral": "mixed",
    "negative": "not_liked",
}
FALLBACK_LABEL = "mixed"
POSITIVE_LABEL = "liked"
NEGATIVE_LABEL = "not_liked"

# Upper bounds of the agreement bands and their names.
AGREEMENT_BANDS = [
    (0.0, "Poor (worse than chance)"),
    (0.20, "Slight"),
    (0.40, "Fair"),
    (0.60, "Moderate"),
    (0.80, "Substantial"),
]
TOP_AGREEMENT_BAND = "Almost perfect"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(pairs: Mapping[str, str], key: Column) -> Column:
    entries = [F.lit(x) for pair in pairs.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def sentiment_to_label(
    sentiment: Column | str,
    mapping: Mapping[str, str] = SENTIMENT_LABELS,
    fallback: str = FALLBACK_LABEL,
) -> Column:
    """Label for a sentiment name in any case; unknown names get the fallback."""
    return F.coalesce(_lookup(mapping, F.lower(_col(sentiment))), F.lit(fallback))


def label_to_sentiment(label: Column | str, mapping: Mapping[str, str] = SENTIMENT_LABELS) -> Column:
    return _lookup({label_: name for name, label_ in mapping.items()}, _col(label))


def merge_to_binary(
    label: Column | str, positive: str = POSITIVE_LABEL, negative: str = NEGATIVE_LABEL
) -> Column:
    """Every label other than ``positive`` counts as ``negative``; NULL stays NULL."""
    c = _col(label)
    return F.when(c == positive, positive).when(c.isNotNull(), negative)


def agreement_band(kappa: Column | str) -> Column:
    k = _col(kappa)
    band = F.when(k.isNull(), F.lit(None).cast("string"))
    for bound, name in AGREEMENT_BANDS:
        band = band.when(k < F.lit(bound), name)
    return band.otherwise(TOP_AGREEMENT_BAND)


def confidence_status(confidence: Column | str, threshold: float = 0.5) -> Column:
    """``uncertain`` below the threshold, else ``certain``."""
    c = _col(confidence)
    return F.when(c < threshold, "uncertain").when(c.isNotNull(), "certain")
