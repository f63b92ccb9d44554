"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text are the hashes of its words, of the first letters of longer
words (so that endings don't matter), of neighbouring pairs and of pairs with
one word between (skip-grams); each counts once. Training rows are few and
bounded: one task reads them in hash order and updates one weight per feature,
each at its own rate. L1 leaves most weights at zero, so the model is a short
list that is broadcast to the tasks that score all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewright.llm import words as W

BITS = 20
STEMS = (4, 6, 8)  # bytes
SAMPLE = 8192  # training rows at most
EPOCHS = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 5.0, 1.0


class Model(NamedTuple):
    """Nonzero weights by feature, ascending, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def _features(piece: W.Slice) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Word bounds per text; for every kind of feature the words it starts at and its numbers."""
    data = W.LOWER[piece.data]
    found = W.find_words(data, piece.bounds, W.ALPHANUMERIC)
    hashes = W.word_hashes(data, found)
    at, values = [np.arange(len(hashes))], [hashes]
    for length in STEMS:
        longer = np.flatnonzero(found.ends - found.starts > length)
        stems = W.Words(found.starts[longer], found.starts[longer] + length, found.of)
        at.append(longer)
        values.append(W.mix(W.word_hashes(data, stems) + np.uint64(length)))
    for gap in (1, 2):
        pairs = np.flatnonzero(W.whole_runs(found.of, gap + 1))
        at.append(pairs)
        values.append(W.mix(hashes[pairs] * np.uint64(W.FIRST) + hashes[pairs + gap] * np.uint64(W.SECOND) + np.uint64(gap)))
    return found.of, at, [(v >> np.uint64(64 - BITS)).astype(np.int32) for v in values]


def _feature_lists(docs: DataFrame) -> DataFrame:
    """order, tie, label and the different features of a text; in: order, tie, label, text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.slices(batch.column(3)):
                of, at, values = _features(piece)
                rows = [[] for _ in range(piece.last - piece.first)]
                for places, numbers in zip(at, values):
                    edges = np.searchsorted(places, of)
                    for d, row in enumerate(rows):
                        row.append(numbers[edges[d]:edges[d + 1]])
                different = [np.unique(np.concatenate(row)) for row in rows]
                own = batch.slice(piece.first, piece.last - piece.first)
                yield pa.RecordBatch.from_arrays([
                    own.column(0), own.column(1), own.column(2),
                    W.lists(np.concatenate(different).astype(np.int32), np.array([len(x) for x in different]), pa.int32()),
                ], ["order", "tie", "label", "features"])

    return docs.mapInArrow(work, "order bigint, tie bigint, label int, features array<int>")


def _ftrl(rows: list[tuple[int, np.ndarray]]) -> Model:
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last place is the bias, which has no L1
    penalty = np.full(size + 1, L1)
    penalty[size] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        w = -(own - np.sign(own) * penalty[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(own) <= penalty[at], 0.0, w)

    for _ in range(EPOCHS):
        for label, features in rows:
            at = np.append(features, size)
            w = weights(at)
            gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            square = n[at]
            after = square + gradient * gradient
            z[at] += gradient - (np.sqrt(after) - np.sqrt(square)) / ALPHA * w
            n[at] = after
    w = weights(np.arange(size + 1))
    kept = np.flatnonzero(w[:size])
    return Model(kept.astype(np.int32), w[kept], float(w[size]))


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """Learn from at most ``sample`` labelled ids, those that come first by hash.

    ``labels`` has an id and a label of 0 or 1; rows with a NULL in either are
    left out, and of labels that disagree the larger counts. Rows of one id
    train in the order of their texts' hashes. Without any training row the
    model gives every text the score 0.5.
    """
    chosen = (
        labels.where(F.col(id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id).alias("_id")).agg(F.max(label).cast("int").alias("label"))
        .withColumn("order", F.xxhash64("_id", F.lit(7)))
        .orderBy("order", "_id").limit(sample)
    )
    # at most ``sample`` ids and labels, so the texts need no shuffle
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id").select(
        "order", F.xxhash64("_text").alias("tie"), "label", "_text"
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = []
        for batch in batches:
            for label, features in zip(batch.column(2), batch.column(3)):
                if len(taken) < sample:  # repeated ids could bring more
                    taken.append((label.as_py(), features.values.to_numpy(zero_copy_only=False)))
        model = _ftrl(taken)
        yield pa.RecordBatch.from_arrays([
            pa.array([model.features.tolist()], pa.list_(pa.int32())),
            pa.array([model.weights.tolist()], pa.list_(pa.float64())), pa.array([model.bias]),
        ], ["features", "weights", "bias"])

    # the features of the bounded sample go to one task, in the order of their hashes
    found = (
        _feature_lists(rows).repartition(1).sortWithinPartitions("order", "tie")
        .mapInArrow(train, "features array<int>, weights array<double>, bias double").first()
    )
    if found is None:
        return Model(np.zeros(0, dtype=np.int32), np.zeros(0), 0.0)
    return Model(np.array(found["features"], dtype=np.int32), np.array(found["weights"], dtype=float), found["bias"])


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score"):
    """Add ``out``, the probability of label 1; NULL and empty texts get that of the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features, weights, bias = shared.value
        dense = np.zeros(1 << BITS)
        dense[features] = weights
        for part in texts:
            sums = np.empty(len(part))
            for piece in W.slices(part):
                of, at, values = _features(piece)
                keys = []
                for places, numbers in zip(at, values):
                    hit = np.flatnonzero(dense[numbers])
                    row = np.searchsorted(of, places[hit], side="right") - 1
                    keys.append(row << BITS | numbers[hit])
                keys = np.unique(np.concatenate(keys))
                total = np.bincount(keys >> BITS, dense[keys & ((1 << BITS) - 1)], piece.last - piece.first)
                sums[piece.first:piece.last] = 1.0 / (1.0 + np.exp(-np.clip(total + bias, -35, 35)))
            yield pa.array(sums)

    return docs.withColumn(out, scored(F.col(text)))
