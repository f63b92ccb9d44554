"""Benchmark decontamination by winnowing.

A window is ten neighbouring words of a benchmark item (a shorter item is one
window). Of every ten words the least 5-gram hash is kept as fingerprint, for
documents and items alike, so two equal windows always keep an equal
fingerprint. Item fingerprints and windows go into two bit maps of a fixed
size, whatever the size of the benchmark; documents look up their fingerprints
there, extend hits to the windows around them, and only windows whose hash is
on the second map leave the task. A join with the benchmark's windows then
decides which of them are real.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm import words as W
from tablewright.llm.bitmaps import bit_map, on_map
from tablewright.session import cut_lineage

WINDOW = 10


def _hashes(piece: W.Slice) -> tuple[W.Words, np.ndarray]:
    data = W.LOWER[piece.data]
    found = W.find_words(data, piece.bounds, W.ALPHANUMERIC)
    return found, W.word_hashes(data, found)


def _grams(hashes: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """k-gram hashes, those kept by winnowing, whole windows, and grams per window."""
    gram = (size + 1) // 2
    width = size - gram + 1
    grams = W.run_hashes(hashes, gram)
    whole = W.whole_runs(of, size)
    kept = W.winnow(grams, whole, width)
    return grams, kept, whole, width


def item_windows(items: DataFrame, id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Different windows of every item: id, ``size`` in words, ``h``, and whether it is a window (else a fingerprint)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.slices(batch.column(1)):
                found, hashes = _hashes(piece)
                for d in range(piece.last - piece.first):
                    own = hashes[found.of[d]:found.of[d + 1]]
                    if len(own) == 0:
                        continue
                    size = min(window, len(own))
                    of = np.array([0, len(own)])
                    grams, kept, _, _ = _grams(own, of, size)
                    runs = np.unique(W.run_hashes(own, size))
                    marks = np.unique(grams[kept])
                    n = len(runs) + len(marks)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch.column(0)[piece.first + d].as_py()] * n, type=batch.column(0).type),
                        pa.array(np.full(n, size, dtype=np.int32)),
                        pa.array(W.signed(np.concatenate([runs, marks]))),
                        pa.array(np.arange(n) < len(runs)),
                    ], [id, "size", "h", "is_window"])

    kind = items.schema[id].dataType.simpleString()
    return items.select(F.col(id), F.col(text)).mapInArrow(
        run, f"`{id}` {kind}, size int, h bigint, is_window boolean"
    )


def candidate_windows(
    docs: DataFrame, keep: Sequence[str], text: str, sizes: Sequence[int], marks: np.ndarray, runs: np.ndarray
) -> DataFrame:
    """``keep``, number of words, and the windows worth a look as parallel lists."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast((list(sizes), marks, runs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, marks, runs = shared.value
        for batch in batches:
            column = batch.column(len(keep))
            for piece in W.slices(column):
                found, hashes = _hashes(piece)
                per_row = np.diff(found.of)
                rows, at, size_of, h_of = [], [], [], []
                for size in sizes:
                    grams, kept, whole, width = _grams(hashes, found.of, size)
                    hit = kept.copy()
                    hit[kept] = on_map(marks, grams[kept])
                    if not hit.any():
                        continue
                    # windows whose grams include a hit
                    near = np.flatnonzero(W.slide(np.logical_or, hit, width)[:len(whole)] & whole)
                    values = W.run_hashes(hashes, size)[near]
                    real = on_map(runs, values)
                    near, values = near[real], values[real]
                    row = np.searchsorted(found.of, near, side="right") - 1
                    rows.append(row)
                    at.append(near - found.of[row])
                    size_of.append(np.full(len(near), size))
                    h_of.append(values)
                if rows:
                    row = np.concatenate(rows)
                    order = np.argsort(row, kind="stable")
                    counts = np.bincount(row, minlength=len(per_row))
                    parts = [np.concatenate(x)[order] for x in (at, size_of)] + [W.signed(np.concatenate(h_of)[order])]
                else:
                    counts = np.zeros(len(per_row), dtype=np.int64)
                    parts = [np.zeros(0, dtype=np.int64)] * 3
                own = batch.slice(piece.first, piece.last - piece.first)
                yield pa.RecordBatch.from_arrays(
                    [own.column(i) for i in range(len(keep))] + [
                        pa.array(per_row.astype(np.int64)),
                        W.lists(parts[0].astype(np.int32), counts, pa.int32()),
                        W.lists(parts[1].astype(np.int32), counts, pa.int32()),
                        W.lists(parts[2], counts, pa.int64()),
                    ], [*keep, "n_words", "starts", "sizes", "hashes"],
                )

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return docs.select(*[F.col(c) for c in keep], F.col(text)).mapInArrow(
        run, ", ".join([*fields, "n_words bigint, starts array<int>, sizes array<int>, hashes array<bigint>"])
    )


def benchmark_hits(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, keep: Sequence[str] = (),
) -> DataFrame:
    """Per row: words, words inside a window of an item, and the sorted ids of the items met.

    A NULL or empty text has no words and no hits; NULL and wordless items
    have no windows. Rows with the same id are judged each on its own text,
    repeated items count once, items with a NULL id mark words but are not
    listed. ``keep`` names further columns to carry along.
    """
    renamed = items.select(F.col(item_id).cast("string").alias("_item"), F.col(item_text).alias("_item_text"))
    known = cut_lineage(item_windows(renamed, "_item", "_item_text", window).distinct())
    sizes = [r["size"] for r in known.select("size").distinct().collect()]  # at most ``window`` rows
    marks = bit_map(known.where(~F.col("is_window")))
    runs = bit_map(known.where("is_window"))
    columns = list(dict.fromkeys([id, *keep]))
    found = cut_lineage(
        candidate_windows(docs, columns, text, sorted(sizes), marks, runs)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    seen = found.where(F.size("hashes") > 0).select(
        "_row", F.explode(F.arrays_zip("starts", "sizes", "hashes")).alias("w")
    ).select("_row", F.col("w.starts").alias("start"), F.col("w.sizes").alias("size"), F.col("w.hashes").alias("h"))
    met = cut_lineage(
        seen.join(known.where("is_window").select("h", "size", "_item"), ["h", "size"])
        .groupBy("_row", "start", "size").agg(F.collect_set("_item").alias("of"))
    )
    spans = met.groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans"))
    named = met.select("_row", F.explode("of").alias("_item")).groupBy("_row").agg(
        F.array_sort(F.collect_set("_item")).alias("items")
    )
    # walk over the sorted spans and count the words not counted before
    walked = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(acc["upto"], s["start"]))).alias("n"),
            F.greatest(acc["upto"], s["start"] + s["size"]).alias("upto"),
        ),
        lambda acc: acc["n"].cast("bigint"),
    )
    none = F.array().cast("array<string>")
    return (
        found.join(spans.select("_row", "spans", walked.alias("_hit")), "_row", "left")
        .join(named, "_row", "left")
        .select(
            *columns, "n_words",
            F.coalesce("_hit", F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,size:int>>")).alias("spans"),
        )
    )
