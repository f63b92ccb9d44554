"""Repeated passages by relative Lempel-Ziv parsing.

Every text is a reference block. The index holds, for each run of 35 words,
the least 12-gram hash (an anchor); equal runs have equal anchors. Texts that
own an anchor seen twice are read again, all runs around such anchors are put
into the index of runs with the first and the last place (block and word) that
holds them, and each text is parsed from the left: a factor begins with a run
that stands at another place and goes on word by word while the same block goes
on with the same run. At each factor boundary the next run is looked up among
all blocks before the parse moves on, so no run that occurs twice is missed,
whichever factors the greedy choice cuts it into. A factor equals the words of
its block from its place on, and the words under the factors are the duplicate
spans. A text of which there are copies is one factor.

A place is one number: the size class of its text (bits of its number of
words), the task that read it, and an offset in which texts of a class begin at
multiples of its size. The lowest bits are then the word in the text, the rest
is the text, and of each run only two places go through the shuffle.

Runs are compared by 64-bit hashes. A fixed-size bit map of the touched texts
keeps all others out of the shuffles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm import words as W
from tablewright.llm.bitmaps import on_map_of, text_key
from tablewright.session import cut_lineage

RUN = 35
GRAM = 12
EMPTY = hashlib.sha256(b"").hexdigest()
FACTOR = "struct<start:int,words:int,block:bigint,at:int>"
# of the 64 bits of a place 5 are the size class, 22 the task; 2**37 words of one class in a task are more than it can hold
CLASS_AT, TASK_AT = 59, 37


class Places:
    """Numbers texts in the order they are met, by place of the first word; ``task`` tells tasks apart."""

    def __init__(self, task: int):
        if task >= 1 << (CLASS_AT - TASK_AT):
            raise ValueError(f"at most {1 << (CLASS_AT - TASK_AT)} tasks can number texts")
        self.task, self.met = task, np.zeros(32, dtype=np.int64)

    def of(self, n_words: np.ndarray) -> np.ndarray:
        bits = np.frexp(n_words.astype(np.float64))[1].astype(np.int64)  # of the number of words
        out = np.zeros(len(bits), dtype=np.int64)
        for k in np.unique(bits).tolist():
            own = bits == k
            offset = (self.met[k] + np.arange(own.sum())) << k
            self.met[k] += own.sum()
            if self.met[k] << k > 1 << TASK_AT:
                raise ValueError("too many words in one task")
            out[own] = np.int64(self.task << TASK_AT) | offset
        return out | (bits.astype(np.uint64) << np.uint64(CLASS_AT)).view(np.int64)


def word_of(places: np.ndarray) -> np.ndarray:
    """The word in its text that a place is; the place less that is the text."""
    bits = (places.view(np.uint64) >> np.uint64(CLASS_AT)).astype(np.int64)
    return places & ((np.int64(1) << bits) - 1)


def _word_of(place: Column) -> Column:
    """``word_of`` as an expression."""
    bits = F.shiftrightunsigned(place, CLASS_AT).cast("int")
    return place.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1)


def _runs(piece: W.Slice, run: int, gram: int):
    found = W.find_words(piece.data, piece.bounds, W.NOT_BLANK)
    hashes = W.word_hashes(piece.data, found)
    whole = W.whole_runs(found.of, run)
    grams = W.run_hashes(hashes, gram)
    kept = W.winnow(grams, whole, run - gram + 1)
    return found, hashes, whole, grams, kept


def _index(docs: DataFrame, id: str, text: str, run: int, gram: int) -> DataFrame:
    """Per row: id, text key, number of words, digest of the words, anchors (one per place), place of the first word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(TaskContext.get().partitionId())
        for batch in batches:
            for piece in W.slices(batch.column(2)):
                found, _, _, grams, kept = _runs(piece, run, gram)
                at = np.flatnonzero(kept)
                counts = np.diff(np.searchsorted(at, found.of))
                raw = piece.data.tobytes()
                digests = [
                    hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest()
                    for a, b in zip(piece.bounds[:-1], piece.bounds[1:])
                ]
                own = batch.slice(piece.first, piece.last - piece.first)
                n_words = np.diff(found.of).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    own.column(0), own.column(1), pa.array(n_words),
                    pa.array(digests), W.lists(W.signed(grams[at]), counts, pa.int64()), pa.array(places.of(n_words)),
                ], ["_id", "_key", "n_words", "digest", "anchors", "row"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id), text_key(text), F.col(text)).mapInArrow(
        work, f"_id {kind}, _key binary, n_words bigint, digest string, anchors array<bigint>, row bigint"
    )


def _candidates(texts: DataFrame, run: int, gram: int) -> DataFrame:
    """Runs around repeated anchors as parallel lists; in: row, last_row, marks, text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.slices(batch.column(3)):
                found, hashes, whole, grams, kept = _runs(piece, run, gram)
                own = batch.slice(piece.first, piece.last - piece.first)
                known = np.unique(own.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
                hit = kept.copy()
                hit[kept] = np.isin(grams[kept], known)
                near = np.flatnonzero(W.slide(np.logical_or, hit, run - gram + 1)[:len(whole)] & whole)
                row = np.searchsorted(found.of, near, side="right") - 1
                counts = np.bincount(row, minlength=len(own))
                values = W.run_hashes(hashes, run)[near]
                yield pa.RecordBatch.from_arrays([
                    own.column(0), own.column(1),
                    W.lists((near - found.of[row]).astype(np.int32), counts, pa.int32()),
                    W.lists(W.signed(values), counts, pa.int64()),
                ], ["row", "last_row", "starts", "runs"])

    return texts.select("row", "last_row", "marks", "text").mapInArrow(
        work, "row bigint, last_row bigint, starts array<int>, runs array<bigint>"
    )


def factors(
    starts: np.ndarray, blocks: np.ndarray, places: np.ndarray, run: int
) -> list[tuple[int, int, int, int]]:
    """Parse from the left: (first word, words, block, word in it) for runs that stand elsewhere, in order of their starts.

    A factor ends where the next run stands nowhere else or where its block
    does not go on with it; the next run then opens a factor of its own, so
    factors may overlap.
    """
    if len(starts) == 0:
        return []
    goes_on = (np.diff(starts) == 1) & (blocks[1:] == blocks[:-1]) & (np.diff(places) == 1)
    cut = np.flatnonzero(~goes_on) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(starts)]]) - 1
    return [
        (int(starts[a]), int(starts[b] - starts[a]) + run, int(blocks[a]), int(places[a])) for a, b in zip(first, last)
    ]


def _touched_texts(docs: DataFrame, id: str, text: str, wanted: DataFrame) -> DataFrame:
    """Texts of ``wanted`` (key, first_id and more); others are filtered before the shuffle."""
    listed = on_map_of(wanted.select(F.xxhash64("key").alias("h")))
    keyed = docs.select(F.col(id).alias("_id"), text_key(text).alias("key"), F.col(text).alias("text"))
    # by id as well, so that one text of a group of copies is read; repeated rows do no harm
    return (
        keyed.where(listed(F.xxhash64("key")))
        .join(wanted, (keyed["key"] == wanted["key"]) & keyed["_id"].eqNullSafe(wanted["first_id"]))
        .drop("_id", "first_id", keyed["key"])
    )


def repeated_passages(
    docs: DataFrame, id: str = "doc_id", text: str = "text", run: int = RUN, gram: int = GRAM,
) -> DataFrame:
    """Per row: words, words removed, digest of the kept words, factors, kept text and ``row``.

    A run of ``run`` words that starts at two places of the corpus (of one text
    or of two) is removed at all of them. NULL, empty and blank texts have no
    words and keep the empty text; texts shorter than a run keep all words;
    equal texts of at least ``run`` words lose all of them, whatever their ids.
    ``kept`` is NULL where the text keeps all its words, else the kept words
    joined by one space. A factor has its first word and number of words, the
    number of the row (``row``, the place of its first word) it is found in and the word it starts at there;
    a text of which there are copies is one factor of another copy's row. Other
    columns are ignored.
    """
    found = cut_lineage(_index(docs, id, text, run, gram))
    # aggregates are stored before they are joined back: then both sides of the join
    # are shuffled, and Spark may split a key that very many rows share
    distinct = cut_lineage(found.groupBy("_key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("row").alias("row"), F.max("row").alias("last_row")
    ))
    anchors = found.select("row", F.explode("anchors").alias("h"))
    repeated = cut_lineage(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    marked = anchors.join(repeated, "h").groupBy("row").agg(F.collect_set("h").alias("marks"))
    first_ids = found.select("row", F.col("_id").alias("first_id"))
    wanted = cut_lineage(
        distinct.join(marked, "row").join(first_ids, "row")
        .select(F.col("_key").alias("key"), "row", "last_row", "first_id", "marks")
    )
    runs = cut_lineage(_candidates(_touched_texts(docs, id, text, wanted), run, gram))
    places = runs.select("row", "last_row", F.explode(F.arrays_zip("starts", "runs")).alias("p")).select(
        (F.col("row") + F.col("p.starts")).alias("place"), (F.col("last_row") + F.col("p.starts")).alias("in_last"),
        F.col("p.runs").alias("h"),
    )
    # the first and the last place of a run; a text with copies holds its runs in its first and its last copy
    index = cut_lineage(
        places.groupBy("h").agg(F.min("place").alias("first"), F.max("in_last").alias("last")).where("first <> last")
    )
    start = _word_of(F.col("place"))
    other = F.when(F.col("first") == F.col("place"), F.col("last")).otherwise(F.col("first"))
    # both lists of a row are gathered by one aggregate, so their items stand in the same order
    spans = cut_lineage(
        places.where("place = in_last").select("place", "h").join(index, "h")
        .select((F.col("place") - start).alias("row"), start.cast("int").alias("start"), other.alias("other"))
        .groupBy("row").agg(F.collect_list("start").alias("starts"), F.collect_list("other").alias("others"))
        .join(wanted.select("row", "key", "first_id"), "row")
        .select("key", "first_id", "starts", "others")
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, removed, digests, found_in, kept = [], [], [], [], []
            for key, *hits, body in zip(*(batch.column(i) for i in range(4))):
                starts, places = (x.values.to_numpy(zero_copy_only=False) for x in hits)
                order = np.argsort(starts)
                starts, places = starts[order], places[order]
                own = body.as_py().encode().split()
                at = word_of(places)
                parsed = factors(starts, places - at, at, run)
                cover = np.zeros(len(own), dtype=bool)
                for start, n, _, _ in parsed:
                    cover[start:start + n] = True
                rest = b" ".join(w for w, gone in zip(own, cover.tolist()) if not gone)
                keys.append(key.as_py())
                removed.append(int(cover.sum()))
                digests.append(hashlib.sha256(rest).hexdigest())
                found_in.append([{"start": s, "words": n, "block": b, "at": p} for s, n, b, p in parsed])
                kept.append(rest.decode())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("block", pa.int64()), ("at", pa.int32())]))
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.binary()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
                pa.array(found_in, kind), pa.array(kept, pa.string()),
            ], ["_key", "gone", "rest_digest", "factors", "rest"])

    parsed = _touched_texts(docs, id, text, spans).select("key", "starts", "others", "text").mapInArrow(
        parse, f"_key binary, gone bigint, rest_digest string, factors array<{FACTOR}>, rest string"
    )
    whole = (F.col("copies") > 1) & (F.col("n_words") >= run)
    other = F.when(F.col("row") == F.col("first_row"), F.col("last_row")).otherwise(F.col("first_row"))
    copy = F.array(F.struct(
        F.lit(0).alias("start"), F.col("n_words").cast("int").alias("words"), other.alias("block"), F.lit(0).alias("at")
    ))
    return (
        found.drop("anchors")
        .join(distinct.withColumnRenamed("row", "first_row"), "_key")
        .join(parsed, "_key", "left")
        .select(
            F.col("_id").alias(id), "n_words",
            F.when(whole, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).alias("n_removed"),
            F.when(whole, EMPTY).otherwise(F.coalesce("rest_digest", "digest")).alias("kept_sha256"),
            F.when(whole, copy).otherwise(F.coalesce("factors", F.array().cast(f"array<{FACTOR}>"))).alias("factors"),
            F.when(whole, F.lit("")).otherwise(F.col("rest")).alias("kept"), "row",
        )
    )
