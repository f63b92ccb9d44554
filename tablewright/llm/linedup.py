"""Line dedup by pairwise alignment.

Documents that share a run of lines with enough words meet: each pairs with the
first document that holds the run, so a run of m documents gives m - 1 pairs,
not their square. Of every pair the two line lists are aligned by patience
diff, and the common blocks are deleted from the later document. A run that
alignment leaves, because it stands elsewhere in the order or is repeated,
though an earlier document holds it, goes as well; for that no pair is needed,
its first holder is known. So the result is the same whichever documents meet:
a line goes if it lies in a run of neighbouring lines, with enough words in
total, that an earlier document holds as one run, too. All is judged on the
input, and the first holder of a run keeps it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tablewright.llm import words as W
from tablewright.llm.bitmaps import on_map_of, text_key
from tablewright.session import cut_lineage

MIN_WORDS = 6


def patience(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Matched positions of two lists, both ascending.

    Equal heads and tails match; between them the items that occur once in each
    list match along a longest increasing chain; the gaps are treated likewise.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        once_a = {x for x, n in Counter(a[i:i_end]).items() if n == 1}
        seen_b = Counter(b[j:j_end])
        at_b = {b[q]: q for q in range(j, j_end) if seen_b[b[q]] == 1}
        pairs = [(p, at_b[a[p]]) for p in range(i, i_end) if a[p] in once_a and a[p] in at_b]
        # longest chain ascending in both, by piles
        tops, piles, back = [], [], [None] * len(pairs)
        for k, (_, q) in enumerate(pairs):
            pile = bisect_left(tops, q)
            if pile == len(tops):
                tops.append(q)
                piles.append(k)
            else:
                tops[pile], piles[pile] = q, k
            back[k] = piles[pile - 1] if pile else None
        chain, k = [], piles[-1] if piles else None
        while k is not None:
            chain.append(pairs[k])
            k = back[k]
        chain.reverse()
        if not chain:
            continue
        out.extend(chain)
        edges = [(i - 1, j - 1), *chain, (i_end, j_end)]
        todo.extend((p + 1, p2, q + 1, q2) for (p, q), (p2, q2) in zip(edges, edges[1:]))
    return sorted(out)


def common_blocks(matched: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Runs of neighbouring matches: (first in a, first in b, length)."""
    blocks = []
    for i, j in matched:
        if blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1] = (blocks[-1][0], blocks[-1][1], blocks[-1][2] + 1)
        else:
            blocks.append((i, j, 1))
    return blocks


def meeting_runs(sizes: Sequence[int], min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First lines and ends of the runs that bring documents together.

    From each line the shortest run of ``min_words`` words that begins with it,
    and the shortest that ends with it. Every line of a longer run with as many
    words lies in one of them that the run holds whole.
    """
    total = np.concatenate([[0], np.cumsum(np.asarray(sizes, dtype=np.int64))])
    lines = len(sizes)
    begin = np.arange(lines)
    end = np.searchsorted(total, total[:-1] + min_words, side="left")
    whole = end <= lines
    last = np.flatnonzero(total[1:] >= min_words) + 1
    first = np.searchsorted(total, total[last] - min_words, side="right") - 1
    both = np.unique(np.concatenate([begin[whole] * (lines + 1) + end[whole], first * (lines + 1) + last]))
    return both // (lines + 1), both % (lines + 1)


def _line_lists(docs: DataFrame, columns: Sequence[str], text: str, min_words: int) -> DataFrame:
    """``columns`` and lists per text: hashes and numbers of words of its lines; hash, first line and length of its meeting runs."""
    n = len(columns)

    def digest(x: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.slices(batch.column(n)):
                raw = piece.data.tobytes()
                hashes, sizes, runs, starts, lengths = [], [], [], [], []
                for a, b in zip(piece.bounds[:-1], piece.bounds[1:]):
                    lines = raw[a:b].split(b"\n")
                    hashes.append(np.array([digest(x) for x in lines], dtype=np.int64))
                    sizes.append(np.array([len(x.split()) for x in lines], dtype=np.int32))
                    first, end = meeting_runs(sizes[-1], min_words)
                    runs.append(W.signed(W.span_hashes(hashes[-1].view(np.uint64), first, end)))
                    starts.append(first.astype(np.int32))
                    lengths.append((end - first).astype(np.int32))
                counts, met = np.array([len(x) for x in hashes]), np.array([len(x) for x in runs])
                own = batch.slice(piece.first, piece.last - piece.first)
                yield pa.RecordBatch.from_arrays(
                    [own.column(i) for i in range(n)] + [
                        W.lists(np.concatenate(hashes), counts, pa.int64()), W.lists(np.concatenate(sizes), counts, pa.int32()),
                        W.lists(np.concatenate(runs), met, pa.int64()), W.lists(np.concatenate(starts), met, pa.int32()),
                        W.lists(np.concatenate(lengths), met, pa.int32()),
                    ], [*columns, "lines", "sizes", "run", "at", "n"],
                )

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    return docs.select(*columns, text).mapInArrow(work, ", ".join([
        *fields, "lines array<bigint>, sizes array<int>, run array<bigint>, at array<int>, n array<int>"
    ]))


def _aligned(pairs: DataFrame, min_words: int) -> DataFrame:
    """Row, first line and length of the common blocks, for pairs of earlier lines, later lines and line sizes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, lengths = [], [], []
            for row, a, b, size in zip(*(batch.column(i) for i in range(4))):
                a, b, size = a.as_py(), b.as_py(), size.as_py()
                for _, j, n in common_blocks(patience(a, b)):
                    if sum(size[j:j + n]) >= min_words:
                        rows.append(row.as_py())
                        at.append(j)
                        lengths.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(at, pa.int32()), pa.array(lengths, pa.int32())], ["row", "at", "n"]
            )

    return pairs.select("row", "first_lines", "lines", "sizes").mapInArrow(work, "row bigint, at int, n int")


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _covered(blocks: pa.Array) -> pa.Array:
    """Numbers of the lines under blocks of first line and length, ascending."""
    out = []
    for own in blocks:
        at = own.values.field("at").to_numpy(zero_copy_only=False).astype(np.int64)
        n = own.values.field("n").to_numpy(zero_copy_only=False)
        change = np.zeros(int((at + n).max()) + 1, dtype=np.int32)
        np.add.at(change, at, 1)
        np.add.at(change, at + n, -1)
        out.append(np.flatnonzero(np.cumsum(change[:-1]) > 0).astype(np.int32))
    return pa.array(out, pa.list_(pa.int32()))


def held_before(found: DataFrame) -> DataFrame:
    """Runs (row, run, at, n) that an earlier document holds, with the row of the first one (``first_row``).

    ``found`` has row, _id, _key and the lists run, at and n.
    """
    runs = found.select("row", "_id", "_key", F.explode(F.arrays_zip("run", "at", "n")).alias("r")).select(
        "row", "_id", "_key", F.col("r.run").alias("run"), F.col("r.at").alias("at"), F.col("r.n").alias("n")
    )
    first = F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "_key", "row"))).alias("first")
    # stored, so that both sides of the join are shuffled and Spark may split a run of very many documents
    holders = cut_lineage(
        runs.groupBy("run").agg(first, F.count(F.lit(1)).alias("holders")).where("holders > 1 AND first IS NOT NULL")
        .select("run", F.col("first._id").alias("first_id"), F.col("first._key").alias("first_key"), F.col("first.row").alias("first_row"))
    )
    earlier = F.col("_id").isNull() | (F.col("first_id") < F.col("_id")) | (
        (F.col("first_id") == F.col("_id")) & (F.col("first_key") < F.col("_key"))
    )
    return runs.join(holders, "run").where(earlier).select("row", "run", "at", "n", "first_row")


def repeated_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Per document that loses lines: ``_id``, ``_key`` (of its text) and the numbers of the lines, from 0.

    A line is what stands between line feeds. It goes if it lies in a run of
    neighbouring lines, ``min_words`` words or more in total, that an earlier
    document holds as one run, too. Documents come in the order of their ids,
    and of their text keys under one id; rows that agree in both are one
    document. Rows without id lose lines to others and never come first. A NULL
    or empty text is one line without words and loses nothing.
    """
    keyed = docs.select(F.col(id).alias("_id"), text_key(text).alias("_key"), F.col(text).alias("_text"))
    found = cut_lineage(
        _line_lists(keyed, ["_id", "_key"], "_text", min_words).withColumn("row", F.monotonically_increasing_id())
    )
    held = cut_lineage(held_before(found))
    pairs = held.select("row", "first_row").distinct()
    ahead = found.select(F.col("row").alias("first_row"), F.col("lines").alias("first_lines"))
    both = pairs.join(found.select("row", "lines", "sizes"), "row").join(ahead, "first_row")
    # runs that no alignment reached go by their first holder
    gone = _aligned(both, min_words).unionByName(held.select("row", "at", "n"))
    # blocks of one row: at most a few per line of its text
    lists = gone.groupBy("row").agg(F.collect_set(F.struct("at", "n")).alias("blocks"))
    return (
        lists.join(found.select("row", "_id", "_key"), "row")
        .select("_id", "_key", _covered("blocks").alias("deleted")).dropDuplicates(["_id", "_key"])
    )


def without_repeated_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
    deleted: str = "n_deleted",
) -> DataFrame:
    """``docs`` with the deleted lines cut out of its texts, and their number.

    The lines that stay are joined by line feeds; a text that loses nothing
    stays as it is. All other columns are carried along. Texts that lose
    nothing are told apart by a bit map and stay out of the shuffle.
    """
    marks = cut_lineage(repeated_lines(docs, id, text, min_words))
    may_lose = on_map_of(marks.select(F.xxhash64("_id", "_key").alias("h")))(F.xxhash64(F.col(id), text_key(text)))
    # the row stays one column until the end, so its names can't meet those used here
    touched = docs.where(may_lose).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id).alias("own_id"), text_key(text).alias("own_key")
    )
    body = F.col("doc").getField(text)
    rest = F.array_join(
        F.filter(F.split(body, "\n", -1), lambda _, i: ~F.array_contains("deleted", i)), "\n"
    )
    cut = touched.join(
        marks, F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own_key") == F.col("_key")), "left"
    ).select(
        *[
            (F.when(F.col("deleted").isNotNull(), rest).otherwise(body) if c == text else F.col("doc").getField(c)).alias(c)
            for c in docs.columns
        ],
        F.coalesce(F.size("deleted"), F.lit(0)).cast("bigint").alias(deleted),
    )
    return docs.where(~may_lose).withColumn(deleted, F.lit(0).cast("bigint")).unionByName(cut)
