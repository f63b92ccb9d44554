"""Exact dedup in two passes over a Bloom filter, with DataFrame functions only.

Every text has a digest, and every digest a few positions in a bit field. The
first pass finds the positions that are taken more than once and keeps them as
bit maps. In the second, a row one of whose positions is taken once holds a
text of its own and passes straight through; only the others, copies and a few
that share their positions by chance, are shuffled and grouped by digest. The
field grows with the number of rows up to 64 MB; beyond that it lets more rows
through to the grouping and loses none.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.operators.skew import lookup_join
from tablewright.session import cut_lineage

# these shape the plan only
POSITIONS = 2
BITS_PER_ROW = 16
LEAST_BITS, MOST_BITS = 16, 29


def normalised(text: Column) -> Column:
    """Each run of blanks as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def field_bits(rows: int) -> int:
    """Width of a position in the bit field for so many rows."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, rows) * BITS_PER_ROW))))


def _positions(digest: str, bits: int) -> list[Column]:
    """Positions of a digest, from one; bit maps of 32,768 positions count from there."""
    return [F.shiftrightunsigned(F.xxhash64(digest, F.lit(i)), 64 - bits) + 1 for i in range(POSITIONS)]


def taken_twice(digests: DataFrame, bits: int, digest: str = "digest") -> DataFrame:
    """First pass: positions taken more than once, as bit maps by bucket."""
    return (
        digests.select(F.explode(F.array(*_positions(digest, bits))).alias("position"))
        .groupBy("position").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .groupBy(F.bitmap_bucket_number("position").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("map"))
    )


def possibly_repeated(rows: DataFrame, maps: DataFrame, bits: int, out: str, digest: str = "digest") -> DataFrame:
    """Second pass: ``rows`` with the flag ``out``; FALSE says that no other row has the digest."""
    tests = []
    for i, position in enumerate(_positions(digest, bits)):
        # at most 2**MOST_BITS bits
        own = F.broadcast(maps.select(F.col("bucket").alias(f"_bucket{i}"), F.col("map").alias(f"_map{i}")))
        rows = rows.join(own, F.bitmap_bucket_number(position) == F.col(f"_bucket{i}"), "left")
        at = F.bitmap_bit_position(position)
        byte = F.conv(F.hex(F.substring(F.col(f"_map{i}"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        tests.append(F.call_function("shiftright", byte, (at % 8).cast("int")) % 2 == 1)
    return rows.withColumn(out, F.coalesce(reduce(and_, tests), F.lit(False))).drop(
        *[f"_{c}{i}" for c in ("bucket", "map") for i in range(POSITIONS)]
    )


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they agree after each run of blanks became one space;
    NULL counts as empty, and empty texts are equal to each other. Of equal
    texts the row of the smallest id is kept; rows without id come last, so
    ``keep_id`` is NULL only where no row of the group has an id. Of rows that
    agree in id and text one is kept. Other columns are ignored; an empty table
    gives no rows.
    """
    found = cut_lineage(
        docs.select(F.col(id).alias("_id"), digest(F.col(text)).alias("digest"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    bits = field_bits(found.count())
    maps = cut_lineage(taken_twice(found, bits))
    marked = possibly_repeated(found, maps, bits, "_maybe")
    again = cut_lineage(marked.where("_maybe").drop("_maybe"))
    groups = cut_lineage(
        again.groupBy("digest").agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "row")).alias("first"),
        ).select("digest", "group_size", F.col("first._id").alias("keep_id"), F.col("first.row").alias("keep_row"))
    )
    grouped = lookup_join(again, groups, ["digest"], "group_size", ["row"], how="inner")
    alone = marked.where("NOT _maybe").drop("_maybe").withColumns({
        "group_size": F.lit(1).cast("bigint"), "keep_id": F.col("_id"), "keep_row": F.col("row"),
    })
    return alone.unionByName(grouped).select(
        F.col("_id").alias(id), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep; whole rows, all columns.

    Rows with a text of their own are not shuffled. The copies of a text are
    reduced to one row inside each task before their shuffle. Rows that tie in
    id go by a hash of their columns.
    """
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), digest(F.col(text)).alias("digest")
    )
    digests = cut_lineage(keyed.select("digest"))
    bits = field_bits(digests.count())
    marked = possibly_repeated(keyed, cut_lineage(taken_twice(digests, bits)), bits, "_maybe")
    hashed = [
        F.col("doc").getField(f.name) for f in docs.schema
        if "map<" not in (kind := f.dataType.simpleString()) and "variant" not in kind
    ]
    own = F.col("doc").getField(id)
    first = marked.where("_maybe").groupBy("digest").agg(
        F.min_by("doc", F.struct(own.isNull(), own, F.xxhash64(*hashed))).alias("doc")
    )
    kept = marked.where("NOT _maybe").select("doc").unionByName(first.select("doc"))
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
