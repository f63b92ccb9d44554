"""Near-duplicates by SimHash over word shingles.

Method: byte-position inverted index with count filtering. Fingerprints that
differ in at most two bits agree in at least six of their eight bytes. A
posting of a single position and byte would hold a 256th of all fingerprints,
so the pairs it yields grow with the square of the corpus. Postings here are
keyed by six positional bytes together: each of the 28 ways to choose them is
the tally "at least six shared" taken by the shuffle itself, and two
fingerprints meet exactly if they reach it. What is left open in a posting are
two bytes, so it holds at most 65,536 different fingerprints; postings of
two are verified in SQL, larger ones are linked inside their own row by
looking up the 136 neighbours of every member, without listing pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.bitmaps import text_key
from tablewright.llm.components import components
from tablewright.session import cut_lineage

SEED = 42
BYTES = 8
SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of one text, unsigned: a bit is set if more than half of the shingles set it."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(found), SEED)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(join(s), SEED) for s in zip(*(found[i:] for i in range(words)))]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        part = np.array(hashes[at:at + SHINGLES_AT_ONCE], dtype=">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """Id and fingerprint (``fp``, a signed long) of every row; NULL and blank texts get zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            found = np.fromiter(
                (fingerprint(t.as_py().encode(), words) if t.is_valid else 0 for t in column),
                dtype=np.uint64, count=len(column),
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [id, "fp"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id), F.col(text)).mapInArrow(run, f"`{id}` {kind}, fp bigint")


def _positions(distance: int) -> list[tuple[int, ...]]:
    """The ways to choose the byte positions that are left open."""
    return list(combinations(range(BYTES), distance))


def _mask(opened: tuple[int, ...]) -> int:
    kept = ((1 << 64) - 1) ^ sum(0xFF << (8 * p) for p in opened)
    return kept - (1 << 64) if kept >= 1 << 63 else kept


def _link(members: np.ndarray, opened: tuple[int, ...], distance: int) -> np.ndarray:
    """For each member of a posting the least member it reaches over steps of at most ``distance`` bits."""
    values = np.zeros(len(members), dtype=np.int64)
    for i, p in enumerate(opened):
        values |= ((members.view(np.uint64) >> np.uint64(8 * p)) & np.uint64(0xFF)).astype(np.int64) << (8 * i)
    bits = 8 * len(opened)
    steps = [sum(1 << b for b in c) for d in range(1, distance + 1) for c in combinations(range(bits), d)]
    place = np.full(1 << bits, -1, dtype=np.int64)
    place[values] = np.arange(len(values))
    root = np.arange(len(values))
    pairs = []
    for step in steps:
        other = place[values ^ step]
        hit = np.flatnonzero(other > np.arange(len(values)))
        if len(hit):
            pairs.append((hit, other[hit]))
    while pairs:
        old = root.copy()
        for a, b in pairs:
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
        root = root[root]
        if (old == root).all():
            break
    return members[root]


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Edges (src, dst) that join all of ``fp`` within ``distance`` bits, directly or by steps.

    ``fps`` has one row per different fingerprint. Works for distances of one
    and two bits, whose open bytes still fit a table of 65,536 places.
    """
    if distance not in (1, 2):
        raise ValueError("links are defined for a distance of one or two bits")
    ways = _positions(distance)
    keys = F.array(*[
        F.struct(F.lit(i).cast("tinyint").alias("way"), F.col("fp").bitwiseAND(F.lit(_mask(w))).alias("key"))
        for i, w in enumerate(ways)
    ])
    index = fps.select("fp", F.explode(keys).alias("k")).select("k.way", "k.key", "fp")
    postings = cut_lineage(
        index.groupBy("way", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"))
        .where("n > 1")
    )
    twos = postings.where("n = 2").where(
        F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) <= distance
    ).select(F.col("high").alias("src"), F.col("low").alias("dst"))
    # a posting is one way and one key: at most 2**16 different fingerprints
    more = (
        index.join(postings.where("n > 2").select("way", "key"), ["way", "key"])
        .groupBy("way", "key").agg(F.array_sort(F.collect_list("fp")).alias("members"))
    )

    @F.arrow_udf("array<bigint>")
    def roots(way: pa.Array, members: pa.Array) -> pa.Array:
        return pa.array([
            _link(m.values.to_numpy(zero_copy_only=False), ways[w.as_py()], distance) for w, m in zip(way, members)
        ], pa.list_(pa.int64()))

    linked = more.select(F.explode(F.arrays_zip("members", roots("way", "members").alias("roots"))).alias("e"))
    return twos.unionByName(
        linked.select(F.col("e.members").alias("src"), F.col("e.roots").alias("dst")).where("src != dst")
    )


def _least_of_component(found: DataFrame, name: Column, distance: int) -> DataFrame:
    """For each ``fp`` the least ``name`` over all fingerprints it is linked with."""
    fps = cut_lineage(found.groupBy("fp").agg(F.min(name).alias("first")))
    roots = components(links(fps, distance))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.select("fp", "root").join(named, "root").select("fp", "least")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2
) -> DataFrame:
    """Id, fingerprint (hex) and component of every row.

    Rows whose fingerprints differ in at most ``distance`` bits are linked;
    the component is the least id reachable. NULL, empty and blank texts have
    fingerprint zero and are linked like any other. Repeated rows and ids each
    give a row. Rows without id take part and do not name a component; one of
    them alone has a NULL component. Other columns are ignored.
    """
    found = cut_lineage(fingerprints(docs, id, text, words).select(F.col(id).alias("_id"), "fp"))
    return found.join(_least_of_component(found, F.col("_id"), distance), "fp").select(
        F.col("_id").alias(id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def representatives(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2
) -> DataFrame:
    """``_id``, ``_key`` (of its text) and ``stays`` for every row.

    Of each component of ``near_duplicates`` one document stays: that of the
    least id, rows without id last, and the least text key under one id. Rows
    that agree in id and text are one document and stay or go together.
    """
    named = docs.select(
        F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), text_key(text).alias("key")).alias("_doc"),
        F.col(text).alias("_text"),
    )
    found = cut_lineage(fingerprints(named, "_doc", "_text", words))
    return found.join(_least_of_component(found, F.col("_doc"), distance), "fp").select(
        F.col("_doc.id").alias("_id"), F.col("_doc.key").alias("_key"), (F.col("_doc") == F.col("least")).alias("stays")
    )
