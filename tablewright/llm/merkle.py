"""Merkle manifest of a dataset: leaf digests, subroots, root and a proof for every row.

Trees are worked off by time-forward processing: a node sends its digest as a
message to its parent, and messages are taken in the order of the receiving
node's label (level, then place). The queue that holds them is external: rows
are cut into blocks of 729 neighbours, whole subtrees of six levels, Spark's
shuffle brings the messages of a block together, and inside a block a heap
delivers them label by label. The block roots are the messages of the next
round, so a tree of n leaves takes log(n) to the base 729 rounds. A reversed
sweep goes through the same rounds from the root down: every node receives the
rest of the proof from its parent, puts its own siblings in front and passes
that on. No block holds more than 729 nodes, whatever the size of a source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablewright.llm.order import in_slices, running
from tablewright.session import cut_lineage

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# levels of a block; shapes the plan only
LEVELS = 6

STEP = pa.struct([("before", pa.string()), ("after", pa.string())])
PROOF = T.ArrayType(T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())]))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 over all values: a dash for NULL, else byte count, colon and the value as text."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf leads to with the siblings of a proof."""
    return F.aggregate(proof, leaf, lambda d, step: F.sha2(F.concat(step["before"], d, step["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 over all siblings of a proof, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def sweep(digests: Sequence[str], levels: int) -> list[list[str]]:
    """Digests of all nodes over neighbouring ones, by level; ``levels`` levels above them."""
    out = [list(digests)]
    # messages: label of the receiver, place among its children, digest
    queue = [((1, i // ARITY), i % ARITY, d) for i, d in enumerate(digests)]
    heapify(queue)
    while queue and queue[0][0][0] <= levels:
        level, index = label = queue[0][0]
        children = []
        while queue and queue[0][0] == label:
            children.append(heappop(queue)[2])
        made = hashlib.sha256("".join(children).encode()).hexdigest()
        if level == len(out):
            out.append([])
        out[level].append(made)
        heappush(queue, ((level + 1, index // ARITY), index % ARITY, made))
    return out


def alone_at(levels: list[list[str]]) -> int:
    """The first level with a single node, where a tree of one block ends."""
    return next(i for i, nodes in enumerate(levels) if len(nodes) == 1)


def proofs(levels: list[list[str]], rest: list) -> list[list]:
    """Siblings (before, after) from each node of the lowest level up, followed by ``rest``."""
    paths = [rest]
    for nodes in reversed(levels[:-1]):
        below = []
        for i, _ in enumerate(nodes):
            first, place = i - i % ARITY, i % ARITY
            run = nodes[first:first + ARITY]
            below.append([("".join(run[:place]), "".join(run[place + 1:])), *paths[i // ARITY]])
        paths = below
    return paths


def _by_place(table: pa.Table) -> pa.Table:
    return table.sort_by("pos").combine_chunks()


def _block(levels: int) -> Column:
    return F.call_function("div", "pos", F.lit(ARITY**levels)).alias("block")


def _up(nodes: DataFrame, height: int) -> DataFrame:
    """Per block of ``nodes`` (tree, pos, digest): the digest if the tree ends in it, and the one if it goes on."""
    def work(key: tuple, block: pa.Table) -> pa.Table:
        levels = sweep(_by_place(block)["digest"].to_pylist(), height)
        return pa.table({
            "tree": pa.array([key[0].as_py()], pa.string()), "pos": pa.array([key[1].as_py()], pa.int64()),
            "alone": [levels[alone_at(levels)][0]], "full": [levels[-1][0]],
        })

    placed = nodes.select("tree", _block(height), "pos", "digest")
    return placed.groupBy("tree", "block").applyInArrow(work, "tree string, pos bigint, alone string, full string")


def _down(nodes: DataFrame, tops: DataFrame, height: int) -> DataFrame:
    """``nodes`` with proof and subroot, from those of their blocks (tree, pos, proof, subroot, alone)."""
    schema = T.StructType([*nodes.schema.fields, T.StructField("proof", PROOF), T.StructField("subroot", T.StringType())])

    def work(block: pa.Table, top: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({f.name: pa.array([], t) for f, t in zip(schema.fields, types)})
        block = _by_place(block)
        levels = sweep(block["digest"].to_pylist(), height)
        if top["alone"][0].as_py():
            levels = levels[:alone_at(levels) + 1]
        rest = [(s["before"], s["after"]) for s in top["proof"][0].as_py()]
        found = proofs(levels, rest)
        offsets = [0]
        for p in found:
            offsets.append(offsets[-1] + len(p))
        steps = pa.StructArray.from_arrays([
            pa.array([s[0] for p in found for s in p], pa.string()), pa.array([s[1] for p in found for s in p], pa.string()),
        ], ["before", "after"])
        proof = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps)
        subroot = pa.array([top["subroot"][0].as_py()] * len(found), pa.string())
        return pa.table([*[block[c] for c in names], proof, subroot], [*names, "proof", "subroot"])

    names = nodes.columns
    types = [pa.null()] * len(names) + [pa.list_(STEP), pa.string()]
    placed = nodes.select("*", _block(height)).groupBy("tree", "block")
    return placed.cogroup(tops.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInArrow(work, schema)


def _forward(leaves: DataFrame, height: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Sweep up: the nodes of every round, and for every round the trees (tree, digest) that end in it."""
    rounds, ended = [leaves], []
    while True:
        blocks = cut_lineage(_up(rounds[-1], height))
        more = blocks.where("pos > 0").select("tree").distinct()
        ended.append(blocks.join(more, "tree", "left_anti").select("tree", F.col("alone").alias("digest")))
        if blocks.where("pos > 0").isEmpty():
            return rounds, ended
        rounds.append(cut_lineage(blocks.join(more, "tree", "left_semi").select("tree", "pos", F.col("full").alias("digest"))))


def _backward(rounds: list[DataFrame], ended: list[DataFrame], roots: DataFrame, height: int) -> DataFrame:
    """Sweep down: the leaves with proof and subroot; ``roots`` (tree, proof) has the rest of the proofs."""
    found = None
    for nodes, trees in reversed(list(zip(rounds, ended))):
        tops = trees.join(roots, "tree").select(
            "tree", F.lit(0).cast("bigint").alias("pos"), "proof", F.col("digest").alias("subroot"), F.lit(True).alias("alone")
        )
        if found is not None:
            tops = tops.unionByName(cut_lineage(
                found.select("tree", "pos", "proof", "subroot", F.lit(False).alias("alone"))
            ))
        found = _down(nodes, tops, height)
    return found


def _placed(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows``, stored, with their place from zero."""
    sliced = in_slices(rows, keys, order)
    return cut_lineage(running(sliced, keys, order, {"pos": ("sum", F.lit(1).cast("bigint"))}).withColumn("pos", F.col("pos") - 1))


def manifest(
    docs: DataFrame, id: str = "doc_id", source: str = "source", fields: Sequence[str] = FIELDS,
    carry: Mapping[str, Column] | None = None, levels: int = LEVELS,
) -> DataFrame:
    """Per row: id, ``leaf``, ``subroot`` (of its source), ``root`` and ``proof``.

    The proof lists the siblings from the leaf up to the root as texts
    ``before`` and ``after`` it; ``fold`` leads from a leaf to the root.
    ``carry`` names further expressions over ``docs`` to hand through. Leaves
    of a source ascend by id, missing ids first, rows of one id by their
    digest; sources ascend by their bytes, a missing one (a source of its own)
    first. Rows that agree in all fields are leaves of their own with equal
    digests. A single leaf is the root of its source, a single source's subroot
    is the root. An empty table gives no rows. Columns that are neither fields
    nor carried are ignored. ``levels`` is the height of a block.
    """
    carried = {f"carry_{i}": column.alias(f"carry_{i}") for i, column in enumerate((carry or {}).values())}
    name = F.col(source).cast("string")
    leaves = cut_lineage(docs.select(
        F.when(name.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), name)).alias("tree"),
        F.col(id).alias("id"), leaf_digest([F.col(f) for f in fields]).alias("digest"), *carried.values(),
    ))
    rounds, ended = _forward(_placed(leaves, ["tree"], ["id", "digest"]), levels)
    subroots = ended[0]
    for trees in ended[1:]:
        subroots = subroots.unionByName(trees)
    sources = _placed(subroots.select(F.col("tree").alias("of"), "digest"), [], ["of"])
    upper, top = _forward(sources.select(F.lit("").alias("tree"), "of", "pos", "digest"), levels)
    root = cut_lineage(top[-1])
    none = F.array().cast(PROOF)
    to_root = cut_lineage(
        _backward(upper, top, root.select("tree", none.alias("proof")), levels).select(F.col("of").alias("tree"), "proof")
    )
    found = _backward(rounds, ended, to_root, levels)
    return found.select(
        F.col("id").alias(id), F.col("digest").alias("leaf"), "subroot",
        root.select(F.max("digest")).scalar().alias("root"), "proof",
        *[F.col(inside).alias(outside) for inside, outside in zip(carried, carry or {})],
    )


def verify(
    docs: DataFrame, known: DataFrame, id: str = "doc_id", fields: Sequence[str] = FIELDS
) -> DataFrame:
    """Hold a table against a stored manifest: per id the rows ``expected``, ``present`` and ``verified``.

    A row is verified if its leaf leads to the manifest's root with the proof
    of a row of its id; each proof counts once. Ids of either side are listed,
    a missing id like any other.
    """
    now = docs.groupBy(F.col(id).alias("id"), leaf_digest([F.col(f) for f in fields]).alias("leaf")).agg(F.count(F.lit(1)).alias("present"))
    # proofs are folded first, so only digests meet; rows of one id and digest are interchangeable
    sound = fold(F.col("leaf"), F.col("proof")) == F.col("root")
    then = known.groupBy(F.col(id).alias("id"), "leaf").agg(
        F.count(F.lit(1)).alias("expected"), F.count_if(sound).alias("sound")
    )
    both = now.select("id", "leaf", "present", F.lit(0).alias("expected"), F.lit(0).alias("sound")).unionByName(
        then.select("id", "leaf", F.lit(0).alias("present"), "expected", "sound")
    ).groupBy("id", "leaf").agg(F.sum("present").alias("present"), F.sum("expected").alias("expected"), F.sum("sound").alias("sound"))
    return both.groupBy("id").agg(
        F.sum("expected").alias("expected"), F.sum("present").alias("present"), F.sum(F.least("present", "sound")).alias("verified")
    ).withColumnRenamed("id", id)
