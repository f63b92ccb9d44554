"""Prefix trie of conversations by whole-sequence collapse.

A node of the trie is the set of conversations that begin with the same turns.
Identical conversations are collapsed into one sequence with a weight and the
list of those that end there. A sequence that is a proper prefix of another one
is dropped by an anti-join; the others are the leaves. Every figure of a node is
then a sum over weighted prefixes, without walking up the tree:

* Each turn has a hash that includes its place; the hash of a prefix is the XOR
  of its turns, so it runs along a conversation of any length in slices.
* Each node belongs to the first leaf below it. The nodes of a leaf are the
  lower end of its path, so the words of the different nodes below a node are
  those of its leaves, with the node's own leaf counted from the node on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.order import in_slices, running
from tablewright.operators.skew import lookup_join
from tablewright.session import cut_lineage

WORDS = "[^\\x20\\x09-\\x0D]+"
NODE = ["depth", "a", "b"]


def _digest(role: str, text: str) -> Column:
    speaker, body = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    return F.unhex(F.sha2(F.concat(F.octet_length(speaker).cast("string"), F.lit(":"), speaker, body), 256))


def turns(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Stored: ``conv``, ``turn``, digest and number of words of every turn, texts left behind.

    Missing roles and texts count as empty. Rows without conversation belong
    to none and are left out.
    """
    return cut_lineage(rows.where(F.col(id).isNotNull()).select(
        F.col(id).alias("conv"), F.col(turn).alias("turn"), _digest(role, text).alias("digest"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORDS)).cast("bigint").alias("words"),
    ))


def in_order(found: DataFrame) -> DataFrame:
    """Stored: the turns of every conversation with their ``place`` from one: NULL first, ties by digest."""
    order = ["turn", "digest"]
    return cut_lineage(running(
        in_slices(found, ["conv"], order), ["conv"], order, {"place": ("sum", F.lit(1).cast("bigint"))}
    ))


def with_openings(placed: DataFrame, every: int, most: int, taken: Column) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations and their turns.

    Of each conversation the first ``taken`` turns (an expression over ``conv``,
    at most ``most``) give way to as many of the conversation whose id it
    reaches by taking off its remainder by ``every``; where that one is absent
    they just go. Returns all conversations (``conv``) and their turns (conv,
    depth, digest, words).
    """
    convs = cut_lineage(placed.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumns({
        "h": taken.cast("bigint"), "base": F.col("conv") - F.col("conv") % every,
    }))
    of_base = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    shift = convs.join(of_base, "base", "left").select(
        "conv", "n", "h", "base", F.least("h", F.coalesce("base_n", F.lit(0))).alias("opening")
    )
    shift = cut_lineage(shift)
    openings = (
        placed.where(F.col("place") <= most).withColumnRenamed("conv", "base")
        .join(shift.select("conv", "base", "h"), "base").where("place <= h")
        .select("conv", F.col("place").alias("depth"), "digest", "words")
    )
    # only turns that have moved need the join
    own = lookup_join(
        placed.where(F.col("place") > taken), shift.select("conv", "n", "h", "opening"), ["conv"], "n", ["place"], how="inner"
    ).select("conv", (F.col("place") - F.col("h") + F.col("opening")).alias("depth"), "digest", "words")
    return convs.select("conv"), openings.unionByName(own)


def _hashes() -> dict[str, Column]:
    return {"ha": F.xxhash64("depth", "digest"), "hb": F.xxhash64("digest", "depth", F.lit(7))}


def ends(members: DataFrame) -> DataFrame:
    """Per sequence (len, a, b): digest of the ids of its conversations, ascending and joined by commas.

    The ids of a sequence are hashed as they stream by in order, so a list of
    any length takes no memory.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running_digest = None, None
        for batch in batches:
            done = []
            for n, a, b, conv in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (n, a, b) != key:
                    if key is not None:
                        done.append((*key, running_digest.hexdigest()))
                    key, running_digest = (n, a, b), hashlib.sha256()
                else:
                    running_digest.update(b",")
                running_digest.update(conv.encode())
            yield _ended(done)
        if key is not None:
            yield _ended([(*key, running_digest.hexdigest())])

    dealt = members.repartition("len", "a", "b").sortWithinPartitions("len", "a", "b", "conv")
    return dealt.select("len", "a", "b", F.col("conv").cast("string")).mapInArrow(
        work, "len bigint, a bigint, b bigint, ends_sha256 string"
    )


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["len", "a", "b", "ends_sha256"]
    )


def prefix_trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """All nodes of the trie over ``rows`` (conv, depth from one without gaps, digest, words).

    ``convs`` has one row per conversation (``conv``, never NULL), those without
    turns included; they end at the root. Per node: ``conv_id`` (the least
    member), ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes below it or itself),
    ``saved_tokens`` and ``ends_sha256``. What is saved at a node are the words
    of its last turn for all members but one, and ``saved_tokens`` sums that
    over the node and all below it. No conversations give no nodes, not even
    the root. Turns are compared by 128 bits of hashes.
    """
    rows = cut_lineage(rows.withColumns(_hashes()))
    path = cut_lineage(running(in_slices(rows, ["conv"], ["depth"]), ["conv"], ["depth"], {
        "a": ("xor", F.col("ha")), "b": ("xor", F.col("hb")), "upto": ("sum", F.col("words")),
    }))
    zero = F.lit(0).cast("bigint")
    wholes = rows.groupBy("conv").agg(
        F.count(F.lit(1)).alias("len"), F.bit_xor("ha").alias("a"), F.bit_xor("hb").alias("b"), F.sum("words").alias("total")
    )
    members = cut_lineage(convs.join(wholes, "conv", "left").select(
        "conv", *[F.coalesce(c, zero).alias(c) for c in ("len", "a", "b", "total")]
    ))

    # whole-sequence collapse
    sequences = cut_lineage(members.groupBy("len", "a", "b").agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("weight"), F.min("total").alias("total")
    ))
    of_rep = sequences.where("len > 0").select(F.col("rep").alias("conv"), "len", "weight", "total")
    prefixes = cut_lineage(
        lookup_join(path, of_rep, ["conv"], "len", ["depth"], how="inner").select(
            "depth", "a", "b", F.col("a").bitwiseXOR(F.col("ha")).alias("up_a"), F.col("b").bitwiseXOR(F.col("hb")).alias("up_b"),
            "words", (F.col("upto") - F.col("words")).alias("before"), F.col("conv").alias("rep"), "len", "weight", "total",
        ).unionByName(sequences.select(
            zero.alias("depth"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("bigint").alias("up_a"),
            F.lit(None).cast("bigint").alias("up_b"), zero.alias("words"), zero.alias("before"), "rep", "len", "weight", "total",
        ))
    )

    # leaves: sequences that are no proper prefix of another one
    proper = prefixes.where("depth < len").select(F.col("depth").alias("len"), "a", "b").distinct()
    leaves = cut_lineage(sequences.join(proper, ["len", "a", "b"], "left_anti").select("rep", "len"))
    below = cut_lineage(lookup_join(
        prefixes.select(*NODE, "words", "rep", "total"), leaves.withColumn("weight", F.col("len") + 1).drop("len"),
        ["rep"], "weight", NODE, how="inner",
    ).drop("weight"))

    # each node belongs to its first leaf, whose nodes have so many words
    owned = cut_lineage(
        below.groupBy(*NODE).agg(F.min("rep").alias("rep"), F.min("words").alias("words"))
        .groupBy("rep").agg(F.sum("words").alias("owned"), F.count(F.lit(1)).alias("n"))
        .join(leaves, "rep", "right").select("rep", F.coalesce("owned", zero).alias("owned"), (F.col("len") + 1).alias("n"))
    )
    under = lookup_join(below, owned, ["rep"], "n", NODE, how="inner").groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_leaves"), F.sum("owned").alias("owned"),
        F.min(F.struct("rep", "total", F.col("owned").alias("of"))).alias("first"),
    )
    weighted = prefixes.groupBy(*NODE).agg(
        F.sum("weight").alias("n_convs"), F.min("rep").alias("conv_id"), F.min("before").alias("before"),
        F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"), F.sum(F.col("weight") * F.col("total")).alias("all_words"),
    )
    different = F.col("owned") - F.col("first.of") + F.col("first.total") - F.col("before")
    nodes = cut_lineage(weighted.join(under, NODE).select(
        *NODE, "up_a", "up_b", "conv_id", "n_convs", "n_leaves",
        (F.col("all_words") - F.col("n_convs") * F.col("before") - different).alias("saved_tokens"),
    ))

    up = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    children = nodes.where("depth > 0").select(*up).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    counted = cut_lineage(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)))
    parents = counted.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_weight"),
    )
    named = lookup_join(counted, parents, ["depth", "up_a", "up_b"], "_weight", ["a", "b"])
    ended = ends(members).withColumnRenamed("len", "depth")
    return named.join(ended, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def with_last_turns(
    nodes: DataFrame, rows: DataFrame, conversations: DataFrame, role: str = "role", text: str = "text"
) -> DataFrame:
    """``nodes`` with ``role`` and ``text`` of their last turn; the root has none.

    ``rows`` are those the trie was made of and ``conversations`` the table
    they come from. Each different turn is looked up once.
    """
    texts = conversations.groupBy(_digest(role, text).alias("digest")).agg(
        F.min(F.struct(F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))).alias("_turn")
    )
    last = rows.select(F.col("conv").alias("conv_id"), "depth", "digest")
    return nodes.join(last, ["conv_id", "depth"], "left").join(texts, "digest", "left").select(
        *nodes.columns, "_turn.role", "_turn.text"
    )
