"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets: all words are shared over the sources by weight; no source gets more
than ``most`` times its own words, what it leaves goes to the others by weight.
Seats: every source is cut into blocks of (nearly) ``block`` words. A seat is
one reading of one block. Seats go to the highest quotients votes / (2 s + 1),
where a source's votes are the readings its target asks for; quotients a shard's
worth of seats apart cut them into shards, each with an integer quota per source. Blocks: a
source's documents stand in the order of a seeded hash, and a seeded walk over
its blocks says which block each of its seats reads.

Everything is a DataFrame expression. Orders are cut into slices, so no window
holds a whole source.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.operators.ordered import running_totals
from tablewright.session import cut_lineage

BLOCK = 32  # words
SHARD = 4096  # seats
MOST = 3
SEED = 42
# primes of which one at least doesn't divide a count of blocks below 2**58
STEPS = (1_000_003, 1_000_033, 1_000_037)


class Mix(NamedTuple):
    documents: DataFrame
    sources: DataFrame
    shards: DataFrame


def _bits(df: DataFrame) -> int:
    """Leading hash bits that name a slice of a source: 16 slices per shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(6, partitions.bit_length() + 4)


def _numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Numbers from 0 in the given order; the order is cut by a range shuffle."""
    parts = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    # one row per partition of the shuffle
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    return parts.join(starts, "_part").withColumn(
        out, F.col("_start") + F.row_number().over(inside) - 1
    ).drop("_part", "_start")


def targets(totals: DataFrame, most: int = MOST) -> DataFrame:
    """Add ``target`` to rows of source, ``source_size`` and ``weight``.

    Sharing by weight, stopping at a cap and sharing the excess again ends at one
    level per unit of weight, below which all uncapped sources stand. With the
    sources in order of cap per weight, the level is that of the first source
    which a common level of it and all later ones does not lift above its cap.
    """
    caps = totals.withColumn("_cap", F.col("source_size") * most).withColumn(
        "_ratio", F.col("_cap") / F.col("weight")
    )
    run = running_totals(caps, "_ratio", ["_cap", "weight", "source_size"], tie=["rank"])
    level = (F.col("source_size_total") - (F.col("_cap_cum") - F.col("_cap"))) / (
        F.col("weight_total") - (F.col("weight_cum") - F.col("weight"))
    )
    found = run.withColumn("_level", level).where("_level <= _ratio").agg(F.min_by("_level", "_ratio")).scalar()
    return caps.withColumn(
        "target", F.least(F.col("_cap").cast("double"), F.coalesce(found, F.lit(0.0)) * F.col("weight"))
    ).drop("_cap", "_ratio")


def _seats_before(x: Column) -> Column:
    """How many seats of a source have (2 s + 1) / votes below ``x``."""
    return F.greatest(F.ceil((F.col("votes") * x - 1) / 2), F.lit(0)).cast("bigint")


def _whole_shards(voting: DataFrame, shard: int) -> tuple[Column, Column, Column]:
    """Sum of votes, seats to give, and shards that surely lie before the last seat."""
    # a sum of decimals doesn't depend on the order of addition
    total = voting.agg(F.sum(F.col("votes").cast("decimal(28,6)"))).scalar().cast("double")
    n = voting.agg(F.count(F.lit(1))).scalar()
    seats = F.round(total)
    return total, seats, F.greatest(F.floor((seats - n / 2 - 1) / shard), F.lit(0))


def apportion(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """Seats of every source: rank, quota.

    ``sources`` has rank and votes (readings of blocks asked for). As many seats
    are given as votes sum up to, rounded, to the highest quotients
    votes / (2 s + 1); ties go to the lower rank. Before any quotient a source
    has its share of seats, rounded, so the seats of all whole shards are
    counted, not listed; only those of the last one are put in order.
    """
    voting = sources.where("votes > 0")
    total, seats, whole = _whole_shards(voting, shard)
    n = voting.agg(F.count(F.lit(1))).scalar()
    counted = cut_lineage(voting.select(
        "rank", "votes", _seats_before(whole * 2 * shard / total).alias("_sure"),
        _seats_before((seats + n / 2 + 1) * 2 / total).alias("_most"), seats.cast("bigint").alias("_all"),
    ))
    left = counted.agg(F.max("_all") - F.sum("_sure")).scalar()
    listed = counted.where("_most > _sure").select(
        "rank", "votes", F.explode(F.sequence(F.col("_sure"), F.col("_most") - 1)).alias("_seat")
    ).withColumn("_order", (2 * F.col("_seat") + 1) / F.col("votes"))
    # about one shard and a seat or two per source
    more = _numbered(listed, [F.col("_order"), F.col("rank")], "_place").where(F.col("_place") < left).groupBy(
        "rank"
    ).agg(F.count(F.lit(1)).alias("_more"))
    return counted.join(more, "rank", "left").select(
        "rank", (F.col("_sure") + F.coalesce("_more", F.lit(0))).alias("quota")
    )


def shard_quotas(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """Integer quota of every source in every shard: rank, shard, quota; zero quotas are left out.

    ``sources`` has rank, votes and quota. A shard is what lies between two
    quotients that are ``shard`` seats of the whole apart; the last one takes the rest.
    """
    voting = sources.where("votes > 0")
    total, _, whole = _whole_shards(voting, shard)

    def before(number: Column) -> Column:
        return F.when(number > F.col("_whole"), F.col("quota")).otherwise(
            _seats_before(number * 2 * shard / F.col("_total"))
        )

    return (
        voting.select("rank", "votes", "quota", whole.cast("bigint").alias("_whole"), total.alias("_total"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_whole"))))
        .select("rank", "shard", (before(F.col("shard") + 1) - before(F.col("shard"))).alias("quota"))
        .where("quota > 0")
    )


def _taken() -> Column:
    """Words of a document under all readings of its blocks.

    Words ``_from`` to ``_to`` of the source's stream; the first ``_longer``
    blocks hold ``_base + 1`` words, the others ``_base``.
    """
    head = F.col("_longer") * (F.col("_base") + 1)

    def block_of(word: Column) -> Column:
        # integer division throughout
        return F.when(word < head, F.call_function("div", word, F.col("_base") + 1)).otherwise(
            F.col("_longer") + F.call_function("div", word - head, F.greatest(F.col("_base"), F.lit(1)))
        )

    def begin(block: Column) -> Column:
        return block * F.col("_base") + F.least(block, F.col("_longer"))

    def words(done: Column, block: Column) -> Column:
        inside = F.least(begin(block + 1), F.col("_to")) - F.greatest(begin(block), F.col("_from"))
        place = F.pmod(block * F.col("_step") + F.col("_shift"), F.col("_blocks"))
        readings = F.when(place < F.col("_quota"), F.call_function("div", F.col("_quota") - 1 - place, F.col("_blocks")) + 1).otherwise(F.lit(0))
        return done + inside * readings

    zero = F.lit(0).cast("bigint")
    return F.when(F.col("size") == 0, zero).otherwise(
        F.aggregate(F.sequence(block_of(F.col("_from")), block_of(F.col("_to") - 1)), zero, words)
    )


def mix(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
    block: int = BLOCK, shard: int = SHARD, most: int = MOST, seed: int = SEED,
) -> Mix:
    """Documents with the words taken of each, sources with their targets, quotas per shard.

    Sizes count words between blanks; a NULL or empty text has none and nothing
    is taken of it. Sources stand in code point order, a missing source last,
    and weigh 1, 2, 3, 1, ... Repeated rows and ids count each for themselves
    and NULL ids are allowed; rows that agree in id and size may trade places.
    A source without words has target zero. Other columns are ignored.
    """
    sized = cut_lineage(docs.select(
        F.col(id).alias("_id"), F.col(source).alias("_source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint").alias("size"),
    ))
    key = F.coalesce(F.concat(F.lit("s"), F.col("_source").cast("string")), F.lit("n"))
    totals = sized.groupBy(key.alias("_key"), "_source").agg(F.sum("size").alias("source_size"))
    ranked = _numbered(
        totals, [F.col("_source").isNull().asc(), F.col("_source").asc()], "rank"
    ).withColumn("weight", 1 + F.col("rank") % 3)
    blocks = F.ceil(F.col("source_size") / block).cast("bigint")
    sources = cut_lineage(
        targets(ranked, most)
        .withColumn("_blocks", blocks)
        .withColumn("votes", F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * F.col("_blocks"), 6)).otherwise(0.0))
    )
    sources = cut_lineage(sources.join(apportion(sources, shard), "rank", "left").withColumn(
        "quota", F.least(F.coalesce("quota", F.lit(0)), most * F.col("_blocks"))
    ))
    step = F.when(F.col("_blocks") % STEPS[0] != 0, STEPS[0]).when(F.col("_blocks") % STEPS[1] != 0, STEPS[1]).otherwise(STEPS[2])
    ready = sources.select(
        "_key", "source_size", "target", "_blocks", F.col("quota").alias("_quota"),
        F.expr("source_size div greatest(_blocks, 1)").alias("_base"),
        (F.col("source_size") % F.greatest(F.col("_blocks"), F.lit(1))).alias("_longer"),
        step.cast("bigint").alias("_step"),
        F.pmod(F.xxhash64("_key", F.lit(seed)), F.greatest(F.col("_blocks"), F.lit(1))).alias("_shift"),
    )
    hashed = sized.withColumn("_key", key).withColumn("_h", F.xxhash64("_id", F.lit(seed))).withColumn(
        "_slice", F.shiftright("_h", 64 - _bits(docs))
    )
    upto = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = hashed.groupBy("_key", "_slice").agg(F.sum("size").alias("_n")).select(
        "_key", "_slice", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_start")
    ).join(ready, "_key")
    inside = Window.partitionBy("_key", "_slice").orderBy("_h", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        hashed.withColumn("_end", F.sum("size").over(inside))
        .join(slices, ["_key", "_slice"])
        .withColumn("_to", F.col("_start") + F.col("_end"))
        .withColumn("_from", F.col("_to") - F.col("size"))
    )
    out = placed.select(
        F.col("_id").alias(id), F.col("_source").alias(source), "size", "source_size", "target", _taken().alias("taken")
    )
    named = sources.select(F.col("_source").alias(source), "rank", "weight", "source_size", "target", "votes", "quota")
    return Mix(out, named, shard_quotas(named, shard))
