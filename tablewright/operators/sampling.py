"""Exact, reproducible per-stratum samples by hash order.

Rows of a stratum are ordered by a seeded hash of their id. The hash range is
cut into equal slices, so only the slice in which a quota ends has to be
sorted; every other row is decided by its slice alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.operators.ordered import number_rows
from tablewright.operators.skew import lookup_join, row_hash
from tablewright.session import cut_lineage


def hash_bits(df: DataFrame) -> int:
    """Leading hash bits that name a slice: 64 slices per shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, partitions.bit_length() + 6)


def hash_key(ids: Sequence[str], seed: int) -> Column:
    return row_hash(ids, seed)


def largest_remainder(counts: DataFrame, stratum: str, n: str, size: Column, out: str) -> DataFrame:
    """Share ``size`` over strata in proportion to ``n``; largest remainders get the rest.

    ``counts`` has one row per stratum. There may be very many strata: sums are
    scalar subqueries and the order of the remainders is cut into slices.
    """
    # stored, so that the sums, the order and the result read one table
    shared = cut_lineage(counts.withColumn("_size", size))
    exact = F.col(n) * F.col("_size") / shared.agg(F.sum(n)).scalar()
    parts = shared.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact"))
    # ascending order of the negative remainder is descending order of the remainder
    parts = parts.withColumn("_rem", F.col("_floor") - F.col("_exact"))
    short = F.col("_size") - parts.agg(F.sum("_floor")).scalar()
    return (
        number_rows(parts, "_rem", "_place", tie=[stratum])
        .withColumn(out, F.col("_floor") + (F.col("_place") <= short).cast("bigint"))
        .drop("_size", "_exact", "_floor", "_rem", "_place")
    )


def assign_by_quota(
    df: DataFrame,
    ids: Sequence[str],
    stratum: str,
    quotas: DataFrame,
    parts: Sequence[str],
    rest: str,
    seed: int = 42,
    out: str = "split",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Give the first rows of each stratum, in hash order, to ``parts`` in turn.

    ``quotas`` has one row per stratum with one column of sizes per part;
    rows beyond all quotas get ``rest``. Quota columns in ``keep`` stay on the rows.
    """
    keyed = df.where(F.col(stratum).isNotNull()).withColumn("_h", hash_key(ids, seed)).withColumn(
        "_slice", F.shiftright(F.col("_h"), 64 - hash_bits(df))
    )
    per_slice = keyed.groupBy(stratum, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    # one row per slice and stratum
    upto = Window.partitionBy(stratum).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        per_slice.withColumn("_end", F.sum("_n").over(upto))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .join(quotas.select(stratum, *parts, *keep), stratum)
    )
    limits, limit = [], F.lit(0).cast("bigint")
    for part in parts:
        limit = limit + F.col(part)
        limits.append(limit)
    # the slice in which each limit is passed, and where that slice starts
    passed = [
        F.min(F.when(F.col("_end") > upper, F.struct("_slice", "_start"))).alias(f"_t{j}")
        for j, upper in enumerate(limits)
    ]
    # stored: one row per stratum, which the join reads several times
    lookup = cut_lineage(ends.groupBy(stratum, *parts, *keep).agg(F.sum("_n").alias("_rows"), *passed).withColumnsRenamed(
        {part: f"_q{j}" for j, part in enumerate(parts)}
    ))
    rows = lookup_join(keyed, lookup, [stratum], "_rows", ids, "inner")
    upper, beyond, split_at, sizes = F.lit(0).cast("bigint"), [], [], []
    for j in range(len(parts)):
        upper = upper + F.col(f"_q{j}")
        spot = F.col(f"_t{j}")
        here = F.col("_slice") == spot["_slice"]
        sizes.append(upper)
        beyond.append(F.coalesce((F.col("_slice") > spot["_slice"]) | (here & (spot["_start"] >= upper)), F.lit(False)))
        split_at.append(F.coalesce(here & (spot["_start"] < upper), F.lit(False)))
    settled_part, ranked_part = F.lit(rest), F.lit(rest)
    start, undecided = F.lit(None).cast("bigint"), F.lit(False)
    for j in reversed(range(len(parts))):
        settled_part = F.when(~beyond[j], F.lit(parts[j])).otherwise(settled_part)
        ranked_part = F.when(F.col("_rank") <= sizes[j], F.lit(parts[j])).otherwise(ranked_part)
        start = F.when(split_at[j], F.col(f"_t{j}")["_start"]).otherwise(start)
        undecided = undecided | split_at[j]
    columns = [*df.columns, *keep, out]
    settled = rows.where(~undecided).withColumn(out, settled_part)
    order = Window.partitionBy(stratum, "_slice").orderBy("_h", *ids)
    ranked = (
        rows.where(undecided)
        .withColumn("_rank", start + F.row_number().over(order))
        .withColumn(out, ranked_part)
    )
    return settled.select(*columns).unionByName(ranked.select(*columns))


def sample_quota(
    df: DataFrame, ids: Sequence[str], stratum: str, quotas: DataFrame, size: str, seed: int = 42
) -> DataFrame:
    """Exactly ``size`` rows of each stratum (all of them where it has fewer)."""
    taken = assign_by_quota(df, ids, stratum, quotas, [size], "_rest", seed, "_take")
    return taken.where(F.col("_take") == size).drop("_take")
