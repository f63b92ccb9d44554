"""Joins against per-key results that stay balanced when one key is hot.

A per-key result carries the number of rows behind each key. Keys holding at
least ``hot_share`` of all rows number at most ``1 / hot_share``, so that list
alone has a proven bound and may be broadcast. Rows of such a key are spread
over sub-keys in proportion to its share of the shuffle partitions; rows whose key is
NULL have no partner and pass by the join. All other rows join on the plain
key, and Spark still picks the join strategy from the measured sizes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

# both shape the plan only
HOT_SHARE = 1 / 256
SUB_KEYS = 8  # per shuffle partition's worth of a hot key, so that hashing them evens out


def row_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """Deterministic 64-bit hash of the row key, so a retried task gives the same value."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns], F.lit(seed))


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    weight: str,
    row_key: Sequence[str],
    how: str = "left",
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Join ``lookup`` (one row per key, ``weight`` = fact rows of the key) to ``fact``.

    ``row_key`` names columns that tell the rows of a hot key apart. ``how`` is
    left or inner.
    """
    on = list(on)
    partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    share = F.col(weight) / lookup.agg(F.sum(weight)).scalar()
    fan = F.when(share >= hot_share, F.ceil(share * partitions * SUB_KEYS)).otherwise(F.lit(1))
    fanned = lookup.withColumn("_fan", fan.cast("bigint"))
    hot = fanned.where("_fan > 1").select(*on, "_fan")
    any_null = reduce(or_, [F.col(f"`{k}`").isNull() for k in on])
    salted_fact = (
        fact.where(~any_null).join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.pmod(row_hash(row_key), F.coalesce("_fan", F.lit(1).cast("bigint"))))
        .drop("_fan")
    )
    salted_lookup = fanned.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_fan") - 1))
    ).drop("_fan")
    joined = salted_fact.join(salted_lookup, [*on, "_salt"], how).drop("_salt")
    if how == "inner":
        return joined
    added = {f.name: F.lit(None).cast(f.dataType) for f in lookup.schema if f.name not in on}
    return joined.unionByName(fact.where(any_null).withColumns(added))


def key_counts(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Rows per non-NULL key, combined before the shuffle."""
    keys = list(keys)
    present = reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def with_key_count(
    df: DataFrame, keys: Sequence[str], row_key: Sequence[str], out: str = "n"
) -> DataFrame:
    """Every row with the number of rows sharing its key; NULL for a missing key."""
    return lookup_join(df, key_counts(df, keys, out), keys, out, row_key)
