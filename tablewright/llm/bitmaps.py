"""Bit maps of a fixed size as filters in front of a join.

A map has 2**26 bits (8 MB) whatever it is made from, so it may be collected
and broadcast. Hashes that are not on it have no partner in the join; the
others may have one. A crowded map filters less and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BITS = 26


def bit_map(hashes: DataFrame, column: str = "h") -> np.ndarray:
    """Map of the leading bits of a 64-bit hash column."""
    # bucket numbers count from one for positive values, 32,768 bits in each
    slot = F.shiftrightunsigned(column, 64 - BITS) + 1
    rows = hashes.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    ).collect()
    out = np.zeros((1 << BITS) // 8, dtype=np.uint8)
    for row in rows:
        at = (row["bucket"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out


def on_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (unsigned) are on the map."""
    at = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def on_map_of(hashes: DataFrame, column: str = "h") -> Callable[[Column], Column]:
    """A test for columns of hashes: can the hash be among ``hashes``?"""
    shared = hashes.sparkSession.sparkContext.broadcast(bit_map(hashes, column))

    @F.arrow_udf("boolean")
    def listed(values: pa.Array) -> pa.Array:
        return pa.array(on_map(shared.value, values.to_numpy(zero_copy_only=False).view(np.uint64)))

    return listed


def text_key(text: str | Column) -> Column:
    """128 bits of SHA-256 of a text; NULL counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.substring(F.unhex(F.sha2(F.coalesce(column, F.lit("")), 256)), 1, 16)


def without(docs: DataFrame, gone: DataFrame, on: Mapping[str, Column]) -> DataFrame:
    """Rows of ``docs`` that are not in ``gone``; ``on`` gives for each column of ``gone`` its value in ``docs``.

    An anti-join in which missing values match each other. Rows that the bit
    map of ``gone`` rules out pass by without a shuffle.
    """
    listed = on_map_of(gone.select(F.xxhash64(*on).alias("h")))
    test = listed(F.xxhash64(*on.values()))
    # the row stays one column, so its names can't meet those used here
    rows = docs.where(test).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[value.alias(f"_on_{c}") for c, value in on.items()]
    )
    same = reduce(and_, [rows[f"_on_{c}"].eqNullSafe(gone[c]) for c in on])
    rest = rows.join(gone, same, "left_anti").select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
    return docs.where(~test).unionByName(rest)
