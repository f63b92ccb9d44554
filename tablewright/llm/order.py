"""Running figures over an order, also where one key holds most of the rows.

Rows are dealt into slices by ranges of (keys, order) and stored, so that a
slice keeps its number whatever is recomputed. Inside a slice a window runs;
what earlier slices of the same key add is joined on. A key that reaches into
a further slice crosses the border between two slices, and a border is crossed
by one key, so the joined table has fewer rows than there are slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.operators.ordered import slice_count
from tablewright.session import cut_lineage

FIGURES = {
    "sum": (F.sum, lambda a, b: a + b),
    "xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b)),
}


def in_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df``, stored, with the number of its slice: ranges of ``keys`` and then ``order``, NULL first."""
    dealt = df.repartitionByRange(slice_count(df), *keys, *order)
    return cut_lineage(dealt.withColumn("_slice", F.spark_partition_id()))


def running(
    sliced: DataFrame, keys: Sequence[str], order: Sequence[str], figures: Mapping[str, tuple[str, Column]]
) -> DataFrame:
    """Inclusive running figures per key; ``figures`` maps a name to "sum" or "xor" and what goes in.

    Keys are never NULL, and neither is what goes in. Rows that tie in
    ``order`` are interchangeable.
    """
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.select("*", *[FIGURES[how][0](c).over(inside).alias(name) for name, (how, c) in figures.items()])
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        sliced.groupBy(*keys, "_slice").agg(*[FIGURES[how][0](c).alias(name) for name, (how, c) in figures.items()])
        .select(*keys, "_slice", *[FIGURES[how][0](name).over(before).alias(f"_b_{name}") for name, (how, _) in figures.items()])
        .where(F.col(f"_b_{next(iter(figures))}").isNotNull())
    )
    # fewer rows than slices
    joined = local.join(F.broadcast(earlier), [*keys, "_slice"], "left")
    return joined.withColumns({
        name: F.when(F.col(f"_b_{name}").isNull(), F.col(name)).otherwise(FIGURES[how][1](F.col(name), F.col(f"_b_{name}")))
        for name, (how, _) in figures.items()
    }).drop("_slice", *[f"_b_{name}" for name in figures])
