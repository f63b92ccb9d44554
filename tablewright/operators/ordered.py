"""Ordered computations without a global or per-group single task.

A window over a whole column, or over one hot group, would sort that data in
one task. Here the order is cut into slices at approximate quantiles of the
order column: each slice of each group is its own window partition, and what
earlier slices contribute is added from one summary row per slice. Results are
exact; the cut points only decide how evenly the work is spread.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions import masks

def slice_count(df: DataFrame) -> int:
    """As many slices as the session has shuffle partitions."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(2, partitions)


def with_slice(
    df: DataFrame, order: str, slices: int | None = None, read: Sequence[str] = ()
) -> DataFrame:
    """Add ``_slice``: how many approximate quantile cut points lie below ``order``.

    ``read`` names the counts that the caller aggregated along with ``order``.
    A filter on them that always holds makes the cut points read the same
    columns as the main query, so Spark finds that both need the same shuffle
    and runs it once.
    """
    slices = slices or slice_count(df)
    shares = [i / slices for i in range(1, slices)]
    counted = df
    if read:
        counted = df.where(sum((F.col(c) for c in read), F.lit(0)) > 0)
    cuts = counted.agg(F.percentile_approx(order, shares, 20 * slices)).scalar()
    return df.withColumn("_cuts", cuts).withColumn(
        "_slice", count_below("_cuts", F.col(order), F.lit(slices.bit_length()))
    ).drop("_cuts")


def count_below(cuts: str, value: Column, bits: Column) -> Column:
    """How many of the ascending ``cuts`` lie below ``value``, by halving; their number has ``bits`` bits."""
    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["lo"] + span["hi"], 1)
        # an empty span stays as it is
        open_ = span["lo"] < span["hi"]
        below = F.get(F.col(cuts), middle) < value
        return F.struct(
            F.when(open_ & below, middle + 1).otherwise(span["lo"]).alias("lo"),
            F.when(open_ & ~below, middle).otherwise(span["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.coalesce(F.size(cuts), F.lit(0)).alias("hi"))
    steps = F.sequence(F.lit(1), bits + 1)
    return F.aggregate(steps, start, halve, lambda span: span["lo"])


def _join_slices(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach per-slice summary columns; NULL group keys match each other."""
    renamed = summary
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return rows.join(renamed, test, "inner").drop(*[f"_r_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    groups: Sequence[str] = (),
    slices: int | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Add ``<s>_cum`` (inclusive running sum by ``order``) and ``<s>_total`` per group.

    ``order`` is numeric, a date or a timestamp; with ``tie`` it is unique within a group.
    """
    keys = [*groups, "_slice"]
    sliced = with_slice(df, order, slices, sums)
    inside = (
        Window.partitionBy(*keys).orderBy(order, *tie).rowsBetween(Window.unboundedPreceding, 0)
    )
    local = sliced.select("*", *[F.sum(s).over(inside).alias(f"{s}_cum") for s in sums])
    per_slice = sliced.groupBy(*keys).agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    # one row per slice and group: as many rows in a window partition as there are slices
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = per_slice.select(
        *keys,
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_b_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(whole).alias(f"{s}_total") for s in sums],
    )
    joined = _join_slices(local, offsets, keys)
    for s in sums:
        joined = joined.withColumn(f"{s}_cum", F.col(f"{s}_cum") + F.col(f"_b_{s}"))
    return joined.drop("_slice", *[f"_b_{s}" for s in sums])


def number_rows(
    df: DataFrame, order: str, out: str = "id", slices: int | None = None, tie: Sequence[str] = ()
) -> DataFrame:
    """Dense numbers from 1 in the order of ``order``, then ``tie``."""
    numbered = running_totals(
        df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"], slices=slices, tie=tie
    )
    return numbered.withColumnRenamed("_one_cum", out).drop("_one", "_one_total")


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    groups: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles as one column each; missing values are ignored.

    Copies of a value collapse to one counted row before anything is sorted.
    """
    counted = (
        df.select(*groups, masks.number(value).alias("_v")).where("_v IS NOT NULL")
        .groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_n"))
    )
    return weighted_quantiles(counted, "_v", "_n", quantiles, groups, slices)


def weighted_quantiles(
    counted: DataFrame,
    value: str,
    weight: str,
    quantiles: Mapping[str, float],
    groups: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """The same for a table of different values and how often each occurs."""
    counted = counted.select(*groups, F.col(value).alias("_v"), F.col(weight).alias("_n"))
    ranked = running_totals(counted, "_v", ["_n"], groups, slices)
    last = F.col("_n_total") - 1
    picks = []
    for name, share in quantiles.items():
        spot = F.lit(float(share)) * last
        picks += [
            F.min(F.when(F.col("_n_cum") > F.floor(spot), F.col("_v"))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_n_cum") > F.ceil(spot), F.col("_v"))).alias(f"_hi_{name}"),
            F.max(spot - F.floor(spot)).alias(f"_f_{name}"),
        ]
    found = ranked.groupBy(*groups).agg(*picks)
    return found.select(
        *groups,
        *[
            (
                F.col(f"_lo_{q}") + (F.col(f"_hi_{q}") - F.col(f"_lo_{q}")) * F.col(f"_f_{q}")
            ).alias(q)
            for q in quantiles
        ],
    )


def carry(
    df: DataFrame,
    order: str,
    value: str,
    before: str | None = None,
    after: str | None = None,
    groups: Sequence[str] = (),
    tie: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Add the nearest earlier and later non-NULL ``value``, the row itself included.

    ``before`` and ``after`` name the output columns; leave one out to skip it.
    Both directions share the slices, their summary and the join.
    """
    keys = [*groups, "_slice"]
    rows = with_slice(df, order, slices)
    position = F.struct(order, *tie) if tie else F.col(order)
    known = F.when(F.col(value).isNotNull(), position)
    edges, carried, outs = [], [], []
    for out, turn, edge in ((before, F.asc, F.max_by), (after, F.desc, F.min_by)):
        if out is None:
            continue
        inside = (
            Window.partitionBy(*keys)
            .orderBy(turn(order), *[turn(t) for t in tie])
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        past = (
            Window.partitionBy(*groups)
            .orderBy(turn("_slice"))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        rows = rows.withColumn(out, F.last(value, ignorenulls=True).over(inside))
        edges.append(edge(value, known).alias(f"_e_{out}"))
        carried.append(F.last(f"_e_{out}", ignorenulls=True).over(past).alias(f"_c_{out}"))
        outs.append(out)
    summary = with_slice(df, order, slices).groupBy(*keys).agg(*edges).select(*keys, *carried)
    joined = _join_slices(rows, summary, keys)
    filled = joined.withColumns({out: F.coalesce(out, f"_c_{out}") for out in outs})
    return filled.drop("_slice", *[f"_c_{out}" for out in outs])
