"""Profiling: shapes, missing values, duplicates, distributions, group summaries."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tablewright.functions import masks, scalars, text as tx
from tablewright.operators import terms
from tablewright.operators.ordered import exact_quantiles, number_rows, weighted_quantiles
from tablewright.operators.skew import key_counts, with_key_count
from tablewright.session import cut_lineage


def _counted() -> Column:
    return F.count(F.lit(1))


def _long(df: DataFrame, columns: Sequence[str], name: str, value: str, cast: str | None = None):
    """Rows ``(name, value)`` for each of the columns, without a shuffle."""
    def one(c: str) -> Column:
        column = F.col(f"`{c}`")
        if cast == "double":
            return masks.number(column).alias(c)
        return column.cast(cast).alias(c) if cast else column

    picked = [one(c) for c in columns]
    return df.select(*picked).unpivot([], list(columns), name, value)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def table_overview(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, with the table's shape."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    described = F.array(
        *[F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), F.lit(t).alias("type"))
          for i, n, t in rows]
    )
    return df.agg(_counted().alias("n_rows")).select(
        F.inline(described), "n_rows", F.lit(len(rows)).alias("n_cols")
    ).select("position", "column", "type", "n_rows", "n_cols")


def head_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first ``n`` rows by ``order``."""
    return df.orderBy(order).limit(n)


def value_counts(df: DataFrame, column: str, dropna: bool = True, out: str = "n") -> DataFrame:
    if dropna:
        return key_counts(df, [column], out)
    return df.groupBy(column).agg(_counted().alias(out))


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """One row with the number of distinct non-missing values of each column.

    Each exact count is its own two-step aggregation, so no row is expanded once per column.
    """
    if approx:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    counts = [
        df.where(F.col(c).isNotNull()).select(c).distinct().agg(_counted().alias(c))
        for c in columns
    ]
    first, *others = counts
    return first.select(
        F.col(columns[0]), *[o.scalar().alias(c) for c, o in zip(columns[1:], others)]
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, counted in one pass."""
    marks = [
        F.count_if(masks.missing(f.name, f.dataType)).alias(f.name) for f in df.schema
    ]
    counted = df.agg(_counted().alias("_rows"), *marks)
    long = counted.unpivot(["_rows"], df.columns, "column", "n_missing")
    return long.select(
        "column",
        "n_missing",
        scalars.percent(F.col("n_missing"), F.col("_rows")).alias("pct_missing"),
        scalars.exceeds_band(
            scalars.percent(F.col("n_missing"), F.col("_rows")), 10.0, 30.0
        ).alias("severity"),
    )


def mostly_missing(df: DataFrame, threshold: float = 50.0) -> DataFrame:
    return missing_profile(df).where(F.col("pct_missing") > threshold)


def missing_patterns(df: DataFrame) -> DataFrame:
    """Which columns are missing together, and how often."""
    names = [
        F.when(masks.missing(f.name, f.dataType), F.lit(f.name)) for f in df.schema
    ]
    return df.groupBy(F.concat_ws(",", *names).alias("missing_columns")).agg(_counted().alias("n"))


def missing_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation between the missingness of column pairs; far from 0 is systematic."""
    types = {f.name: f.dataType for f in df.schema}
    marks = df.select(*[masks.missing(c, types[c]).cast("double").alias(c) for c in columns])
    return correlation_matrix(marks, columns)


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """256-bit digest of a row: missing equals missing, 0.0 equals -0.0, timestamps count to the microsecond."""
    exact = {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    floats = (T.DoubleType, T.FloatType)
    types = {f.name: f.dataType for f in df.schema}
    cells = [
        (F.when(~masks.missing(c, types[c]), F.col(f"`{c}`") + F.lit(0).cast(types[c])) if isinstance(types[c], floats)
         else F.col(f"`{c}`")).alias(c)
        for c in (columns or df.columns)
    ]
    return F.sha2(F.to_json(F.struct(*cells), exact), 256)


def full_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows; missing equals missing.

    Rows are compared by a 256-bit digest, so whole texts never cross the shuffle.
    """
    return _beyond_first(df.groupBy(row_digest(df).alias("_d")).agg(_counted().alias("_n")))


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same, comparing the key columns only."""
    return _beyond_first(df.groupBy(*keys).agg(_counted().alias("_n")))


def _beyond_first(counts: DataFrame) -> DataFrame:
    total, extra = F.sum("_n"), F.sum(F.col("_n") - 1)
    pct = scalars.percent(extra, total)
    return counts.agg(
        F.coalesce(total, F.lit(0)).alias("n_rows"),
        F.coalesce(extra, F.lit(0)).alias("n_duplicates"),
        pct.alias("pct_duplicates"),
    ).withColumn("severity", scalars.exceeds_band("pct_duplicates", 1.0, 5.0))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Number of keys occurring more than once and the rows they cover."""
    return key_counts(df, [key]).where("n > 1").agg(
        _counted().alias("n_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")
    )


def top_repeated_keys(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    return key_counts(df, [key]).where("n > 1").orderBy(F.desc("n"), key).limit(k)


def flag_duplicate_keys(
    df: DataFrame, key: str, row_key: Sequence[str], out: str = "is_duplicate"
) -> DataFrame:
    """True where the key occurs more than once; a missing key is never a duplicate."""
    counted = with_key_count(df, [key], row_key, "_n")
    return counted.withColumn(out, F.coalesce(F.col("_n") > 1, F.lit(False))).drop("_n")


def group_constant(df: DataFrame, group: str, target: str) -> DataFrame:
    """Whether every non-missing group has exactly one distinct non-missing target."""
    bounds = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.min(target).alias("lo"), F.max(target).alias("hi")
    )
    same = F.coalesce(F.col("lo") == F.col("hi"), F.lit(False))
    return bounds.agg(
        _counted().alias("n_groups"),
        F.coalesce(F.bool_and(same), F.lit(True)).alias("is_constant"),
    )


def group_summary(
    df: DataFrame, group: str, order: str, text: str, firsts: Sequence[str]
) -> DataFrame:
    """Per group: first non-missing value of each column, texts present, mean text length."""
    picks = [
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in firsts
    ]
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        *picks,
        F.count(text).alias("n_texts"),
        F.avg(F.length(text)).alias("mean_length"),
    )


def mean_of_groups(summary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unweighted mean of group values, each group counting once."""
    return summary.agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def text_stats(df: DataFrame, text: str, key: str, group: str) -> DataFrame:
    """Size, vocabulary and length figures of a text table as one row; texts are read once."""
    measured = cut_lineage(df.select(
        F.length(text).cast("bigint").alias("len"), tx.word_count(text).cast("bigint").alias("words"), key, group
    ))
    middle = exact_quantiles(measured, "len", {"median_len": 0.5})
    return measured.agg(
        _counted().alias("n_rows"),
        F.avg("len").alias("mean_len"),
        F.min("len").alias("min_len"),
        F.avg("words").alias("mean_words"),
    ).select(
        "n_rows", "mean_len", "min_len", "mean_words",
        middle.scalar().alias("median_len"),
        distinct_counts(measured, [key]).scalar().alias("unique_keys"),
        distinct_counts(measured, [group]).scalar().alias("unique_groups"),
    )


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, standard deviation, min and max of each numeric column, in one pass."""
    columns = list(columns or numeric_columns(df))
    row = df.select(*[masks.number(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)]).agg(*[
        F.struct(
            F.lit(c).alias("column"), F.count(f"v{i}").alias("n"), F.avg(f"v{i}").alias("mean"),
            F.stddev_samp(f"v{i}").alias("std"), F.min(f"v{i}").alias("min"), F.max(f"v{i}").alias("max"),
        ).alias(f"p{i}")
        for i, c in enumerate(columns)
    ])
    cells = F.array(*[F.col(f"p{i}") for i in range(len(columns))])
    return row.select(F.inline(cells)).where("n > 0")


def iqr_bounds(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """One row: quartiles and the fences ``factor`` interquartile ranges outside them."""
    width = (F.col("q3") - F.col("q1")) * F.lit(float(factor))
    return exact_quantiles(df, column, {"q1": 0.25, "q3": 0.75}).select(
        "q1", "q3", (F.col("q1") - width).alias("lo"), (F.col("q3") + width).alias("hi")
    )


def outlier_counts(
    df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5, limit: float = 3.0
) -> DataFrame:
    """Outliers of every numeric column by both rules."""
    columns = list(columns or numeric_columns(df))
    # every value once with its count: both rules read the counts, not the table
    counted = cut_lineage(
        _long(df, columns, "column", "v", "double").where("v IS NOT NULL").groupBy("column", "v").agg(_counted().alias("w"))
    )
    quartiles = weighted_quantiles(counted, "v", "w", {"q1": 0.25, "q3": 0.75}, ["column"])
    moments = df.select(*[masks.number(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)]).agg(*[
        F.struct(F.lit(c).alias("column"), F.avg(f"v{i}").alias("mean"), F.stddev_pop(f"v{i}").alias("std")).alias(f"p{i}")
        for i, c in enumerate(columns)
    ]).select(F.inline(F.array(*[F.col(f"p{i}") for i in range(len(columns))])))
    # one row per column of the table
    limits = F.broadcast(quartiles.join(moments, "column"))
    width = (F.col("q3") - F.col("q1")) * F.lit(float(factor))
    by_iqr = (F.col("v") < F.col("q1") - width) | (F.col("v") > F.col("q3") + width)
    by_z = F.abs(F.col("v") - F.col("mean")) > F.col("std") * F.lit(float(limit))
    return counted.join(limits, "column").groupBy("column").agg(
        F.sum("w").alias("n"),
        F.sum(F.when(by_iqr, F.col("w")).otherwise(0)).alias("n_iqr"),
        F.sum(F.when(by_z, F.col("w")).otherwise(0)).alias("n_zscore"),
    )


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Largest class over smallest class, with its severity."""
    ratio = F.try_divide(F.max("n").cast("double"), F.min("n").cast("double"))
    return value_counts(df, label).agg(
        F.max("n").alias("majority"), F.min("n").alias("minority"), ratio.alias("ratio")
    ).withColumn("severity", scalars.exceeds_band("ratio", 3.0, 10.0))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(masks.number(x), masks.number(y)).alias("r"))


def _moments(values: np.ndarray) -> list[np.ndarray]:
    """Of a matrix with NaN for missing values, over the rows that have columns i and j, as matrices [i, j]: their
    number, the means of i and of j, the squared deviations of i, the products of deviations."""
    there = ~np.isnan(values)
    mask = there.astype(float)
    shift = np.where(there, values, 0.0).sum(axis=0) / np.maximum(mask.sum(axis=0), 1.0)
    z = np.where(there, values - shift, 0.0)
    # columns that are missing in the same rows share one column of the mask
    number: dict[bytes, int] = {}
    of = np.array([number.setdefault(c.tobytes(), len(number)) for c in np.packbits(there, axis=0).T], dtype=int)
    few = mask[:, np.unique(of, return_index=True)[1]]
    n = (few.T @ few)[of][:, of]
    some = np.maximum(n, 1.0)
    sums = (z.T @ few)[:, of]
    mean = sums / some + shift[:, None]
    return [n, mean, mean.T, ((z * z).T @ few)[:, of] - sums * sums / some, z.T @ z - sums * sums.T / some]


def _added(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Moments of two sets of rows together."""
    n = a[0] + b[0]
    some = np.maximum(n, 1.0)
    share, weight = b[0] / some, a[0] * b[0] / some
    x, y = b[1] - a[1], b[2] - a[2]
    return [n, a[1] + x * share, a[2] + y * share, a[3] + b[3] + x * x * weight, a[4] + b[4] + x * y * weight]


MOMENTS = ["n", "mean", "other_mean", "square", "product"]


def _pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The moments of all pairs, one row of the matrices per column; from one such row per column and task."""
    p = len(columns)
    schema = "i int, " + ", ".join(f"{c} array<double>" for c in MOMENTS)

    def rows(held: Mapping[int, Sequence[np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(list(held), pa.int32()),
            *[pa.array([parts[k] for parts in held.values()], pa.list_(pa.float64())) for k in range(len(MOMENTS))],
        ], ["i", *MOMENTS])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros((p, p))] * len(MOMENTS)
        for batch in batches:
            held = _added(held, _moments(np.column_stack([c.fill_null(np.nan).to_numpy(zero_copy_only=False) for c in batch.columns])))
        yield rows({i: [m[i] for m in held] for i in range(p)})

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for i, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                new = [np.array(x) for x in parts]
                held[i] = _added(held[i], new) if i in held else new
        yield rows(held)

    numbers = df.select(*[masks.number(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    return numbers.mapInArrow(work, schema).repartition("i").mapInArrow(total, schema)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs of columns in long form, over the rows that have both, from one pass for any number of columns.

    Each task works its rows off as matrix products and hands on one row per
    column. A pair with fewer than two rows or without variation has no figure.
    """
    cells = _pair_moments(df, columns).select("i", F.posexplode(F.arrays_zip("square", "product", "n")).alias("j", "m"))
    names = F.array(*[F.lit(c) for c in columns])
    pair = cells.groupBy(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).agg(
        F.max(F.when(F.col("i") < F.col("j"), F.col("m.product"))).alias("product"), F.max("m.n").alias("n"),
        F.max(F.when(F.col("i") < F.col("j"), F.col("m.square"))).alias("xx"),
        F.max(F.when(F.col("i") > F.col("j"), F.col("m.square"))).alias("yy"),
    ).where("a < b")
    # all pairs, also of a table without rows
    first = df.sparkSession.range(max(0, len(columns) - 1)).select(F.col("id").cast("int").alias("a"))
    pairs = first.select("a", F.explode(F.sequence(F.col("a") + 1, F.lit(len(columns) - 1))).alias("b"))
    varies = (F.col("n") > 1) & (F.col("xx") > 0) & (F.col("yy") > 0)
    return pairs.join(pair, ["a", "b"], "left").select(
        F.get(names, F.col("a")).alias("x"), F.get(names, F.col("b")).alias("y"),
        F.when(varies, F.col("product") / F.sqrt(F.col("xx")) / F.sqrt(F.col("yy"))).alias("r"),
    )


def histogram(
    df: DataFrame, column: str, bins: int, by: str | None = None,
    lo: float | None = None, hi: float | None = None,
) -> DataFrame:
    """Equal-width bins, the last one closed, empty bins included.

    ``density`` integrates to 1 within each ``by`` class.
    """
    keys = [by] if by else []
    values = df.select(*keys, masks.number(column).alias("v")).where("v IS NOT NULL")
    if lo is None or hi is None:
        ends = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
        ends_lo, ends_hi = ends["lo"], ends["hi"]
    else:
        ends_lo, ends_hi = F.lit(float(lo)), F.lit(float(hi))
        values = values.where(F.col("v").between(lo, hi))
    # a column with one single value still gets a bin of width 1 around it
    flat = ends_lo == ends_hi
    start = F.when(flat, ends_lo - 0.5).otherwise(ends_lo)
    width = F.when(flat, F.lit(1.0)).otherwise(ends_hi - ends_lo) / F.lit(float(bins))
    spot = F.floor((F.col("v") - start) / width).cast("int")
    counted = (
        values.groupBy(*keys, F.least(spot, F.lit(bins - 1)).alias("bin"))
        .agg(_counted().alias("n"))
    )
    per_class = counted.groupBy(*keys).agg(
        F.sum("n").alias("_all"),
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"),  # at most `bins` entries
    )
    filled = per_class.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    n = F.coalesce(F.try_element_at("_n", F.col("bin")), F.lit(0))
    return filled.select(
        *keys,
        "bin",
        (start + F.col("bin") * width).alias("bin_lo"),
        (start + (F.col("bin") + 1) * width).alias("bin_hi"),
        n.alias("n"),
        (n / (F.col("_all") * width)).alias("density"),
    )


BANDS = 9.0  # beyond so many bandwidths a kernel is below the last bit of its peak


def density_curve(df: DataFrame, column: str, points: int = 1000) -> DataFrame:
    """Gaussian kernel density with Scott bandwidth, on an even grid half a range wider than the data.

    Copies of a value collapse first; each remaining value meets the grid points
    within ``BANDS`` bandwidths inside its own row, fewer the more rows there
    are, and only one partial sum per grid point is shuffled.
    """
    values = df.select(masks.number(column).alias("v")).where("v IS NOT NULL")
    per_value = cut_lineage(values.groupBy("v").agg(_counted().alias("w")))
    facts = values.agg(
        F.struct(
            F.count("v").alias("n"), F.stddev_samp("v").alias("sd"),
            F.min("v").alias("lo"), F.max("v").alias("hi"),
        )
    ).scalar()
    band = facts["sd"] * F.pow(facts["n"].cast("double"), F.lit(-0.2))
    span = facts["hi"] - facts["lo"]
    step = span * 2.0 / F.lit(float(points - 1))
    start = facts["lo"] - span * 0.5
    first = F.greatest(F.ceil((F.col("v") - band * BANDS - start) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("v") + band * BANDS - start) / step), F.lit(points - 1)).cast("int")
    grid = per_value.select("v", "w", F.explode(F.when(first <= last, F.sequence(first, last))).alias("point"))
    z = (start + F.col("point") * step - F.col("v")) / band
    kernel = F.col("w") * F.exp(z * z * -0.5)
    norm = facts["n"] * band * F.sqrt(F.lit(2.0) * F.pi())
    every = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"), F.lit(0.0).alias("_k"))
    return (
        grid.select("point", kernel.alias("_k")).unionByName(every)
        .groupBy("point").agg(F.sum("_k").alias("_k"))
        .select("point", (start + F.col("point") * step).alias("x"), (F.col("_k") / norm).alias("density"))
    )


def box_stats(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, and whiskers at the last data point within 1.5 interquartile ranges."""
    counted = cut_lineage(
        df.select(*by, masks.number(column).alias("v")).where("v IS NOT NULL")
        .groupBy(*by, "v").agg(_counted().alias("n"))
    )
    marks = weighted_quantiles(counted, "v", "n", {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    width = (F.col("q3") - F.col("q1")) * 1.5
    lo = F.min(F.when(F.col("v") >= F.col("q1") - width, F.col("v"))).alias("whisker_lo")
    hi = F.max(F.when(F.col("v") <= F.col("q3") + width, F.col("v"))).alias("whisker_hi")
    if not by:
        edge = marks.select(F.struct("q1", "median", "q3")).scalar()
        fenced = counted.select("v", *[edge[q].alias(q) for q in ("q1", "median", "q3")])
        return fenced.groupBy("q1", "median", "q3").agg(lo, hi)
    return counted.join(marks, list(by)).groupBy(*by, "q1", "median", "q3").agg(lo, hi)


def groups_by_median(df: DataFrame, group: str, column: str) -> DataFrame:
    """Median per group with its place in descending order (ties by group)."""
    medians = exact_quantiles(df.where(F.col(group).isNotNull()), column, {"median": 0.5}, [group])
    ranked = number_rows(medians.withColumn("_down", -F.col("median")), "_down", "place", tie=[group])
    return ranked.drop("_down")


def group_quantiles(
    df: DataFrame, group: str, column: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """Distribution of a numeric column by group."""
    return exact_quantiles(df.where(F.col(group).isNotNull()), column, quantiles, [group])


def period_counts(df: DataFrame, day: Column | str, group: str, unit: str = "MM") -> DataFrame:
    """Rows per period and group; rows without a valid date are left out."""
    start = F.trunc(day, unit)
    return (
        df.select(start.alias("period"), group)
        .where(F.col("period").isNotNull() & F.col(group).isNotNull())
        .groupBy("period", group)
        .agg(_counted().alias("n"))
    )


def trend(df: DataFrame, day: str, column: str, unit: str = "MM") -> DataFrame:
    """Count and mean of a value per period."""
    return df.where(F.col(day).isNotNull()).groupBy(F.trunc(day, unit).alias("period")).agg(
        F.count(column).alias("n"), F.avg(column).alias("mean")
    )


def seasonality(df: DataFrame, day: str, column: str) -> DataFrame:
    """Count and mean of a value per calendar month over all years."""
    return df.where(F.col(day).isNotNull()).groupBy(F.month(day).alias("month")).agg(
        F.count(column).alias("n"), F.avg(column).alias("mean")
    )


def seasonal_parts(
    df: DataFrame, day: str, groups: Sequence[str] = (), value: str | None = None
) -> DataFrame:
    """Monthly totals of each group taken apart: ``(groups, month, total, trend, season, rest)``.

    A total counts rows, or sums ``value``; the calendar of a group has all
    months from its first to its last, empty ones with zero. The trend is the
    centred mean over twelve months, with half of the two at the ends; it is
    missing in the first and last six. The season is the mean distance from the
    trend in that month of the year, shifted so that the twelve add up to zero,
    and missing where a group has no trend in such a month. Rows without a day
    are left out.
    """
    dated = df.where(F.col(day).isNotNull()).withColumn("month", F.trunc(day, "MM"))
    amount = F.count(F.lit(1)) if value is None else F.coalesce(F.sum(masks.number(value)), F.lit(0.0))
    monthly = dated.groupBy(*groups, "month").agg(amount.cast("double").alias("total"))
    span = F.sequence(F.min("month"), F.max("month"), F.expr("INTERVAL 1 MONTH"))
    ends = monthly.groupBy(*groups).agg(span.alias("_months"))
    calendar = ends.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.explode("_months").alias("_month"))
    same = F.col("month") == F.col("_month")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    full = calendar.join(monthly, same, "left").select(
        *[F.col(f"_g{i}").alias(g) for i, g in enumerate(groups)], F.col("_month").alias("month"), F.coalesce("total", F.lit(0.0)).alias("total")
    )
    # a group has as many rows as its calendar has months
    order = Window.partitionBy(*groups).orderBy("month")
    inner = order.rowsBetween(-5, 5)
    trend = (F.sum("total").over(inner) + (F.lag("total", 6).over(order) + F.lead("total", 6).over(order)) / 2) / 12
    parted = full.withColumn("trend", trend)
    of_year = Window.partitionBy(*groups, F.month("month"))
    raw = parted.withColumn("_raw", F.avg(F.col("total") - F.col("trend")).over(of_year))
    once = Window.partitionBy(*groups)
    first = F.row_number().over(of_year.orderBy("month")) == 1
    middle = F.avg(F.when(F.col("_first"), F.col("_raw"))).over(once)
    return raw.withColumn("_first", first).withColumn("season", F.col("_raw") - middle).select(
        *groups, "month", "total", "trend", "season", (F.col("total") - F.col("trend") - F.col("season")).alias("rest")
    )


def best_group(summary: DataFrame, group: str, measures: Sequence[str]) -> DataFrame:
    """For each measure the group with the largest value (ties: smallest name)."""
    row = summary.agg(
        *[
            F.min(F.when(F.col(m).isNotNull(), F.struct((-F.col(m)).alias("m"), F.col(group).alias("g"))))
            .alias(m)
            for m in measures
        ]
    )
    cells = [
        F.struct(F.lit(m).alias("measure"), F.col(m)["g"].alias("best"),
                 (-F.col(m)["m"]).cast("double").alias("value"))
        for m in measures
    ]
    return row.select(F.inline(F.array(*cells)))


def table_facts(df: DataFrame, value: str, text: str, day: str) -> DataFrame:
    """Mean value, mean text length, first and last day."""
    return df.agg(
        _counted().alias("n_rows"),
        F.avg(value).alias("mean_value"),
        F.avg(F.length(text)).alias("mean_length"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


def list_items(df: DataFrame, columns: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Items of several comma-separated columns as rows ``(keep..., level, item)``.

    ``columns`` maps a level name to its column.
    """
    def tag(level: str, column: str) -> Column:
        return F.transform(
            tx.split_list(column),
            lambda item: F.struct(F.lit(level).alias("level"), item.alias("item")),
        )

    tagged = F.flatten(F.array(*[tag(level, column) for level, column in columns.items()]))
    return df.select(*keep, F.inline(tagged))


def item_counts(items: DataFrame, by_level: bool = False, distinct_per: str | None = None) -> DataFrame:
    """How often each item occurs, or in how many distinct ``distinct_per`` values."""
    keys = ["level", "item"] if by_level else ["item"]
    if distinct_per:
        items = items.select(*keys, distinct_per).distinct()
    return items.groupBy(*keys).agg(_counted().alias("n"))


def top_items(counts: DataFrame, k: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), "item").limit(k)


def top_items_per_level(counts: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("level").orderBy(F.desc("n"), "item"))
    return counts.withColumn("place", place).where(F.col("place") <= k)


def unique_items(items: DataFrame) -> DataFrame:
    return items.select("item").distinct()


def first_row_per_group(df: DataFrame, group: str, order: str) -> DataFrame:
    """The row with the smallest ``order`` in each group; map tasks keep one row per group."""
    first = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return (
        df.where(F.col(group).isNotNull()).withColumn("_first", first).where("_first = 1").drop("_first")
    )


def presence_matrix(
    df: DataFrame, group: str, order: str, columns: Mapping[str, str], k: int = 15,
    pivot_groups: Sequence[str] | None = None,
) -> DataFrame:
    """0/1 of the ``k`` most frequent items in each group's first row.

    Long form ``(item, group, present)``; with ``pivot_groups`` one column per named group.
    """
    counts = item_counts(list_items(df, columns))
    wanted = top_items(counts, k).agg(F.array_sort(F.collect_list("item"))).scalar()  # k strings
    lists = F.concat(*[tx.split_list(c) for c in columns.values()])
    cells = (
        first_row_per_group(df, group, order)
        .select(group, lists.alias("_items"), wanted.alias("_wanted"))
        .select(group, "_items", F.explode("_wanted").alias("item"))
        .select("item", group, F.array_contains("_items", F.col("item")).cast("int").alias("present"))
    )
    if pivot_groups is None:
        return cells
    return cells.groupBy("item").pivot(group, list(pivot_groups)).agg(F.max("present")).na.fill(0)


def items_per_group(df: DataFrame, group: str, order: str, columns: Mapping[str, str]) -> DataFrame:
    """Length of each group's concatenated item lists, from its first row."""
    lists = [F.size(tx.split_list(c)) for c in columns.values()]
    return first_row_per_group(df, group, order).select(group, sum(lists, F.lit(0)).alias("n_items"))


def categorical_report(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of each categorical column."""
    counts = (
        _long(df, columns, "column", "value", "string")
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(_counted().alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    return counts.withColumn("place", place).where(F.col("place") <= k)


def frequent_words(df: DataFrame, text: str, k: int = 20) -> DataFrame:
    """Most frequent lower-case tokens over whole texts."""
    return terms.frequent_terms(df, text, k, max_n=1).select(F.col("term").alias("item"), F.col("tf").alias("n"))


def length_bands(df: DataFrame, text: str, value: str, cuts: Sequence[int]) -> DataFrame:
    """Mean of a value by band of text length."""
    names = [f"<{cuts[0]}", *[f"{a}-{b - 1}" for a, b in zip(cuts, cuts[1:])], f">={cuts[-1]}"]
    band = scalars.value_band(F.length(text), cuts, names)
    return df.groupBy(band.alias("length_band")).agg(
        _counted().alias("n"), F.avg(value).alias("mean_value")
    )
