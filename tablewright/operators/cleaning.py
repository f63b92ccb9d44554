"""Cleaning strategies and their single steps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tablewright.functions import masks, scalars
from tablewright.operators import profile
from tablewright.operators.ordered import carry, exact_quantiles
from tablewright.operators.sampling import assign_by_quota, sample_quota
from tablewright.operators.skew import lookup_join
from tablewright.session import cut_lineage


def drop_masked(df: DataFrame, mask) -> DataFrame:
    """Rows where a never-NULL mask is false."""
    return df.where(~mask)


def keep_longest(df: DataFrame, keys: Sequence[str], text: str, row_id: str) -> DataFrame:
    """The longest text per key, ties to the smallest id; missing keys form one group.

    Spark limits each map task to one row per key before the shuffle, so a hot
    key never gathers in one task.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(F.length(text)), F.asc(row_id))
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def without_bad_text(df: DataFrame, text: str, min_len: int = 50, run: int = 3) -> DataFrame:
    """Rows whose text is neither damaged nor too short."""
    return drop_masked(df, masks.damaged_text(text, run) | masks.short_text(text, min_len))


def strategy_conservative(
    df: DataFrame, text: str, key: str, row_id: str, min_len: int = 50
) -> DataFrame:
    """Drop damaged and short texts, then keep the longest text per key."""
    return keep_longest(without_bad_text(df, text, min_len), [key], text, row_id)


def strategy_soft(
    df: DataFrame, text: str, min_len: int = 50, out: str = "is_short_review"
) -> DataFrame:
    """Drop damaged texts, keep and flag short ones, keep every key."""
    return drop_masked(df, masks.damaged_text(text)).withColumn(
        out, masks.short_text(text, min_len)
    )


def strategy_flag_duplicates(
    df: DataFrame, text: str, key: str, row_id: str, min_len: int = 50,
    out: str = "is_duplicate_reviewer",
) -> DataFrame:
    """Drop damaged and short texts, keep and flag repeated keys."""
    return profile.flag_duplicate_keys(without_bad_text(df, text, min_len), key, [row_id], out)


def drop_exact(df: DataFrame) -> DataFrame:
    """One row of each set of equal rows."""
    return df.distinct()


def drop_subset(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """The row with the smallest id for each key; rows without id come last, rows of one id by their digest.

    Rows that agree in every column are one row.
    """
    # keys and rows meet as digests: whole texts stay out of the shuffles, and counts combine before them
    key, whole = profile.row_digest(df, keys), profile.row_digest(df)
    first = F.min(F.struct(F.col(row_id).isNull(), F.col(row_id), whole.alias("_whole"))).alias("_first")
    keep = df.groupBy(key.alias("_key")).agg(first).select(F.col("_first._whole").alias("_kept"))
    held = df.withColumn("_whole", whole)
    return held.join(keep, F.col("_whole") == F.col("_kept"), "left_semi").dropDuplicates(["_whole"]).drop("_whole")


def drop_rows(df: DataFrame, columns: Sequence[str] | None = None, max_missing: int = 0) -> DataFrame:
    """Rows with at most ``max_missing`` missing values among the columns."""
    chosen = set(columns or df.columns)
    gaps = sum(
        (masks.missing(f.name, f.dataType).cast("int") for f in df.schema if f.name in chosen), F.lit(0)
    )
    return df.where(gaps <= max_missing)


def drop_columns(df: DataFrame, threshold: float = 40.0, protect: Sequence[str] = ()) -> DataFrame:
    """Without the columns whose share of missing values is above ``threshold`` percent.

    Reads one figure per column, since the output schema depends on them.
    """
    bad = [r["column"] for r in profile.missing_profile(df).where(
        F.col("pct_missing") > threshold).collect()]
    return df.drop(*[c for c in bad if c not in protect])


def _fillable(df: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    types = {f.name: f.dataType for f in df.schema}
    return {c: types[c] for c in columns}


def _fill_with(df: DataFrame, columns: Sequence[str], values) -> DataFrame:
    """Replace missing values by the fields of a one-row struct subquery."""
    types = _fillable(df, columns)
    filled = {}
    for c in columns:
        known = F.when(~masks.missing(c, types[c]), F.col(c))
        filled[c] = F.coalesce(known, values[c])
    return df.withColumns(filled)


def fill_mean(
    df: DataFrame, columns: Sequence[str], base: DataFrame | None = None
) -> DataFrame:
    """Mean of ``base`` (the table itself by default) for missing numbers."""
    types = _fillable(df, columns)
    means = (base or df).agg(
        F.struct(*[F.avg(F.when(~masks.missing(c, t), F.col(c))).alias(c) for c, t in types.items()])
    ).scalar()
    return _fill_with(df, columns, means)


def fill_median(
    df: DataFrame, columns: Sequence[str], base: DataFrame | None = None
) -> DataFrame:
    """Median of ``base`` for missing numbers."""
    long = profile._long(base or df, columns, "column", "v", "double").where(
        "v IS NOT NULL AND NOT isnan(v)"
    )
    medians = exact_quantiles(long, "v", {"m": 0.5}, ["column"])
    row = medians.agg(
        F.struct(*[F.max(F.when(F.col("column") == c, F.col("m"))).alias(c) for c in columns])
    ).scalar()
    return _fill_with(df, columns, row)


def fill_mode(
    df: DataFrame, columns: Sequence[str], base: DataFrame | None = None
) -> DataFrame:
    """Most frequent value, ties to the smallest."""
    counts = (
        profile._long(base or df, columns, "column", "v", "string")
        .where("v IS NOT NULL").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("v").alias("v")))
    modes = counts.groupBy("column").agg(best.alias("b"))
    types = _fillable(df, columns)
    row = modes.agg(
        F.struct(*[
            F.max(F.when(F.col("column") == c, F.col("b")["v"])).cast(types[c]).alias(c)
            for c in columns
        ])
    ).scalar()
    return _fill_with(df, columns, row)


def fill_interpolate(
    df: DataFrame, order: str, column: str, groups: Sequence[str] = ()
) -> DataFrame:
    """Straight line between the known neighbours in order; trailing gaps repeat the last value.

    ``order`` is numeric and unique within a group. NaN is a gap like NULL.
    """
    df = df.withColumn(column, masks.number(column))
    point = F.when(F.col(column).isNotNull(), F.struct(F.col(order).alias("t"), F.col(column).alias("v")))
    known = df.withColumn("_p", point)
    both = carry(known, order, "_p", "_before", "_after", groups)
    span = F.col("_after")["t"] - F.col("_before")["t"]
    slope = (F.col("_after")["v"] - F.col("_before")["v"]) / span
    line = F.col("_before")["v"] + slope * (F.col(order) - F.col("_before")["t"])
    value = (
        F.when(F.col(column).isNotNull(), F.col(column).cast("double"))
        .when(F.col("_after").isNull(), F.col("_before")["v"])
        .when(F.col("_before").isNotNull(), line)
    )
    return both.withColumn(column, value).drop("_p", "_before", "_after")


def _limits(df: DataFrame, columns: Sequence[str], rule: str, factor: float) -> Column:
    """Struct ``{column: {lo, hi}}`` as one scalar subquery for all columns."""
    known = [masks.number(c) for c in columns]
    if rule == "iqr":
        if len(columns) == 1:
            fence = profile.iqr_bounds(df, columns[0], factor).select(F.struct("lo", "hi").alias(columns[0]))
            return fence.select(F.struct(columns[0])).scalar()
        long = profile._long(df, columns, "column", "v", "double").where("v IS NOT NULL")
        quartiles = exact_quantiles(long, "v", {"q1": 0.25, "q3": 0.75}, ["column"])
        width = (F.col("q3") - F.col("q1")) * F.lit(float(factor))
        fences = quartiles.select(
            "column", F.struct((F.col("q1") - width).alias("lo"), (F.col("q3") + width).alias("hi")).alias("f")
        )
        parts = [F.max(F.when(F.col("column") == c, F.col("f"))).alias(c) for c in columns]
        return fences.agg(F.struct(*parts)).scalar()
    if rule == "zscore":
        parts = [
            F.struct(
                (F.avg(c) - F.stddev_pop(c) * float(factor)).alias("lo"),
                (F.avg(c) + F.stddev_pop(c) * float(factor)).alias("hi"),
            ).alias(name)
            for name, c in zip(columns, known)
        ]
        return df.agg(F.struct(*parts)).scalar()
    raise ValueError(f"unknown outlier rule {rule!r}")


def _outside(column: str, edge: Column) -> Column:
    """True outside the fences; a missing value is inside."""
    value = masks.number(column)
    return F.coalesce((value < edge["lo"]) | (value > edge["hi"]), F.lit(False))


def flag_outliers(
    df: DataFrame, column: str, rule: str = "iqr", factor: float = 1.5, out: str = "is_outlier"
) -> DataFrame:
    return df.withColumn(out, _outside(column, _limits(df, [column], rule, factor)[column]))


def clip_outliers(
    df: DataFrame, columns: Sequence[str], rule: str = "iqr", factor: float = 1.5
) -> DataFrame:
    """Pull values outside the fences onto them; missing values stay missing."""
    edges = _limits(df, columns, rule, factor)
    clipped = {}
    for c in columns:
        value = masks.number(c)
        clipped[c] = F.when(value.isNotNull(), F.greatest(F.least(value, edges[c]["hi"]), edges[c]["lo"]))
    return df.withColumns(clipped)


def remove_outliers(
    df: DataFrame, columns: Sequence[str], rule: str = "iqr", factor: float = 1.5
) -> DataFrame:
    """Rows without an outlier in any of the columns; fences come from the input."""
    edges = _limits(df, columns, rule, factor)
    return df.where(~reduce(lambda a, b: a | b, [_outside(c, edges[c]) for c in columns]))


def log_transform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: scalars.safe_log1p(c) for c in columns})


COPY_BLOCK = 10_000


def oversample(df: DataFrame, ids: Sequence[str], label: str, seed: int = 42) -> DataFrame:
    """Repeat rows until every class is as large as the largest.

    Each row gets the whole number of copies its class needs, and the first
    rows in hash order get one more. ``copy`` tells copies apart. A row with
    very many copies is split into blocks that are spread over tasks.
    """
    counts = profile.value_counts(df, label)
    top = counts.agg(F.max("n")).scalar()
    quotas = counts.select(
        label,
        F.expr("bigint(1)").alias("_one"),
        F.floor(top / F.col("n")).cast("bigint").alias("_base"),
        (top % F.col("n")).alias("extra"),
    )
    marked = assign_by_quota(df, ids, label, quotas, ["extra"], "base", seed, "_part", keep=["_base"])
    copies = F.col("_base") + (F.col("_part") == "extra").cast("bigint")
    last_block = F.floor((F.col("_copies") - 1) / COPY_BLOCK)
    blocks = (
        marked.withColumn("_copies", copies)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    )
    spread = blocks.where("_copies > {0}".format(COPY_BLOCK)).repartition(*ids, "_block")
    plain = blocks.where("_copies <= {0}".format(COPY_BLOCK))
    first = F.col("_block") * COPY_BLOCK
    end = F.least(first + COPY_BLOCK, F.col("_copies")) - 1
    return plain.unionByName(spread).withColumn(
        "copy", F.explode(F.sequence(first, end))
    ).select(*df.columns, "copy")


def undersample(df: DataFrame, ids: Sequence[str], label: str, seed: int = 42) -> DataFrame:
    """A sample of each class as large as the smallest class."""
    counts = profile.value_counts(df, label)
    least = counts.agg(F.min("n")).scalar()
    return sample_quota(df, ids, label, counts.select(label, least.alias("take")), "take", seed)


def class_weights(df: DataFrame, ids: Sequence[str], label: str, out: str = "weight") -> DataFrame:
    """Add the balanced weight ``rows / (classes * class rows)``; the data stay as they are."""
    counts = profile.value_counts(df, label, out="_n")
    facts = counts.agg(F.struct(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("k"))).scalar()
    weights = counts.withColumn(out, facts["rows"] / (facts["k"] * F.col("_n")))
    return lookup_join(df, weights, [label], "_n", ids).drop("_n")


def _step_row(df: DataFrame, step: str, place: int) -> DataFrame:
    gaps = sum(
        (masks.missing(f.name, f.dataType).cast("bigint") for f in df.schema), F.lit(0).cast("bigint")
    )
    return df.agg(
        F.lit(place).alias("place"),
        F.lit(step).alias("step"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(gaps), F.lit(0)).alias("missing"),
        F.lit(len(df.columns)).alias("cols"),
    )


def apply_strategy(
    df: DataFrame, strategy: Mapping, row_id: str, target: str | None = None,
    stage: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> tuple[DataFrame, DataFrame]:
    """Run duplicates, missing and outliers in that order; return the table and a step log.

    Fills and fences need figures of the table before them. ``stage`` stores the
    table at those two points, so each figure reads it instead of redoing the
    steps before.

    ``strategy`` has the optional entries ``duplicates`` (``drop_exact`` or a
    list of key columns), ``missing`` (``drop_rows``, ``drop_cols``, ``numeric``
    and ``categorical`` fills) and ``outliers`` (``method`` and ``factor``).
    The target is never filled: rows without it are dropped.
    """
    frames = [("original", df)]
    current = df
    content = [c for c in df.columns if c != row_id]

    rule = strategy.get("duplicates")
    if rule == "drop_exact":
        current = drop_subset(current, content, row_id)
        frames.append(("drop_exact", current))
    elif rule:
        current = drop_subset(current, list(rule), row_id)
        frames.append(("drop_subset", current))

    gaps = strategy.get("missing", {})
    if target:
        current = drop_rows(current, [target])
        frames.append(("drop_missing_target", current))
    if "drop_cols" in gaps:
        current = drop_columns(current, gaps["drop_cols"], [row_id, *([target] if target else [])])
        frames.append(("drop_cols", current))
    if "drop_rows" in gaps:
        current = drop_rows(current, None, gaps["drop_rows"])
        frames.append(("drop_rows", current))
    held = {row_id, target}
    numeric = [c for c in profile.numeric_columns(current) if c not in held]
    texts = [f.name for f in current.schema if isinstance(f.dataType, T.StringType) and f.name not in held]
    fills = {"fill_mean": fill_mean, "fill_median": fill_median, "fill_mode": fill_mode}
    asked = [(gaps.get("numeric"), numeric), (gaps.get("categorical"), texts)]
    asked = [(name, columns) for name, columns in asked if name and columns]
    if asked:
        current = base = stage(current)
        for name, columns in asked:
            # the columns of one fill do not touch those of the other, so both read `base`
            current = fills[name](current, columns, base)
            frames.append((name, current))

    outliers = strategy.get("outliers")
    if outliers and numeric:
        current = stage(current)
        method = outliers["method"]
        if method == "log_transform":
            current = log_transform(current, numeric)
        else:
            action, rule = method.split("_")
            factor = outliers.get("factor", 1.5 if rule == "iqr" else 3.0)
            act = {"clip": clip_outliers, "remove": remove_outliers}[action]
            current = act(current, numeric, rule, factor)
        frames.append((method, current))

    log = reduce(
        DataFrame.unionByName,
        [_step_row(frame, step, place) for place, (step, frame) in enumerate(frames)],
    )
    return current, log
