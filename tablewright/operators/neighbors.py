"""Exact nearest neighbours by descending through a tree of cells, and the two cleaning steps built on them.

Points are dealt into blocks by cuts along one coordinate after another, each
time the one in which the points of a cell are spread most, so all coordinates
take part however many there are. Each block is one group of a shuffle and is
halved inside its task, in the same way, down to cells of few points. A cell
carries its weight and the box of its points over all coordinates; the smallest
ones also have a reference point, their mean, and the ring of distances from it
in which their points lie. By the triangle inequality a point of the cell is no
nearer to a query than the ring, and no nearer than the box.

A query starts with the few cells near the root. At each level the weights of
the cells that lie wholly within some distance bound the distance of its k-th
neighbour, cells that begin beyond the bound drop out, and the others are
replaced by their parts. In the nearest of the smallest cells it then measures
real distances, which bound the k-th neighbour more closely; only cells that
begin within that bound are met. So a far cluster costs an isolated query a few
cells, however many points it has. Queries and points meet cell by cell, as
arrays, and only the nearest few of a cell leave the task. Equal points count as
one point with a weight.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions import masks
from tablewright.operators.skew import lookup_join
from tablewright.session import cut_lineage

# the following shape the plan only
FULL_BLOCK = 1 << 15  # points a block may have without being cut further
FULL_CELL = 64  # points a cell may have without being halved further
BITS = 3  # a cut makes up to 2**BITS cells
CUTS_IN_BLOCK = 3  # cuts that halving a block amounts to: 2**15 points in cells of 64
TOGETHER = 1 << 18  # distances a task measures at once
FIRST = 2  # cuts between the root and the cells a query starts with, at most 64
HAIR = 1 + 1e-9  # room for the last bits of distances


def _length(sides: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for side in sides:
        total = total + side * side
    return F.sqrt(total)


def _distance(a: str, b: str, dims: int) -> Column:
    # one expression per coordinate, which Spark compiles; a lambda over arrays it does not
    return _length([F.get(a, i) - F.get(b, i) for i in range(dims)])


def _to_box(q: str, lo: str, hi: str, farthest: bool, dims: int) -> Column:
    """Distance from a point to the nearest or the farthest place of a box."""
    def gap(i: int) -> Column:
        below, above = F.get(lo, i) - F.get(q, i), F.get(q, i) - F.get(hi, i)
        return F.greatest(F.abs(below), F.abs(above)) if farthest else F.greatest(below, above, F.lit(0.0))

    return _length([gap(i) for i in range(dims)])


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over all shuffle partitions: its few rows become very many in the step that follows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _cut(points: DataFrame, dims: int) -> DataFrame:
    """``points`` with every full block cut along the coordinate in which it is spread most.

    Cuts are approximate quantiles and the middle of the range, so a cell with
    two different points is always parted.
    """
    parts = (1 << BITS) - 1
    shares = [i / parts for i in range(1, parts)]
    sides = points.groupBy("g", "cell").agg(F.count(F.lit(1)).alias("n"), *[
        F.struct(
            F.percentile_approx(F.get("p", i), shares, 1000).alias("cuts"), F.min(F.get("p", i)).alias("lo"),
            F.max(F.get("p", i)).alias("hi"),
        ).alias(f"d{i}") for i in range(dims)
    ])
    spreads = [
        F.struct(
            (F.element_at(F.col(f"d{i}.cuts"), -1) - F.get(F.col(f"d{i}.cuts"), 0)).alias("spread"),
            (F.col(f"d{i}.hi") - F.col(f"d{i}.lo")).alias("range"), F.lit(i).alias("i"),
            F.array_append(F.col(f"d{i}.cuts"), (F.col(f"d{i}.lo") + F.col(f"d{i}.hi")) / 2).alias("cuts"),
        ) for i in range(dims)
    ]
    best = sides.where(F.col("n") > FULL_BLOCK).select("g", "cell", F.array_max(F.array(*spreads)).alias("cut"))
    own = F.get("p", F.col("cut.i"))
    slot = F.size(F.filter("cut.cuts", lambda c: c < own))
    return points.join(best, ["g", "cell"], "left").withColumn(
        "cell", F.shiftleft("cell", BITS) + F.coalesce(F.when(F.col("cut").isNotNull(), slot), F.lit(0))
    ).drop("cut")


def _boxes(finest: DataFrame, up: int, dims: int) -> DataFrame:
    """Cells ``up`` cuts above the finest, with their weight and box."""
    ends = [f(F.get(side, i)) for side, f in (("lo", F.min), ("hi", F.max)) for i in range(dims)]
    return finest.groupBy("g", F.shiftright("cell", BITS * up).alias("cell")).agg(
        F.sum("w").alias("w"), F.array(*ends[:dims]).alias("lo"), F.array(*ends[dims:]).alias("hi")
    )


def _measured(seen: DataFrame, dims: int, ring: bool = False) -> DataFrame:
    """Candidate cells with the least and greatest distance that their points can have from the query."""
    near, far = (_to_box("q", "lo", "hi", side, dims) for side in (False, True))
    if ring:
        middle = _distance("q", "mean", dims)
        # last bits must not make a ring look farther than it is
        near = F.greatest(near, middle / HAIR - F.col("outer") * HAIR, F.col("inner") / HAIR - middle * HAIR)
        far = F.least(far, (middle + F.col("outer")) * HAIR)
    return seen.withColumn("near", near).withColumn("far", far)


def _within_bound(measured: DataFrame, need: int) -> DataFrame:
    """Candidate cells that may hold one of the nearest ``need`` weights of their query."""
    own = Window.partitionBy("g", "q")
    upto = own.orderBy("far", "cell").rowsBetween(Window.unboundedPreceding, 0)
    bound = F.min(F.when(F.col("_cum") >= need, F.col("far"))).over(own)
    return (
        measured.withColumn("_cum", F.sum("w").over(upto)).withColumn("_bound", bound)
        .where(F.col("_bound").isNull() | (F.col("near") <= F.col("_bound") * HAIR))
        .select("g", "q", "cell", "w", "near")
    )


def _coordinates(lists: pa.ChunkedArray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """A list column as a matrix with NaN for missing coordinates, and the rows that have one missing."""
    flat = lists.combine_chunks().flatten()
    missing = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, dims).any(axis=1)
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims), missing


def _halved(x: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Numbers of the cells of a block and the rows of ``x`` in each."""
    out, todo = [], [(0, 0, np.arange(len(x)))]
    while todo:
        cell, depth, rows = todo.pop()
        if depth == BITS * CUTS_IN_BLOCK or len(rows) <= FULL_CELL:
            out.append((cell << (BITS * CUTS_IN_BLOCK - depth), rows))
            continue
        own = x[rows]
        along = own[:, np.argmax(np.ptp(own, axis=0))]
        half = len(rows) // 2
        order = np.argpartition(along, half)
        todo.append((cell << 1, depth + 1, rows[order[:half]]))
        todo.append((cell << 1 | 1, depth + 1, rows[order[half:]]))
    return out


def _cells(placed: DataFrame, dims: int) -> DataFrame:
    """The smallest cells (g, cell, w, lo, hi, mean, inner, outer) with their points and weights as lists."""

    def work(block: pa.Table) -> pa.Table:
        x, _ = _coordinates(block["p"], dims)
        weights = block["w"].to_numpy()
        known = np.where(np.isfinite(x), x, 0.0)  # cells of odd points are wide, not wrong
        found = _halved(known)
        order = np.concatenate([rows for _, rows in found])
        sizes = [len(rows) for _, rows in found]
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        cells = [x[rows] for _, rows in found]
        lo = np.array([np.fmin.reduce(c, axis=0) for c in cells])
        hi = np.array([np.fmax.reduce(c, axis=0) for c in cells])
        mean = np.array([known[rows].mean(axis=0) for _, rows in found])
        away = [np.sqrt(((c - m) ** 2).sum(axis=1)) for c, m in zip(cells, mean)]
        first = block["cell"][0].as_py() << (BITS * CUTS_IN_BLOCK)

        def vectors(values: np.ndarray) -> pa.Array:
            gone = np.isnan(values).ravel()
            return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel(), pa.float64(), mask=gone), dims).cast(pa.list_(pa.float64()))

        return pa.table({
            "g": block["g"].take(pa.array(np.zeros(len(found), dtype=np.int64))),
            "cell": pa.array([first + cell for cell, _ in found], pa.int64()),
            "w": pa.array([int(weights[rows].sum()) for _, rows in found], pa.int64()),
            "lo": vectors(lo), "hi": vectors(hi), "mean": vectors(mean),
            # a point without distance takes its cell's ring away
            "inner": pa.array([0.0 if np.isnan(a).any() else a.min() for a in away], pa.float64()),
            "outer": pa.array([np.inf if np.isnan(a).any() else a.max() for a in away], pa.float64()),
            "ps": pa.ListArray.from_arrays(ends, block["p"].combine_chunks().take(pa.array(order))),
            "ws": pa.ListArray.from_arrays(ends, pa.array(weights[order], pa.int64())),
        })

    kind = placed.schema["g"].dataType.simpleString()
    return placed.groupBy("g", "cell").applyInArrow(work, (
        f"g {kind}, cell bigint, w bigint, lo array<double>, hi array<double>, mean array<double>, inner double, "
        "outer double, ps array<array<double>>, ws array<bigint>"
    ))


def _first_of(q: np.ndarray, p: np.ndarray, odd: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``q``, rows of ``p`` and distances of the ``need`` nearest points of each query, in order.

    ``odd`` marks pairs of missing coordinates, whose distance is missing and comes first.
    """
    d = np.zeros((len(q), len(p)))
    for i in range(q.shape[1]):  # in the order of the coordinates, as in _distance
        d += (q[:, i, None] - p[None, :, i]) ** 2
    d = np.where(odd, -1.0, np.where(np.isnan(d), np.inf, np.sqrt(d)))
    last = np.partition(d, min(need, len(p)) - 1, axis=1)[:, min(need, len(p)) - 1]
    row, col = np.nonzero(d <= last[:, None])
    by_name = [np.where(np.isnan(p[col, i]), -np.inf, p[col, i]) for i in reversed(range(p.shape[1]))]
    order = np.lexsort([*by_name, d[row, col], row])
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    row, col = row[place < need], col[place < need]
    return row, col, d[row, col]


def _met(pairs: DataFrame, cells: DataFrame, need: int, dims: int) -> DataFrame:
    """The ``need`` nearest points (g, q, p, w, distance) of each query within each of its cells."""

    def work(asked: pa.Table, given: pa.Table) -> pa.Table:
        asked = asked.sort_by("cell")
        q, q_odd = _coordinates(asked["q"], dims)
        of = asked["cell"].to_numpy()
        kept, at, far = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
        points = given["ps"].combine_chunks()
        bounds = np.concatenate([[0], np.cumsum(points.value_lengths().to_numpy())])
        p, p_odd = _coordinates(pa.chunked_array([points.flatten()], type=pa.list_(pa.float64())), dims)
        for cell, a, b in zip(given["cell"].to_pylist(), bounds, bounds[1:]):
            first, last = np.searchsorted(of, cell), np.searchsorted(of, cell, side="right")
            step = max(1, TOGETHER // max(1, b - a))
            for i in range(first, last, step):
                j = min(last, i + step)
                row, col, d = _first_of(q[i:j], p[a:b], q_odd[i:j, None] | p_odd[None, a:b], need)
                kept.append(row + i)
                at.append(col + a)
                far.append(d)
        rows, cols, d = (np.concatenate(x) for x in (kept, at, far))
        return pa.table({
            "g": asked["g"].take(pa.array(rows)), "q": asked["q"].take(pa.array(rows)), "p": points.flatten().take(pa.array(cols)),
            "w": given["ws"].combine_chunks().flatten().take(pa.array(cols)),
            "distance": pa.array(np.where(np.isinf(d), np.nan, d), pa.float64(), mask=d < 0),
        })

    # neighbouring cells in one group
    group = ["g", F.shiftright("cell", BITS).alias("_of")]
    kind = pairs.schema["g"].dataType.simpleString()
    return pairs.select("g", "q", "cell").groupBy(*group).cogroup(cells.select("g", "cell", "ps", "ws").groupBy(*group)).applyInArrow(
        work, f"g {kind}, q array<double>, p array<double>, w bigint, distance double"
    )


def _nearest_weights(met: DataFrame, need: int) -> DataFrame:
    """The nearest points of each query up to a weight of ``need``, and the distance they reach."""
    order = Window.partitionBy("g", "q").orderBy("distance", "p")
    before = F.coalesce(F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return met.withColumn("_before", before).where(F.col("_before") < need)


def candidate_cells(queries: DataFrame, points: DataFrame, need: int, dims: int) -> tuple[DataFrame, DataFrame]:
    """Cells (g, q, cell, w, near) that may hold the nearest ``need`` weights of a query, and all cells with their points."""
    placed = cut_lineage(points.select("g", "p", "w", F.lit(0).cast("bigint").alias("cell")))
    cuts = 0
    # one count per cut; a bigint has room for 20 cuts in all
    while cuts < 20 - CUTS_IN_BLOCK and placed.groupBy("g", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FULL_BLOCK).limit(1).count():
        placed = cut_lineage(_cut(placed, dims))
        cuts += 1
    cells = cut_lineage(_cells(placed, dims))
    cuts += CUTS_IN_BLOCK
    finest = cells.drop("ps", "ws")

    at = min(FIRST, cuts)
    # one row per group with its first cells, at most 64
    cell = F.struct("cell", "w", "lo", "hi")
    first = cut_lineage(_boxes(finest, cuts - at, dims).groupBy("g").agg(F.collect_list(cell).alias("_c")))
    seen = _spread(queries.select("g", "q"), "g", "q").join(first, "g").select("g", "q", F.inline("_c"))
    left = cut_lineage(_within_bound(_measured(seen, dims), need))
    while at < cuts:
        at += 1
        parts = (finest if at == cuts else _boxes(finest, cuts - at, dims)).withColumn("of", F.shiftright("cell", BITS))
        held = _spread(left.select("g", "q", F.col("cell").alias("of")), "g", "of").join(parts, ["g", "of"])
        left = cut_lineage(_within_bound(_measured(held, dims, ring=at == cuts), need))
    return left, cells


def nearest(
    queries: DataFrame, points: DataFrame, k: int, dims: int, exclude_self: bool = False
) -> DataFrame:
    """The nearest points of each query until their weights reach ``k``, or all where a group has less.

    ``queries`` has distinct ``(g, q)`` and ``points`` distinct ``(g, p)`` with
    a weight ``w`` of at least 1 (exactly 1 with ``exclude_self``): a group and
    an array of coordinates. Returns ``(g, q, p, w, distance, place)``, ordered
    by distance, then coordinates.
    """
    need = k + 1 if exclude_self else k
    left, cells = candidate_cells(cut_lineage(queries), points, need, dims)
    # the nearest cells that hold enough points, for a bound from real distances
    closer = Window.partitionBy("g", "q").orderBy("near", "cell").rowsBetween(Window.unboundedPreceding, -1)
    ranked = left.withColumn("_probe", F.coalesce(F.sum("w").over(closer), F.lit(0)) < need)
    probed = cut_lineage(_nearest_weights(_met(ranked.where("_probe"), cells, need, dims), need))
    bounds = probed.groupBy("g", "q").agg(F.max("distance").alias("_bound"))
    # a query whose first cells hold too little has no others
    others = ranked.where("NOT _probe").join(bounds, ["g", "q"]).where(F.col("near") <= F.col("_bound") * HAIR)
    near = _nearest_weights(probed.drop("_before").unionByName(_met(others, cells, need, dims)), need)
    if exclude_self:
        near = near.where("q <> p")
    order = Window.partitionBy("g", "q").orderBy("distance", "p")
    return near.drop("_before").withColumn("place", F.row_number().over(order))


def fill_knn(
    df: DataFrame, row_id: str, column: str, features: Sequence[str], k: int = 5
) -> DataFrame:
    """Fill a numeric column with the mean over the ``k`` nearest rows that have it.

    Distance is Euclidean on standardised features; a missing feature counts as
    the mean. Rows with equal features share one search.
    """
    stats = df.agg(
        F.struct(*[
            F.struct(F.avg(masks.number(c)).alias("m"), F.stddev_pop(masks.number(c)).alias("s")).alias(c) for c in features
        ])
    ).scalar()

    def scaled(c: str) -> Column:
        spread = F.when(stats[c]["s"] > 0, stats[c]["s"])
        return F.coalesce((masks.number(c) - stats[c]["m"]) / spread, F.lit(0.0))

    known = masks.number(column)
    rows = cut_lineage(df.withColumn("_z", F.array(*[scaled(c) for c in features])).withColumn("_v", known))
    points = rows.where("_v IS NOT NULL").groupBy(F.col("_z").alias("p")).agg(
        F.count(F.lit(1)).alias("w"), F.avg("_v").alias("_mean")
    )
    wanted = rows.where("_v IS NULL").groupBy(F.col("_z").alias("q")).agg(F.count(F.lit(1)).alias("_rows"))
    one = F.lit(0).alias("g")
    found = nearest(wanted.select(one, "q"), points.select(one, "p", "w"), k, len(features))
    before = Window.partitionBy("q").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    used = found.withColumn("_before", F.coalesce(F.sum("w").over(before), F.lit(0))).withColumn(
        "_use", F.least(F.col("w"), F.lit(k) - F.col("_before"))
    ).where("_use > 0")
    means = used.join(points.select("p", "_mean"), "p").groupBy("q").agg(
        (F.sum(F.col("_mean") * F.col("_use")) / F.sum("_use")).alias("_fill")
    )
    lookup = wanted.join(means, "q", "left").withColumnRenamed("q", "_z")
    filled = lookup_join(rows, lookup, ["_z"], "_rows", [row_id])
    return filled.withColumn(column, F.coalesce("_v", "_fill")).select(*df.columns)


def _uniform(columns: Sequence[Column], seed: int) -> Column:
    """Repeatable number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def smote(
    df: DataFrame, row_id: str, label: str, features: Sequence[str], k: int = 5, seed: int = 42
) -> DataFrame:
    """All rows plus made-up rows until every class is as large as the largest.

    A made-up row lies between a row and one of its ``k`` nearest neighbours of
    the same class. Columns: ``row_id`` (of the base row), label, features and
    ``copy``, which is 0 for given rows.
    """
    from tablewright.operators.cleaning import oversample

    # read several times below, while features may be dear
    df = cut_lineage(df.select(row_id, label, *features))
    point = F.array(*[F.col(c).cast("double") for c in features])
    rows = cut_lineage(oversample(df, [row_id], label, seed))
    wanted = rows.where("copy > 0").withColumn("q", point)
    distinct = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("g"), point.alias("p")).agg(
        F.lit(1).cast("bigint").alias("w")
    )
    queries = wanted.select(F.col(label).alias("g"), "q").distinct()
    found = nearest(queries, distinct, k, len(features), exclude_self=True)
    # at most k neighbours per point
    lists = found.groupBy("g", "q").agg(F.sort_array(F.collect_list(F.struct("place", "p"))).alias("_near"))
    uses = wanted.groupBy(F.col(label).alias("g"), "q").agg(F.count(F.lit(1)).alias("_rows"))
    lookup = uses.join(lists, ["g", "q"], "left")
    keyed = lookup_join(wanted.withColumn("g", F.col(label)), lookup, ["g", "q"], "_rows", [row_id, "copy"])
    ids = [F.col(row_id), F.col("copy")]
    pick = F.floor(_uniform(ids, seed) * F.size("_near")).cast("int")
    other = F.coalesce(F.get("_near", pick)["p"], F.col("q"))
    step = _uniform(ids, seed + 1)
    made = keyed.withColumn("_o", F.when(F.size("_near") > 0, other).otherwise(F.col("q"))).select(
        row_id, label,
        *[(F.get("q", i) + step * (F.get("_o", i) - F.get("q", i))).alias(c) for i, c in enumerate(features)],
        "copy",
    )
    given = rows.where("copy = 0").select(
        row_id, label, *[F.col(c).cast("double").alias(c) for c in features], "copy"
    )
    return given.unionByName(made)
