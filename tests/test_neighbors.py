import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import neighbors as nb


@pytest.fixture(scope="module")
def points():
    rng = random.Random(3)
    rows = []
    for i in range(240):
        a, b = rng.gauss(0, 1), rng.gauss(0, 5)
        if i % 3 == 0:
            a, b = 1.0, 2.0  # a third are copies
        if i == 7:
            a, b = 500.0, -500.0
        rows.append((i, a, b, None if i % 10 == 1 else float(i % 17)))
    return rows


def test_fill_equals_brute_force(spark, points):
    df = spark.createDataFrame(points, "id long, a double, b double, v double")
    got = {r["id"]: r["v"] for r in nb.fill_knn(df, "id", "v", ["a", "b"], 4).collect()}
    x = np.array([[p[1], p[2]] for p in points])
    z = (x - x.mean(0)) / x.std(0)
    v = np.array([np.nan if p[3] is None else p[3] for p in points])
    have = ~np.isnan(v)
    assert len(got) == len(points)
    for i, p in enumerate(points):
        if p[3] is not None:
            assert got[i] == p[3]
            continue
        d = np.sqrt(((z[have] - z[i]) ** 2).sum(1))
        order = np.argsort(d, kind="stable")
        if d[order[0]] == 0 and (d == 0).sum() >= 4:
            want = v[have][d == 0].mean()  # copies count as one point with their mean
        else:
            want = v[have][order[:4]].mean()
            assert d[order[3]] < d[order[4]] or p[1] == 1.0
            if np.isclose(d[order[:4]], np.abs(d - d[order[3]]).min()).any() and len(set(d[order[:4]])) < 4:
                continue  # some of the four are copies with different values
        assert got[i] == pytest.approx(want), i


def test_smote_balances_within_the_class(spark, points):
    df = spark.createDataFrame([(p[0], p[1], p[2], "big" if p[0] % 4 else "small") for p in points],
                               "id long, a double, b double, y string")
    out = nb.smote(df, "id", "y", ["a", "b"], 3)
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {"big": 180, "small": 180}
    made = out.where("copy > 0")
    assert made.where("y <> 'small'").count() == 0
    low, high = df.where("y = 'small'").agg(F.min("a"), F.max("a")).first()
    assert made.where((F.col("a") < low) | (F.col("a") > high)).count() == 0
    assert out.where("copy = 0").count() == 240


def test_far_points_and_a_dense_cluster(spark):
    """Far queries get the right neighbours out of a crowd that lies in a corner of one cell."""
    import random

    pick = random.Random(3)
    crowd = {(pick.random() / 1000, pick.random() / 1000) for _ in range(3000)}
    lone = {(500.0 * i, 900.0 - 100 * i) for i in range(1, 9)}
    points = sorted(crowd | lone)
    queries = [(5000.0, 5000.0), (-40.0, 3.0), (0.0005, 0.0005), (499.0, 800.0), (2000.0, 1.0)]
    found = nb.nearest(
        spark.createDataFrame([(0, list(q)) for q in queries], "g int, q array<double>"),
        spark.createDataFrame([(0, list(p), 1) for p in points], "g int, p array<double>, w bigint"), 4, 2,
    ).collect()
    got = {q: [] for q in queries}
    for r in sorted(found, key=lambda r: r.place):
        got[tuple(r.q)].append(tuple(r.p))
    distance = lambda q, p: ((q[0] - p[0]) ** 2 + (q[1] - p[1]) ** 2) ** 0.5
    assert got == {q: sorted(points, key=lambda p: (distance(q, p), p))[:4] for q in queries}


def cloud(dims, n, seed):
    """Clusters of different widths with a third of all points on one coordinate value, and lone points."""
    pick = random.Random(seed)
    centres = [[pick.uniform(-9, 9) for _ in range(dims)] for _ in range(6)]
    out = set()
    while len(out) < n:
        c = pick.choice(centres)
        point = [x + pick.gauss(0, 0.2 + pick.random()) for x in c]
        if pick.random() < 0.33:
            point[0] = 1.0
        out.add(tuple(point))
    return sorted(out | {tuple(100.0 * (i + 1) if j == i else 0.0 for j in range(dims)) for i in range(dims)})


@pytest.mark.parametrize("dims", [1, 2, 5, 10])
def test_nearest_in_many_dimensions(spark, dims):
    points = cloud(dims, 3000, dims)
    pick = random.Random(1)
    queries = sorted({*points[::60], *[tuple(pick.uniform(-12, 12) for _ in range(dims)) for _ in range(20)]})
    weights = [1 + i % 3 for i in range(len(points))]
    asked = spark.createDataFrame([(0, list(q)) for q in queries], "g int, q array<double>")
    given = spark.createDataFrame([(0, list(p), w) for p, w in zip(points, weights)], "g int, p array<double>, w bigint")
    got = {q: [] for q in queries}
    for r in sorted(nb.nearest(asked, given, 7, dims).collect(), key=lambda r: r.place):
        got[tuple(r.q)].append(tuple(r.p))
    x = np.array(points)
    for q in queries:
        # as Spark adds: in the order of the coordinates
        d = np.zeros(len(x))
        for j in range(dims):
            d += (x[:, j] - q[j]) ** 2
        order = sorted(range(len(x)), key=lambda i: (np.sqrt(d[i]), points[i]))
        assert got[q] == [points[i] for i in order[:len(got[q])]], q
        total = np.cumsum([weights[i] for i in order])
        assert len(got[q]) >= min(7, int(np.searchsorted(total, 7)) + 1)


@pytest.mark.parametrize("dims,share", [(2, 0.15), (5, 0.35), (10, 0.5)])
def test_cells_spare_most_pairs(spark, dims, share):
    """Points met by a query, of all there are; its neighbours are among them."""
    points = cloud(dims, 6000, 10 + dims)
    asked = spark.createDataFrame([(0, list(q)) for q in points[::100]], "g int, q array<double>")
    given = spark.createDataFrame([(0, list(p), 1) for p in points], "g int, p array<double>, w bigint")
    left, _ = nb.candidate_cells(asked, given, 5, dims)
    met = left.agg(F.sum("w")).first()[0]
    assert met < share * len(points) * len(points[::100])


def test_groups_apart(spark):
    """Groups of one point, of few and of many; fewer than k points give all."""
    rows = [(g, [float(i), float(i * i % 7)], 1) for g, n in ((1, 1), (2, 3), (3, 500)) for i in range(n)]
    given = spark.createDataFrame(rows, "g int, p array<double>, w bigint")
    found = nb.nearest(given.select("g", F.col("p").alias("q")), given, 4, 2, exclude_self=True)
    counts = {r.g: (r.n, r.q) for r in found.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("q").alias("q")).collect()}
    assert counts == {2: (6, 3), 3: (2000, 500)}
    assert nb.nearest(given.select("g", F.col("p").alias("q")), given.limit(0), 4, 2).count() == 0


def test_smote_rows_lie_between_neighbours(spark):
    points = cloud(4, 300, 3)
    df = spark.createDataFrame([(i, *p, "big" if i % 4 else "small") for i, p in enumerate(points)], "id long, a double, b double, c double, d double, y string")
    made = nb.smote(df, "id", "y", ["a", "b", "c", "d"], 3).where("copy > 0").collect()
    small = np.array([p for i, p in enumerate(points) if i % 4 == 0])
    assert len(made) > 100
    for r in made:
        base, row = np.array(points[r.id]), np.array([r.a, r.b, r.c, r.d])
        order = np.argsort(((small - base) ** 2).sum(1))[1:4]
        steps = [np.dot(row - base, n - base) / np.dot(n - base, n - base) for n in small[order]]
        assert any(-1e-9 <= t <= 1 + 1e-9 and np.allclose(base + t * (n - base), row) for t, n in zip(steps, small[order]))


def test_blocks_and_few_rows_of_each_cell(spark, monkeypatch):
    """Blocks cut by Spark and halved in tasks; of a cell at most k points leave its task, and all of the nearest do."""
    monkeypatch.setattr(nb, "FULL_BLOCK", 300)
    points = cloud(3, 1500, 4)
    queries = points[::50]
    asked = spark.createDataFrame([(0, list(q)) for q in queries], "g int, q array<double>")
    given = spark.createDataFrame([(0, list(p), 1) for p in points], "g int, p array<double>, w bigint")
    left, cells = nb.candidate_cells(asked, given, 4, 3)
    assert cells.agg(F.sum("w")).first()[0] == len(points) and cells.agg(F.max(F.size("ps"))).first()[0] <= nb.FULL_CELL
    assert nb._met(left, cells, 4, 3).count() <= 4 * left.count()
    got = {q: [] for q in queries}
    for r in sorted(nb.nearest(asked, given, 4, 3).collect(), key=lambda r: r.place):
        got[tuple(r.q)].append(tuple(r.p))
    assert got == {q: sorted(points, key=lambda p: (sum((a - b) ** 2 for a, b in zip(p, q)) ** 0.5, p))[:4] for q in queries}


def test_smote_reads_its_rows_once(spark):
    """Features may be dear, such as figures of texts."""
    seen = spark.sparkContext.accumulator(0)

    def figure(i):
        seen.add(1)
        return float(i * i % 17)

    rows = spark.range(40).select("id", (F.col("id") < 8).cast("int").alias("label"), F.udf(figure, "double")("id").alias("x"))
    assert nb.smote(rows, "id", "label", ["x"], 3).count() == 64
    assert seen.value == 40
