"""Missing at random, exact tails, correlations of many columns, seasons, sketches and kept reports."""

import datetime
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import compare, missingness, profile, sketches
from tablewright.sources import reports as rp


def gaps(n, seed, systematic):
    """Three related columns; values of the last two go missing by chance or where the first is large."""
    rng = np.random.default_rng(seed)
    a = rng.normal(size=n)
    b = 0.6 * a + rng.normal(size=n)
    c = a - b + 2 * rng.normal(size=n)
    gone_b = (a > 0.7) if systematic else rng.random(n) < 0.25
    gone_c = rng.random(n) < 0.2
    rows = []
    for i in range(n):
        rows.append((float(a[i]) if rng.random() > 0.1 else None, None if gone_b[i] else float(b[i]), float("nan") if gone_c[i] else float(c[i])))
    return rows


def slow_little(rows):
    """The same test row by row, EM included."""
    x = np.array([[np.nan if v is None else v for v in r] for r in rows], dtype=float)
    x = x[~np.isnan(x).all(axis=1)]
    p = x.shape[1]
    x = (x - np.nanmean(x, axis=0)) / np.nanstd(x, axis=0)
    mean, cov = np.zeros(p), np.eye(p)
    for _ in range(3000):
        filled, extra = x.copy(), np.zeros((p, p))
        for i, row in enumerate(x):
            m, o = np.isnan(row), ~np.isnan(row)
            if m.any():
                slope = cov[np.ix_(m, o)] @ np.linalg.inv(cov[np.ix_(o, o)])
                filled[i, m] = mean[m] + slope @ (row[o] - mean[o])
                extra[np.ix_(m, m)] += cov[np.ix_(m, m)] - slope @ cov[np.ix_(o, m)]
        new = filled.mean(axis=0)
        new_cov = ((filled - new).T @ (filled - new) + extra) / len(x)
        done = max(abs(new - mean).max(), abs(new_cov - cov).max()) < 1e-10
        mean, cov = new, new_cov
        if done:
            break
    total, degrees, kinds = 0.0, -p, {}
    for row in x:
        kinds.setdefault(tuple(np.isnan(row)), []).append(row)
    for gone, own in kinds.items():
        o = ~np.array(gone)
        away = np.mean([r[o] for r in own], axis=0) - mean[o]
        total += len(own) * away @ np.linalg.inv(cov[np.ix_(o, o)]) @ away
        degrees += int(o.sum())
    return len(kinds), total, degrees


@pytest.mark.parametrize("systematic", [False, True])
def test_missing_at_random(spark, systematic):
    rows = gaps(250, 5, systematic)
    df = spark.createDataFrame(rows + [(None, None, float("nan"))], "a double, b double, c double").repartition(3)
    got = missingness.missing_at_random(df, ["a", "b", "c"]).first()
    n, statistic, degrees = slow_little(rows)
    assert (got.n_patterns, got.degrees) == (n, degrees)
    assert got.statistic == pytest.approx(statistic, rel=1e-4)
    assert got.at_random == (not systematic)


def test_missing_at_random_of_whole_tables(spark):
    whole = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "a double, b double")
    assert tuple(missingness.missing_at_random(whole, ["a", "b"]).first()) == (1, 0.0, 0, None, None)
    assert missingness.missing_at_random(whole.limit(0), ["a", "b"]).first().pvalue is None
    # two groups apart by hand: 4 * (1 - 0)^2 / 2 + 4 * (-1 - 0)^2 / 2, one degree
    hand = spark.createDataFrame(
        [(x, y) for x, y in [(0.0, 1.0), (2.0, 3.0), (2.0, 2.0), (0.0, 5.0), (-2.0, None), (0.0, None), (0.0, None), (-2.0, None)]], "a double, b double"
    )
    got = missingness.missing_at_random(hand, ["a", "b"]).first()
    assert got.statistic == pytest.approx(4.0) and got.degrees == 1 and got.pvalue == pytest.approx(math.erfc(math.sqrt(2.0)))
    with pytest.raises(ValueError):
        missingness.missing_at_random(hand, ["a"] * 13)


def test_chi_square_tail():
    for x in (0.01, 0.5, 1.0, 3.84, 10.0, 60.0):
        assert missingness.chi_square_tail(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-9)
        assert missingness.chi_square_tail(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-9)
        assert missingness.chi_square_tail(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-9)


def all_paths(reach, n1, n2):
    """Share of paths that leave the band, by counting all cells."""
    ways = [[0] * (n2 + 1) for _ in range(n1 + 1)]
    for i in range(n1 + 1):
        for j in range(n2 + 1):
            if abs(i * n2 - j * n1) < reach:
                ways[i][j] = 1 if i == j == 0 else (ways[i - 1][j] if i else 0) + (ways[i][j - 1] if j else 0)
    return 1 - ways[n1][n2] / math.comb(n1 + n2, n1)


def test_exact_tail_equals_all_paths():
    pick = random.Random(1)
    for _ in range(60):
        n1, n2 = pick.randrange(1, 14), pick.randrange(1, 14)
        reach = pick.randrange(1, n1 * n2 + 1)
        d = reach / (n1 * n2)
        common = math.lcm(n1, n2)
        step = round(d * common) * n1 * n2 // common
        if step:
            assert compare.ks_p_value(d, n1, n2, "exact") == pytest.approx(all_paths(step, n1, n2), abs=1e-12)


def test_exact_tail_of_large_samples():
    """A million rows a side, with equal sizes and with others, next to the limit distribution."""
    began = time.time()
    for n1, n2, d in ((10**6, 10**6, 0.0017), (10**6, 10**6 - 1, 0.0012), (931, 10**6, 0.04), (10**6, 10**6 - 1, 0.3)):
        exact, limit = (compare.ks_p_value(d, n1, n2, m) for m in ("exact", "asymptotic"))
        assert exact == pytest.approx(limit, rel=0.03, abs=1e-12)
    assert time.time() - began < 60


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 120)) + rng.normal(size=(700, 1)) * np.linspace(0, 2, 120) + 1e6
    x[rng.random(x.shape) < 0.15] = np.nan
    x[:, 7] = 5.0
    x[:, 8] = np.nan
    x[1:, 9] = np.nan
    names = [f"c{i}" for i in range(120)]
    rows = [tuple(None if math.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(6)
    got = {(r.x, r.y): r.r for r in profile.correlation_matrix(df, names).collect()}
    assert len(got) == 120 * 119 // 2
    for i in range(120):
        for j in range(i + 1, 120):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            r = got[(names[i], names[j])]
            if {i, j} & {7, 8, 9}:
                assert r is None
            else:
                assert r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert {r.r for r in profile.correlation_matrix(df.limit(0), names[:3]).collect()} == {None}


def test_seasonal_parts(spark):
    """A line plus a yearly wave comes apart; empty months count as zero."""
    first = datetime.date(2020, 1, 15)
    wave = [5, 1, -4, 0, 3, -2, 6, -1, -3, -5, 2, -2]
    rows = []
    for m in range(48):
        day = datetime.date(first.year + m // 12, m % 12 + 1, 3)
        rows += [("a", day, 100.0 + 2 * m + wave[m % 12])]
    rows += [("b", datetime.date(2021, 1, 1), 4.0), ("b", datetime.date(2021, 4, 30), 6.0), (None, datetime.date(2021, 1, 1), 1.0), ("a", None, 9.0)]
    df = spark.createDataFrame(rows, "g string, d date, v double").repartition(4)
    got = {(r.g, r.month.isoformat()[:7]): r for r in profile.seasonal_parts(df, "d", ["g"], "v").collect()}
    assert len(got) == 48 + 4 + 1
    for m in range(48):
        r = got[("a", f"{2020 + m // 12}-{m % 12 + 1:02d}")]
        assert r.season == pytest.approx(wave[m % 12])
        if 6 <= m < 42:
            assert r.trend == pytest.approx(100.0 + 2 * m) and r.rest == pytest.approx(0, abs=1e-9)
        else:
            assert r.trend is None and r.rest is None
    assert [got[("b", f"2021-0{m}")].total for m in (1, 2, 3, 4)] == [4.0, 0.0, 0.0, 6.0] and got[("b", "2021-02")].season is None
    counts = profile.seasonal_parts(df, "d").collect()
    assert sum(r.total for r in counts) == 51


def test_sketches_merge(spark, tmp_path):
    rows = [(i % 30, f"u{i * i % 4001}", float(i % 977)) for i in range(30_000)] + [(99, None, None), (98, "u", float("nan"))]
    df = spark.createDataFrame(rows, "part int, user string, v double")
    sketches.sketch_parts(df, ["part"], ["user"], ["v"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    whole = sketches.merged(stored, [], ["user"], ["v"], [0.1, 0.5, 0.99]).first()
    users = len({u for _, u, _ in rows if u})
    assert whole.n_rows == len(rows) and abs(whole.n_user - users) <= sketches.DISTINCT_ERROR * users
    values = sorted(v for _, _, v in rows if v is not None and v == v)
    for q, got in zip([0.1, 0.5, 0.99], whole.q_v):
        rank = sum(v <= got for v in values) / len(values)
        assert abs(rank - q) <= sketches.RANK_ERROR + 1 / 977
    some = {r.part: r for r in sketches.merged(stored.where("part IN (3, 99)"), ["part"], ["user"], ["v"], [0.5]).collect()}
    assert some[3].n_rows == 1000 and some[99].n_user == 0 and some[99].q_v in (None, [None])


def test_report_in_place(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "kept")
    one = spark.createDataFrame([((1, ("x", 2.5)), [1, 2], "old")], "a struct<n:int,in:struct<s:string,f:double>>, l array<int>, t string")
    assert rp.current_report(spark, path) is None and rp.update_report(spark, path, one) == 1
    early = rp.current_report(spark, path)
    two = spark.createDataFrame([((("é", None, 7),), [3], 8)], "a struct<in:struct<s:string,f:double,new:int>>, l array<int>, u long")
    assert rp.update_report(spark, path, two) == 2
    assert rp.current_report(spark, path).first().asDict(recursive=True) == {
        "a": {"n": 1, "in": {"s": "é", "f": 2.5, "new": 7}}, "l": [3], "t": "old", "u": 8,
    }
    # a reader of the old version goes on, and a writer that died leaves it current
    assert early.first().t == "old" and early.first().a["in"].s == "x"
    rp.write_report(one, f"{path}/_died")
    assert rp.current_report(spark, path).first().u == 8
    # a number that is taken is never written over
    assert not rp._renamed(spark, f"{path}/_died", f"{path}/version=000002")
    # a writer that read an older version than it finds merges again
    known, seen = rp._versions, [[1]]
    monkeypatch.setattr(rp, "_versions", lambda *a: seen.pop() if seen else known(*a))
    assert rp.update_report(spark, path, spark.range(1).select(F.lit(5).alias("w"))) == 3
    last = rp.current_report(spark, path).first().asDict()
    assert last["w"] == 5 and last["u"] == 8 and last["t"] == "old"
