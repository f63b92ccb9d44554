import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import ordered, profile, sampling, skew


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, many values are copies."""
    rng = random.Random(7)
    data = [
        (i, "hot" if i % 3 == 0 else (None if i % 11 == 0 else f"k{i % 40}"), 5.0 if i % 4 == 0 else rng.random() * 100)
        for i in range(3000)
    ]
    return spark.createDataFrame(data, "id long, k string, v double").repartition(4)


def test_running_totals_equal_a_global_window(skewed):
    got = {r["id"]: r["_n_cum"] for r in ordered.running_totals(
        skewed.withColumn("_n", F.lit(1)), "id", ["_n"], slices=7).collect()}
    assert got == {i: i + 1 for i in range(3000)}


def test_numbers_are_dense(skewed):
    got = sorted((r["id"], r["n"]) for r in ordered.number_rows(skewed.where("id % 5 = 2"), "id", "n").collect())
    assert [n for _, n in got] == list(range(1, len(got) + 1))


@pytest.mark.parametrize("groups", [[], ["k"]])
def test_quantiles_equal_numpy(skewed, groups):
    local = {}
    for r in skewed.collect():
        local.setdefault(r["k"] if groups else "all", []).append(r["v"])
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    for r in ordered.exact_quantiles(skewed, "v", shares, groups, slices=9).collect():
        values = local[r["k"] if groups else "all"]
        for name, share in shares.items():
            assert r[name] == pytest.approx(np.quantile(values, share), abs=1e-9)


def test_quantile_of_the_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert ordered.exact_quantiles(df, "v", {"q": 0.25}).first()["q"] == 1.75


def test_iqr_fixture(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 100)] + [(None,)], "v double")
    b = profile.iqr_bounds(df, "v").first()
    assert (b["q1"], b["q3"], b["lo"], b["hi"]) == (2.0, 4.0, -1.0, 7.0)


@pytest.mark.parametrize("forward", [True, False])
def test_carry_equals_a_loop(skewed, forward):
    df = skewed.withColumn("x", F.when(F.col("id") % 7 == 3, F.col("v")))
    got = {r["id"]: r["y"] for r in ordered.carry(
        df, "id", "x", **{"before" if forward else "after": "y"}, groups=["k"], slices=6).collect()}
    assert len(got) == 3000
    last, want = {}, {}
    rows = sorted(df.collect(), key=lambda r: r["id"], reverse=not forward)
    for r in rows:
        if r["x"] is not None:
            last[r["k"]] = r["x"]
        want[r["id"]] = last.get(r["k"])
    assert got == want


def test_key_counts_on_rows(skewed):
    got = {r["id"]: r["n"] for r in skew.with_key_count(skewed, ["k"], ["id"]).collect()}
    counts = {}
    rows = skewed.collect()
    for r in rows:
        counts[r["k"]] = counts.get(r["k"], 0) + 1
    assert got == {r["id"]: None if r["k"] is None else counts[r["k"]] for r in rows}


def test_hot_rows_are_spread(spark, skewed):
    """The hot key reaches many shuffle partitions instead of one."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counted = skew.with_key_count(skewed, ["k"], ["id"])
        sizes = counted.where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(sizes) == 4
        assert max(r["count"] for r in sizes) < 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_quotas_are_exact_and_repeatable(skewed):
    counts = skewed.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    quotas = counts.select("k", F.least("n", F.lit(13)).cast("bigint").alias("first"),
                           F.lit(9).cast("bigint").alias("second"))
    def run():
        out = sampling.assign_by_quota(skewed, ["id"], "k", quotas, ["first", "second"], "rest", 3)
        return {r["id"]: (r["k"], r["split"]) for r in out.collect()}

    one = run()
    assert one == run()
    assert len(one) == skewed.where("k IS NOT NULL").count()
    sizes = {}
    for k, part in one.values():
        sizes[(k, part)] = sizes.get((k, part), 0) + 1
    for r in counts.collect():
        assert sizes[(r["k"], "first")] == min(r["n"], 13)
        assert sizes[(r["k"], "second")] == min(9, r["n"] - 13)


def test_largest_remainder(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 3), ("c", 2)], "s string, n long")
    got = {r["s"]: r["q"] for r in sampling.largest_remainder(counts, "s", "n", F.lit(7), "q").collect()}
    assert got == {"a": 4, "b": 2, "c": 1}
