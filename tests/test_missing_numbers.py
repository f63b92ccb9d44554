"""NaN counts as missing: each operator gives for a column with NaN what it gives with NULL."""

import math

import pytest
from pyspark.sql import functions as F

from tablewright.functions import masks
from tablewright.operators import cleaning, compare, neighbors, ordered, profile, skew

VALUES = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 7.0, 90.0]


def tables(spark):
    nan = [(i, v, float(i % 3)) for i, v in enumerate([*VALUES, float("nan"), float("nan")])]
    null = [(i, None if math.isnan(v) else v, g) for i, v, g in nan]
    schema = "id bigint, v double, g double"
    return spark.createDataFrame(nan, schema), spark.createDataFrame(null, schema)


OPERATORS = {
    "quantiles": lambda df: ordered.exact_quantiles(df, "v", {"q": 0.25, "m": 0.5}),
    "flag_iqr": lambda df: cleaning.flag_outliers(df, "v").select("id", "is_outlier"),
    "flag_zscore": lambda df: cleaning.flag_outliers(df, "v", "zscore", 2.0).select("id", "is_outlier"),
    "clip_iqr": lambda df: cleaning.clip_outliers(df, ["v"]),
    "clip_both": lambda df: cleaning.clip_outliers(df, ["v", "g"]),
    "clip_zscore": lambda df: cleaning.clip_outliers(df, ["v"], "zscore", 1.0),
    "remove_iqr": lambda df: cleaning.remove_outliers(df, ["v"]).select("id"),
    "remove_zscore": lambda df: cleaning.remove_outliers(df, ["v"], "zscore", 2.0).select("id"),
    "profile": lambda df: profile.numeric_profile(df, ["v", "g"]),
    "outlier_counts": lambda df: profile.outlier_counts(df, ["v", "g"], limit=2.0),
    "histogram": lambda df: profile.histogram(df, "v", 4),
    "density": lambda df: profile.density_curve(df, "v", 5),
    "box": lambda df: profile.box_stats(df, "v"),
    "box_by": lambda df: profile.box_stats(df, "v", ["g"]),
    "pearson": lambda df: profile.pearson(df, "v", "g"),
    "correlation": lambda df: profile.correlation_matrix(df, ["v", "g", "id"]),
    "interpolate": lambda df: cleaning.fill_interpolate(df, "id", "v"),
    "knn": lambda df: neighbors.fill_knn(df, "id", "g", ["v"], 2),
    "ks": lambda df: compare.ks_two_sample(df, df.where("id < 5"), F.col("v")),
    "duplicates": lambda df: profile.full_duplicates(df.select("v")),
    "mean": lambda df: cleaning.fill_mean(df, ["v"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_nan_is_missing(spark, name):
    def plain(df):
        value = lambda x: None if isinstance(x, float) and math.isnan(x) else round(x, 9) if isinstance(x, float) else x
        return sorted((tuple(value(x) for x in r) for r in OPERATORS[name](df).drop("v" if name == "knn" else "_").collect()), key=repr)

    with_nan, with_null = map(plain, tables(spark))
    assert with_nan == with_null
    if name not in ("knn", "interpolate", "clip_iqr", "clip_both", "clip_zscore", "duplicates"):
        assert all(x is not None for row in with_null for x in row)


def test_duplicates_count_microseconds_and_signed_zeros(spark):
    df = spark.sql("""SELECT * FROM VALUES (timestamp'2024-01-01 00:00:00.000001', 0.0D), (timestamp'2024-01-01 00:00:00.000002', 0.0D),
        (timestamp'2024-01-01 00:00:00.000002', -0.0D), (NULL, NULL), (NULL, double('NaN')) t(ts, v)""")
    assert profile.full_duplicates(df).first()["n_duplicates"] == 2
    kept = cleaning.drop_subset(df.withColumn("id", F.monotonically_increasing_id()), ["ts", "v"], "id")
    assert kept.count() == 3


def test_number():
    assert "nanvl" in str(masks.number("v")).lower()


def test_hot_key_is_spread_by_its_share(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(20_000).select(
            "id", F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise(F.col("id").cast("string")).alias("k")
        )
        counted = skew.with_key_count(df, ["k"], ["id"])
        parts = counted.where("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
        assert parts >= 8
        assert counted.where("k = 'hot' AND n = 10000").count() == 10_000
        assert counted.where("k IS NULL AND n IS NULL").count() == 200
        assert counted.count() == 20_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_drop_subset_of_missing_and_repeated_ids(spark):
    rows = [(1, "a", "x"), (1, "a", "y"), (None, "a", "z"), (None, "b", "z"), (None, "b", "y"), (3, None, "n"), (2, None, "m"), (4, "c", "q"), (4, "c", "q")]
    df = spark.createDataFrame(rows, "id int, k string, v string").repartition(3)
    got = cleaning.drop_subset(df, ["k"], "id").collect()
    assert sorted((r.id or 0, r.k or "") for r in got) == [(0, "b"), (1, "a"), (2, ""), (4, "c")]
    assert {r.k: r.v for r in got if r.k in (None, "c")} == {None: "m", "c": "q"}
