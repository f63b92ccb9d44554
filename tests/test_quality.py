import pytest
from pyspark.sql import functions as F

from tablewright.functions import masks
from tablewright.operators import cleaning, profile, quality

ROLES = {"text": "t", "key": "r", "group": "p", "target": "rating"}


@pytest.fixture(scope="module")
def table(spark):
    data = [
        (1, "A", "u1", 4.0, "x" * 60),
        (2, "A", "u1", 4.0, "y" * 80),
        (3, "A", "u2", 4.0, "bad ??? " + "w" * 60),
        (4, "B", "u3", 3.5, "short"),
        (5, "B", None, 3.5, "z" * 50),
        (6, "B", None, 3.5, None),
        (7, "B", "u4", 3.5, "�?�"),
        (8, "A", "u5", 4.0, "??" + "k" * 47),
    ]
    return spark.createDataFrame(data, "id long, p string, r string, rating double, t string")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_masks(table):
    damaged, short = masks.damaged_text("t"), masks.short_text("t")
    assert ids(table.where(damaged)) == [3, 7]
    assert ids(table.where(short)) == [4, 7, 8]
    assert ids(table.where(short & ~damaged)) == [4, 8]
    # a row without text is neither, so it survives the negation
    assert 6 in ids(table.where(~damaged))


def test_duplicate_flag_ignores_missing_keys(table):
    flagged = profile.flag_duplicate_keys(table, "r", ["id"])
    assert ids(flagged.where("is_duplicate")) == [1, 2]
    assert flagged.count() == 8


def test_issues_and_score(table):
    found = {r["type"]: (r["count"], r["penalty"]) for r in quality.quality_issues(table, **ROLES).collect()}
    assert found == {
        "encoding_corruption": (2, 30.0),
        "short_review": (2, 15.0),
        "duplicate_reviewer": (2, 15.0),
        "perfume_level_rating": (2, 10.0),
        "missing_values": (3, 20.0),
    }
    report = quality.quality_report(table, **ROLES).first()
    assert (report["quality_score"], report["total_penalty"], report["n_rows"], report["n_cols"]) == (10.0, 90.0, 8, 5)
    assert report["issues"][-1]["pct"] == 7.5


def test_clean_table_has_full_score(spark):
    df = spark.createDataFrame([(1, "A", "u1", 4.0, "x" * 60), (2, "A", "u2", 3.0, "y" * 60)],
                               "id long, p string, r string, rating double, t string")
    report = quality.quality_report(df, **ROLES).first()
    assert report["quality_score"] == 100.0 and report["issues"] == []


def test_published_scores_follow_from_the_rules(spark):
    """Counts of the published report give its score of 30."""
    n = 931
    data = []
    for i in range(n):
        reviewer = f"dup{i // 2}" if i < 150 else ("dup0" if i == 150 else f"u{i}")
        text = "???" * 20 if i < 21 else ("short" if i < 48 else "good text " * 8)
        data.append((i, f"P{i % 8}", reviewer, float(i % 8), text))
    df = spark.createDataFrame(data, "id long, p string, r string, rating double, t string")
    report = quality.quality_report(df, **ROLES).first()
    issues = {i["type"]: (i["count"], i["pct"]) for i in report["issues"]}
    assert report["quality_score"] == 30.0 and report["total_penalty"] == 70.0
    assert issues["encoding_corruption"] == (21, 2.26)
    assert issues["short_review"] == (27, 2.9)
    assert issues["duplicate_reviewer"] == (151, 16.22)


def test_strategies(table):
    a = cleaning.strategy_conservative(table, "t", "r", "id")
    # id 6 has no text and shares the missing key with id 5, which is longer
    assert ids(a) == [2, 5]
    assert quality.strategy_metrics(table, a, **ROLES).first()["loss_pct"] == 75.0
    soft = cleaning.strategy_soft(table, "t")
    assert ids(soft) == [1, 2, 4, 5, 6, 8]
    assert ids(soft.where("is_short_review")) == [4, 8]
    flagged = cleaning.strategy_flag_duplicates(table, "t", "r", "id")
    assert ids(flagged) == [1, 2, 5, 6]
    assert ids(flagged.where("is_duplicate_reviewer")) == [1, 2]
    assert quality.strategy_metrics(table, flagged, **ROLES).first()["loss_pct"] == 50.0


def test_longest_text_per_hot_key(spark):
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.expr("repeat('a', int(id % 97))").alias("t"),
    )
    kept = cleaning.keep_longest(df, ["k"], "t", "id")
    assert kept.count() == df.select("k").distinct().count()
    best = kept.where("k = 0").first()
    assert len(best["t"]) == 96
    # the partial limit keeps one row per key and map task before the shuffle
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_group_constant(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 1.0), ("B", None), (None, 9.0)], "g string, v double")
    assert profile.group_constant(df, "g", "v").first()["is_constant"] is False
    assert profile.group_constant(df.where("g = 'A'"), "g", "v").first()["is_constant"] is True
    assert profile.group_constant(df.where("g = 'Z'"), "g", "v").first()["is_constant"] is True


def test_scan_of_any_table(spark):
    data = [(i, float(i % 10) if i != 7 else 1000.0, None if i < 5 else "x", "a" if i < 16 else "b") for i in range(20)]
    df = spark.createDataFrame(data, "id long, v double, s string, y string")
    found = {(r["type"], r["column"]): r["count"] for r in quality.detect_all(df, "y").collect()}
    assert found[("missing", "s")] == 5
    assert found[("outliers_iqr", "v")] == 1 and found[("outliers_zscore", "v")] == 1
    assert found[("imbalance", "y")] == 16
