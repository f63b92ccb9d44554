import math

import pytest
from pyspark.sql import functions as F

from tablewright.operators import active as al
from tablewright.operators import cleaning, labeling as lb


def test_fills(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, None), (3, float("nan"), "b"), (4, 4.0, "b"), (5, 7.0, None)],
                               "id long, v double, s string")
    mean = {r["id"]: r["v"] for r in cleaning.fill_mean(df, ["v"]).collect()}
    assert mean[2] == mean[3] == 4.0
    median = {r["id"]: r["v"] for r in cleaning.fill_median(df.where("id < 5"), ["v"]).collect()}
    assert median[2] == median[3] == 2.5
    mode = {r["id"]: r["s"] for r in cleaning.fill_mode(df, ["s"]).collect()}
    assert mode[2] == mode[5] == "b"


def test_interpolation(spark):
    df = spark.createDataFrame([("a", 0, None), ("a", 1, 1.0), ("a", 2, None), ("a", 4, 4.0), ("a", 5, None)],
                               "g string, t long, v double")
    got = {r["t"]: r["v"] for r in cleaning.fill_interpolate(df, "t", "v", ["g"]).collect()}
    assert got == {0: None, 1: 1.0, 2: 2.0, 4: 4.0, 5: 4.0}


def test_oversampling_balances_and_splits_large_copies(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "COPY_BLOCK", 7)
    df = spark.createDataFrame([(i, "big" if i < 101 else "small") for i in range(104)], "id long, y string")
    out = cleaning.oversample(df, ["id"], "y")
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {"big": 101, "small": 101}
    assert out.groupBy("id", "copy").count().where("count > 1").count() == 0


def test_undersampling(spark):
    df = spark.createDataFrame([(i, "big" if i < 50 else "small") for i in range(57)], "id long, y string")
    out = cleaning.undersample(df, ["id"], "y")
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {"big": 7, "small": 7}


def test_strategy_order_and_log(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a", "p"), (2, 1.0, "a", "p"), (3, None, "a", "q"), (4, 900.0, None, "q"), (5, 2.0, "b", None), (6, 3.0, "a", "p")],
        "id long, v double, s string, y string",
    )
    table, log = cleaning.apply_strategy(
        df, {"duplicates": "drop_exact", "missing": {"numeric": "fill_median", "categorical": "fill_mode"},
             "outliers": {"method": "clip_iqr"}}, "id", "y")
    steps = [(r["step"], r["rows"]) for r in log.orderBy("place").collect()]
    assert steps == [("original", 6), ("drop_exact", 5), ("drop_missing_target", 4), ("fill_median", 4), ("fill_mode", 4), ("clip_iqr", 4)]
    got = {r["id"]: (r["v"], r["s"]) for r in table.collect()}
    assert got[3] == (3.0, "a") and got[4][1] == "a" and got[4][0] < 900.0


def test_split_sizes(spark):
    df = spark.range(807).select("id", F.when(F.col("id") < 464, "liked").otherwise("not_liked").alias("y"))
    got = al.stratified_split(df, "id", "y").collect()
    sizes = {}
    for r in got:
        sizes[r["split"]] = sizes.get(r["split"], 0) + 1
    assert sizes == {"test": 162, "init": 50, "pool": 595}
    assert len({r["id"] for r in got}) == 807
    assert sum(r["split"] == "test" and r["y"] == "liked" for r in got) == 93


def test_tfidf(spark):
    df = spark.createDataFrame([(1, "cat cat dog"), (2, "dog bird")], "id long, t string")
    vocab = {r["term"]: r["idf"] for r in al.vocabulary(df, "t", max_n=1).collect()}
    assert vocab["cat"] == pytest.approx(1.4055, abs=1e-4) and vocab["dog"] == 1.0
    f = al.TextFeatures.fit(df, "t", max_n=1)
    row = f.transform(df).where("id = 1").first()["features"]
    weights = {f.terms[i]: v for i, v in zip(row["indices"], row["values"])}
    cat, dog = (1 + math.log(2)) * (math.log(3 / 2) + 1), 1.0
    assert weights["cat"] == pytest.approx(cat / math.hypot(cat, dog))
    assert sum(v * v for v in weights.values()) == pytest.approx(1.0)


@pytest.fixture(scope="module")
def texts(spark):
    data = []
    for i in range(120):
        y = "liked" if i % 3 else "not_liked"
        words = ["lovely rose", "warm musk"] if y == "liked" else ["harsh smoke", "cheap soap"]
        data.append((i, f"{words[i % 2]} note{i % 7}", y))
    return spark.createDataFrame(data, "id long, t string, y string")


def test_linear_model_solves_the_penalised_problem(spark, texts):
    f = al.TextFeatures.fit(texts, "t")
    rows = f.transform(texts)
    m = al.TextModel.fit(rows, "y", len(f.terms))
    assert m.classes == ["liked", "not_liked"]
    scored = m.transform(rows)
    assert scored.where("prediction <> y").count() == 0
    # gradient of 1/2 |w|^2 + C * sum(loss) is close to zero at the optimum
    w, grad = m.weights[0], list(m.weights[0])
    for r in scored.collect():
        p = r["probabilities"][1] - (r["y"] == "not_liked")
        for i, v in zip(r["features"]["indices"], r["features"]["values"]):
            grad[i] += p * v
    assert max(abs(g) for g in grad) < 1e-2 and max(abs(x) for x in w) > 0.5


def test_three_classes_sum_to_one(spark, texts):
    three = texts.withColumn("y", F.when(F.col("id") % 5 == 0, "mixed").otherwise(F.col("y")))
    f = al.TextFeatures.fit(three, "t")
    scored = al.TextModel.fit(f.transform(three), "y", len(f.terms), max_iter=20).transform(f.transform(three))
    for r in scored.limit(5).collect():
        assert len(r["probabilities"]) == 3 and sum(r["probabilities"]) == pytest.approx(1.0)


def test_queries(spark):
    pool = spark.createDataFrame([(i, [p, 1 - p]) for i, p in enumerate((0.9, 0.5, 0.6, 0.1, 0.5))], "id long, probabilities array<double>")
    pick = lambda s, k: [r["id"] for r in al.query(pool, s, k, "id").collect()]
    assert pick("entropy", 3) == [1, 4, 2]
    assert pick("margin", 2) == [1, 4]
    assert len(pick("random", 99)) == 5
    assert pick("random", 3) == pick("random", 3)
    with pytest.raises(ValueError):
        al.query(pool, "best", 1, "id")


def test_cycle_and_savings(spark, texts):
    split = al.stratified_split(texts, "id", "y", n_init=12)
    e = al.Experiment.prepare(split, "id", "t", "y", max_iter=30)
    history = e.run("entropy", rounds=1, batch=5).unionByName(e.run("random", rounds=1, batch=5))
    got = [(r["strategy"], r["iteration"], r["n_labeled"]) for r in history.orderBy("strategy", "iteration").collect()]
    assert got == [("entropy", 0, 12), ("entropy", 1, 17), ("random", 0, 12), ("random", 1, 17)]
    first = history.where("iteration = 0").select("accuracy", "f1").distinct()
    assert first.count() == 1  # both start from the same sets
    assert al.savings(history).first()["budget"] == 17


def test_savings_of_published_curves(spark):
    data = [("entropy", i, 50 + 10 * i, f) for i, f in enumerate((0.3647, 0.4, 0.55, 0.5982, 0.58, 0.5516))]
    data += [("random", i, 50 + 10 * i, 0.3647) for i in range(6)]
    row = al.savings(spark.createDataFrame(data, "strategy string, iteration int, n_labeled long, f1 double")).first()
    assert (row["n_needed"], row["saved_pct"], row["f1_gain"]) == (50, 50.0, 0.1869)


def test_review_sample_covers_each_kind_of_disagreement(spark):
    df = spark.range(400).select(
        "id", F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("x"), F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("y"),
        (F.col("id") / 400.0).alias("c"))
    out = lb.review_sample(df, "id", "x", "y", "c", size=20, low=5, per_pair=2)
    rows = out.collect()
    assert {0, 1, 2, 3, 4} <= {r["id"] for r in rows}
    assert {("a", "b"), ("b", "a")} <= {(r["x"], r["y"]) for r in rows}
    assert all(r["human_label"] is None for r in rows) and len({r["id"] for r in rows}) == len(rows)


@pytest.mark.parametrize("kind", ["logistic", "random_forest", "gradient_boosting", "svm"])
def test_alternative_classifiers_give_probabilities(spark, kind):
    df = spark.range(80).select(
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("c"), (F.col("id") % 10).cast("double").alias("v"),
        (F.col("id") % 2).cast("double").alias("label"))
    prepared = al.mixed_features(["c"], ["v"]).fit(df).transform(df)
    scored = al.with_probabilities(al.classifier(kind).fit(prepared).transform(prepared))
    for r in scored.collect():
        assert sum(r["probabilities"]) == pytest.approx(1.0) and r["prediction"] == r["label"]
    assert al.fit_checks(scored, "label").first()["degenerate"] is False


def test_unknown_classifier():
    with pytest.raises(ValueError):
        al.classifier("oracle")
