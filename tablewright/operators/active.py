"""Active learning: split, TF-IDF, logistic regression, queries, learning curves."""

from __future__ import annotations

import json
import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tablewright.functions import scalars
from tablewright.operators import profile, terms
from tablewright.operators.agreement import class_report
from tablewright.operators.sampling import assign_by_quota, largest_remainder
from tablewright.operators.skew import row_hash
from tablewright.session import cut_lineage


def stratified_split(
    df: DataFrame, row_id: str, stratify: str, test_share: float = 0.2, n_init: int = 50,
    seed: int = 42, out: str = "split",
) -> DataFrame:
    """Add ``test``, ``init`` or ``pool``: exact sizes, each in proportion to the strata.

    The test part has ``ceil(test_share * n)`` rows, the initial part
    ``n_init`` of the others. Rows without a stratum are dropped.
    """
    counts = profile.value_counts(df, stratify, out="_n")
    total = counts.agg(F.sum("_n")).scalar()
    n_test = F.ceil(F.lit(test_share) * total)
    with_test = cut_lineage(largest_remainder(cut_lineage(counts), stratify, "_n", n_test, "test"))
    left = with_test.withColumn("_left", F.col("_n") - F.col("test"))
    quotas = largest_remainder(left, stratify, "_left", F.lit(n_init), "init")
    return assign_by_quota(df, [row_id], stratify, quotas, ["test", "init"], "pool", seed, out)


def term_statistics(df: DataFrame, text: str, max_n: int = 2) -> DataFrame:
    """Total frequency and document frequency of every term, combined before the shuffle."""
    return terms.term_counts(df, text, max_n)


def vocabulary(df: DataFrame, text: str, max_features: int = 5000, max_n: int = 2) -> DataFrame:
    """The most frequent terms with their smoothed inverse document frequency."""
    n = df.where(F.col(text).isNotNull()).agg(F.count(F.lit(1))).scalar()
    idf = F.ln((n + 1.0) / (F.col("df") + 1.0)) + 1.0
    return terms.frequent_terms(df, text, max_features, max_n).withColumn("idf", idf)


def _constant(values: Sequence[float]) -> Column:
    """An array literal that Spark folds into one constant."""
    return F.from_json(F.lit(json.dumps([float(v) for v in values])), "array<double>")


@dataclass(frozen=True)
class TextFeatures:
    """A fitted vocabulary of at most ``max_features`` terms."""

    terms: list[str]
    idf: list[float]
    text: str
    max_n: int = 2

    @classmethod
    def fit(cls, df: DataFrame, text: str, max_features: int = 5000, max_n: int = 2) -> "TextFeatures":
        rows = vocabulary(df, text, max_features, max_n).orderBy("term").collect()
        return cls([r["term"] for r in rows], [r["idf"] for r in rows], text, max_n)

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Add the sparse unit-length vector ``(indices, values)``; no shuffle."""
        return df.withColumn(out, terms.weighted_vectors(self.text, self.terms, self.idf, self.max_n))


ROWS_PER_FIT_TASK = 20_000  # shapes the plan only


def _to_vector(size: int, features: str) -> Column:
    """The vector of ``(indices, values)``, read from JSON inside the JVM."""
    sparse = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.col(f"{features}.indices").alias("indices"), F.col(f"{features}.values").alias("values"),
    )
    kind = T.StructType([T.StructField("vector", VectorUDT())])
    return F.from_json(F.to_json(F.struct(sparse.alias("vector"))), kind)["vector"]


@dataclass(frozen=True)
class TextModel:
    """A linear model over sparse features, applied as a column expression."""

    classes: list
    weights: list[list[float]]  # one row per class; binary models hold one row
    intercepts: list[float]

    @classmethod
    def fit(
        cls, df: DataFrame, label: str, n_features: int, c: float = 1.0, max_iter: int = 1000,
        features: str = "features",
    ) -> "TextModel":
        """L2-regularised logistic regression on the labeled rows, classes in ascending order."""
        n, classes = df.agg(
            F.count(F.lit(1)), F.array_sort(F.collect_set(label))
        ).first()
        names = F.array(*[F.lit(x) for x in classes])
        # training rows are few; fewer partitions make the many small iterations cheaper. The
        # shuffle keeps the scan and filter above it as wide as the table
        parts = max(1, math.ceil(n / ROWS_PER_FIT_TASK))
        rows = df.select(
            (F.array_position(names, F.col(label)) - 1).cast("double").alias("label"), F.col(features).alias("f")
        ).repartition(parts).select("label", _to_vector(n_features, "f").alias("features"))
        if len(classes) == 1:
            return cls(list(classes), [[0.0] * n_features], [math.inf])
        model = LogisticRegression(
            regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=max_iter,
            tol=1e-6,
        ).fit(rows)
        if len(classes) == 2:
            return cls(list(classes), [model.coefficients.toArray().tolist()], [model.intercept])
        return cls(
            list(classes), model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist()
        )

    def _dot(self, weights: Sequence[float], intercept: float, features: str) -> Column:
        table = _constant(weights)
        products = F.zip_with(
            f"{features}.indices", f"{features}.values", lambda i, v: F.get(table, i) * v
        )
        return F.aggregate(products, F.lit(float(intercept)), lambda a, x: a + x)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Add ``probabilities`` (in class order) and ``prediction``."""
        if len(self.classes) == 1:
            p = F.array(F.lit(1.0))
        elif len(self.classes) == 2:
            up = F.lit(1.0) / (F.exp(-self._dot(self.weights[0], self.intercepts[0], features)) + 1.0)
            p = F.transform(F.array(up), lambda x: F.struct((F.lit(1.0) - x).alias("a"), x.alias("b")))
            p = F.flatten(F.transform(p, lambda s: F.array(s["a"], s["b"])))
        else:
            raw = F.array(*[self._dot(w, b, features) for w, b in zip(self.weights, self.intercepts)])
            shifted = F.transform(F.array(raw), lambda r: F.transform(r, lambda x: F.exp(x - F.array_max(r))))
            p = F.flatten(F.transform(
                shifted, lambda r: F.transform(r, lambda x: x / F.aggregate(r, F.lit(0.0), lambda a, y: a + y))))
        names = F.array(*[F.lit(x) for x in self.classes])
        scored = df.withColumn("probabilities", p)
        best = F.array_position("probabilities", F.array_max("probabilities"))
        return scored.withColumn("prediction", F.element_at(names, best.cast("int")))


STRATEGIES = ("entropy", "margin", "random")


def informativeness(
    scored: DataFrame, strategy: str, row_id: str, seed: int = 42, iteration: int = 0
) -> DataFrame:
    """Add ``score``; a larger score is asked for first."""
    if strategy == "entropy":
        score = scalars.entropy("probabilities")
    elif strategy == "margin":
        score = -scalars.margin("probabilities")
    elif strategy == "random":
        score = F.xxhash64(F.col(row_id), F.lit(seed), F.lit(iteration)).cast("double")
    else:
        raise ValueError(f"unknown query strategy {strategy!r}, choose one of {STRATEGIES}")
    return scored.withColumn("score", score)


def query(
    scored: DataFrame, strategy: str, k: int, row_id: str, seed: int = 42, iteration: int = 0
) -> DataFrame:
    """The ``k`` most informative pool rows, the whole pool where it is smaller; ties by id."""
    ranked = informativeness(scored, strategy, row_id, seed, iteration)
    return ranked.orderBy(F.desc("score"), F.asc(row_id)).limit(k)


def query_diagnostics(ranked: DataFrame, chosen: DataFrame, row_id: str) -> DataFrame:
    """Score range and mean of the chosen rows, of the rest and of the whole pool."""
    marked = ranked.join(
        chosen.select(row_id, F.lit(True).alias("_in")), row_id, "left"
    )
    inside = F.when(F.col("_in"), F.col("score"))
    outside = F.when(F.col("_in").isNull(), F.col("score"))
    return marked.agg(
        F.count(F.lit(1)).alias("pool_size"),
        F.count("_in").alias("selected"),
        F.min(inside).alias("selected_min"),
        F.max(inside).alias("selected_max"),
        F.min("score").alias("pool_min"),
        F.max("score").alias("pool_max"),
        F.avg(inside).alias("selected_mean"),
        F.min(outside).alias("rest_min"),
        F.max(outside).alias("rest_max"),
        F.avg(outside).alias("rest_mean"),
        F.avg("score").alias("pool_mean"),
    )


def top_queried(ranked: DataFrame, row_id: str, classes: Sequence, k: int = 5) -> DataFrame:
    """The ``k`` rows asked for first: id, score, likeliest class and the probability of each class."""
    names = F.array(*[F.lit(c) for c in classes])
    best = F.array_position("probabilities", F.array_max("probabilities")).cast("int")
    return ranked.orderBy(F.desc("score"), F.asc(row_id)).limit(k).select(
        row_id, "score", F.element_at(names, best).alias("predicted"), F.map_from_arrays(names, "probabilities").alias("by_class")
    )


def score_histogram(ranked: DataFrame, bins: int = 20) -> DataFrame:
    """Distribution of the scores over the pool."""
    return profile.histogram(ranked, "score", bins)


HISTORY = (
    "strategy string, iteration int, n_labeled bigint, accuracy double, f1 double, "
    "precision_macro double, recall_macro double, f1_per_class map<string,double>, "
    "mean_entropy double, fit_seconds double, eval_seconds double, evaluated_at timestamp, asked array<string>"
)


def _metrics(scored: DataFrame, label: str):
    """All figures of one evaluation in one row."""
    return class_report(scored, label, "prediction").agg(
        F.bround(F.sum("n_both").cast("double") / F.sum("support"), 4).alias("accuracy"),
        F.bround(F.avg("f1"), 4).alias("f1"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.map_from_entries(F.collect_list(F.struct(F.col("label").cast("string"), "f1"))).alias("per_class"),
        F.current_timestamp().alias("at"),
    ).first()


@dataclass
class Experiment:
    """Featurised rows shared by every strategy, so all start from the same sets."""

    rows: DataFrame  # row_id, label, split, features
    row_id: str
    label: str
    n_features: int
    max_iter: int = 1000

    @classmethod
    def prepare(
        cls, split: DataFrame, row_id: str, text: str, label: str, max_features: int = 5000,
        max_iter: int = 1000,
    ) -> "Experiment":
        """Fit the vocabulary on labeled and pool texts; keep the features in the shared folder.

        The split is stored first: the vocabulary and the features both read it.
        """
        held = cut_lineage(split.select(row_id, text, label, "split"))
        vectoriser = TextFeatures.fit(held.where("split <> 'test'"), text, max_features)
        features = vectoriser.transform(held).select(row_id, label, "split", "features")
        return cls(cut_lineage(features), row_id, label, len(vectoriser.terms), max_iter)

    def run(
        self, strategy: str, rounds: int = 5, batch: int = 10, seed: int = 42
    ) -> DataFrame:
        """Fit, evaluate, query and move, ``rounds`` times; one history row per fit.

        ``asked`` holds the ids that the round asked for, most informative first.
        Only the asked ids (at most ``rounds * batch``) live on the driver; the
        feature table never changes, so no lineage grows from round to round.
        """
        spark: SparkSession = self.rows.sparkSession
        rows, row_id = self.rows, self.row_id
        asked: list = []
        history = []
        n_init, n_pool = rows.agg(
            F.count_if(F.col("split") == "init"), F.count_if(F.col("split") == "pool")
        ).first()
        test = rows.where("split = 'test'")
        for iteration in range(rounds + 1):
            known = (F.col("split") == "init") | F.col(row_id).isin(asked)
            started = time.monotonic()
            model = TextModel.fit(rows.where(known), self.label, self.n_features, max_iter=self.max_iter)
            fitted = time.monotonic()
            m = _metrics(model.transform(test), self.label)
            measured = time.monotonic()
            # scored once: the mean entropy and the question read the narrow result
            pool = cut_lineage(
                model.transform(rows.where((F.col("split") == "pool") & ~F.col(row_id).isin(asked)))
                .select(row_id, "probabilities")
            )
            spread = pool.agg(F.avg(scalars.entropy("probabilities"))).first()[0]
            history.append(
                (strategy, iteration, n_init + len(asked), m["accuracy"], m["f1"], m["precision_macro"],
                 m["recall_macro"], m["per_class"], spread, fitted - started, measured - fitted, m["at"])
            )
            picked = []
            if iteration < rounds and n_pool - len(asked) >= batch:
                picked = [r[0] for r in query(pool, strategy, batch, row_id, seed, iteration).select(row_id).collect()]
            asked += picked
            history[-1] += ([str(i) for i in picked],)
        return spark.createDataFrame(history, HISTORY)


def compare_strategies(history: DataFrame, first: str = "entropy", second: str = "random") -> DataFrame:
    """One row per round with accuracy and F1 of both strategies and the F1 difference."""
    wide = history.groupBy("iteration", "n_labeled").pivot("strategy", [first, second]).agg(
        F.first("accuracy").alias("accuracy"), F.first("f1").alias("f1")
    )
    return wide.withColumn("f1_delta", F.col(f"{first}_f1") - F.col(f"{second}_f1"))


def round_deltas(history: DataFrame) -> DataFrame:
    """Change of accuracy and F1 from the round before, and whether F1 fell."""
    order = Window.partitionBy("strategy").orderBy("iteration")
    return history.withColumns(
        {
            "accuracy_delta": F.col("accuracy") - F.lag("accuracy").over(order),
            "f1_delta": F.col("f1") - F.lag("f1").over(order),
        }
    ).withColumn("degraded", F.coalesce(F.col("f1_delta") < 0, F.lit(False)))


def savings(history: DataFrame, first: str = "entropy", second: str = "random") -> DataFrame:
    """Labels saved at equal quality and F1 gained at equal budget."""
    ends = history.groupBy("strategy").agg(
        F.max_by("f1", "iteration").alias("final_f1"), F.max("n_labeled").alias("final_n")
    )
    pair = ends.agg(
        F.max(F.when(F.col("strategy") == first, F.col("final_f1"))).alias("first_f1"),
        F.max(F.when(F.col("strategy") == second, F.col("final_f1"))).alias("second_f1"),
        F.max(F.when(F.col("strategy") == second, F.col("final_n"))).alias("budget"),
    )
    goal = pair.select("second_f1").scalar()
    reached = history.where((F.col("strategy") == first) & (F.col("f1") >= goal)).agg(
        F.min("n_labeled")
    ).scalar()
    return pair.withColumn("n_needed", reached).select(
        "first_f1", "second_f1", "budget", "n_needed",
        F.bround((F.lit(1.0) - F.try_divide("n_needed", "budget")) * 100.0, 1).alias("saved_pct"),
        F.bround(F.col("first_f1") - F.col("second_f1"), 4).alias("f1_gain"),
        F.bround(F.try_divide(F.col("first_f1") - F.col("second_f1"), F.col("second_f1")) * 100.0, 1)
        .alias("f1_gain_pct"),
    )


def confidence_band(history: DataFrame, metric: str = "f1") -> DataFrame:
    """Mean and spread of a metric over repeated runs."""
    return history.groupBy("strategy", "n_labeled").agg(
        F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"), F.count(F.lit(1)).alias("runs")
    )


def probability_histogram(scored: DataFrame, label: str, index: int, bins: int = 20) -> DataFrame:
    """Distribution of one class probability by true class."""
    p = scored.select(label, F.get("probabilities", index).alias("p"))
    return profile.histogram(p, "p", bins, by=label, lo=0.0, hi=1.0)


def fit_checks(scored: DataFrame, label: str, flat_below: float = 1e-6, min_rows: int = 10) -> DataFrame:
    """Whether the probabilities are degenerate and which figures the smallest class has."""
    smallest = profile.value_counts(scored, label).agg(F.min("n")).scalar()
    # a model that learned nothing gives every row the same probabilities
    first, second = (F.stddev_pop(F.get("probabilities", i)) for i in (0, 1))
    return scored.agg(
        F.greatest(first, F.coalesce(second, F.lit(0.0))).alias("spread"), F.count(F.lit(1)).alias("n")
    ).select(
        "n", "spread", (F.col("spread") < flat_below).alias("degenerate"),
        smallest.alias("smallest_class"), (smallest < min_rows).alias("unstable"),
    )


def mixed_features(categorical: Sequence[str], numeric: Sequence[str], out: str = "features") -> Pipeline:
    """One pipeline for text categories (one-hot) and numbers (standardised)."""
    stages = []
    if categorical:
        index = [f"{c}_index" for c in categorical]
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=index, outputCols=[f"{c}_hot" for c in categorical], dropLast=False),
        ]
    if numeric:
        stages += [
            VectorAssembler(inputCols=list(numeric), outputCol="_numbers", handleInvalid="skip"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        ]
    parts = [f"{c}_hot" for c in categorical] + (["_scaled"] if numeric else [])
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol=out)])


def classifier(kind: str = "logistic", seed: int = 42, label: str = "label", features: str = "features"):
    """An estimator (or pipeline) whose model yields class probabilities."""
    roles = {"labelCol": label, "featuresCol": features}
    if kind == "logistic":
        return LogisticRegression(maxIter=1000, **roles)
    if kind == "random_forest":
        return RandomForestClassifier(seed=seed, **roles)
    if kind == "gradient_boosting":
        return GBTClassifier(seed=seed, **roles)
    if kind == "svm":
        # calibrate the margin with a one-feature logistic regression
        margin = LinearSVC(rawPredictionCol="_margin", predictionCol="_svm", **roles)
        calibrate = LogisticRegression(featuresCol="_margin", labelCol=label)
        return Pipeline(stages=[margin, calibrate])
    raise ValueError(f"unknown classifier {kind!r}")


def with_probabilities(predicted: DataFrame) -> DataFrame:
    """The probability vector of a fitted estimator as an array column."""
    return predicted.withColumn("probabilities", vector_to_array("probability"))
