"""Splits, TF-IDF, query strategies and active-learning rounds."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from tablewright.operators import active as al
from tablewright.plans.registry import labeled, near, query, scored_documents, table


def _quota_sql(source: str, stratum: str, share: float, n_init: int) -> str:
    """Sizes of the two-step split by largest remainder."""
    return f"""c AS (SELECT {stratum} AS s, count(*)::DOUBLE AS n FROM {source} WHERE {stratum} IS NOT NULL GROUP BY 1),
    t0 AS (SELECT s, n, ceil({share}::DOUBLE * (SELECT sum(n) FROM c)) AS size, n * ceil({share}::DOUBLE * (SELECT sum(n) FROM c)) / (SELECT sum(n) FROM c) AS x FROM c),
    t1 AS (SELECT *, floor(x) + (row_number() OVER (ORDER BY x - floor(x) DESC, s) <= size - (SELECT sum(floor(x)) FROM t0))::INT AS test FROM t0),
    i0 AS (SELECT s, n, test, (n - test) * {n_init}.0 / (SELECT sum(n - test) FROM t1) AS x FROM t1),
    i1 AS (SELECT *, floor(x) + (row_number() OVER (ORDER BY x - floor(x) DESC, s) <= {n_init} - (SELECT sum(floor(x)) FROM i0))::INT AS init FROM i0)
    SELECT s AS {stratum}, test::BIGINT AS n_test, init::BIGINT AS n_init, (n - test - init)::BIGINT AS n_pool, n::BIGINT AS n_ids FROM i1"""


def _sizes(split, stratum):
    return split.groupBy(stratum).agg(
        F.count_if(F.col("split") == "test").alias("n_test"), F.count_if(F.col("split") == "init").alias("n_init"),
        F.count_if(F.col("split") == "pool").alias("n_pool"), F.count_distinct("doc_id").alias("n_ids"),
    )


def _split(spark, folder):
    return al.stratified_split(labeled(spark, folder), "doc_id", "quality")


@query("stratified_split", "WITH " + _quota_sql("labels", "quality", 0.2, 50))
def stratified_split(spark, folder):
    return _sizes(_split(spark, folder), "quality")


@query("stratified_split_by_source", "WITH " + _quota_sql("documents", "source", 0.2, 50))
def stratified_split_by_source(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return _sizes(al.stratified_split(docs, "doc_id", "source"), "source")


@query("stratified_split_by_customer", "WITH " + _quota_sql("orders", "o_custkey", 0.2, 500))
def stratified_split_by_customer(spark, folder):
    """As many strata as there are customers."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_custkey")
    return _sizes(al.stratified_split(orders, "doc_id", "o_custkey", n_init=500), "o_custkey")


TERMS_SQL = """tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS t FROM documents),
 terms AS (SELECT doc_id, unnest(t) AS term FROM tok
   UNION ALL SELECT doc_id, t[i] || ' ' || t[i + 1] FROM (SELECT doc_id, t, unnest(range(1, len(t))) AS i FROM tok)),
 stats AS (SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM terms GROUP BY term),
 vocab AS (SELECT term, tf, df, ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) + 1.0 AS idf
   FROM stats ORDER BY tf DESC, term LIMIT 5000)"""


@query("term_statistics", f"WITH {TERMS_SQL} SELECT tf, df, count(*) AS n_terms FROM stats GROUP BY tf, df")
def term_statistics(spark, folder):
    stats = al.term_statistics(table(spark, folder, "documents"), "text")
    return stats.groupBy("tf", "df").agg(F.count(F.lit(1)).alias("n_terms"))


@query("vocabulary", f"WITH {TERMS_SQL} SELECT term, tf, df, round(idf, 6) AS idf FROM vocab")
def vocabulary(spark, folder):
    return al.vocabulary(table(spark, folder, "documents"), "text").withColumn("idf", near("idf"))


@query(
    "tfidf_vectors",
    f"""WITH {TERMS_SQL}, w AS (SELECT doc_id, term, (1.0 + ln(count(*))) * any_value(idf) AS w FROM terms JOIN vocab USING (term) GROUP BY doc_id, term)
    SELECT d.doc_id, coalesce(count(w), 0) AS n_terms, round(coalesce(max(w) / sqrt(sum(w * w)), 0), 5) AS top_weight,
    round(coalesce(sum(w) / sqrt(sum(w * w)), 0), 5) AS total_weight FROM documents d LEFT JOIN w ON d.doc_id = w.doc_id GROUP BY d.doc_id""",
)
def tfidf_vectors(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = al.TextFeatures.fit(docs, "text").transform(docs)
    values = F.col("features.values")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "doc_id", F.size(values).cast("bigint").alias("n_terms"),
        near(F.coalesce(F.array_max(values), F.lit(0.0)), 5).alias("top_weight"), near(total, 5).alias("total_weight"),
    )


def _pool(spark, folder):
    """Documents with class probabilities derived from their length."""
    p = F.col("confidence")
    return scored_documents(spark, folder).select("doc_id", F.array(p, F.lit(1.0) - p).alias("probabilities"))


POOL_SQL = "WITH p AS (SELECT doc_id, ((n_chars % 1000) / 1000.0)::DOUBLE AS p FROM documents)"


@query(
    "query_entropy",
    POOL_SQL + """ SELECT doc_id FROM p ORDER BY round(CASE WHEN p IN (0, 1) THEN 0 ELSE -p * ln(p) - (1 - p) * ln(1 - p) END, 9) DESC, doc_id LIMIT 10""",
)
def query_entropy(spark, folder):
    ranked = al.informativeness(_pool(spark, folder), "entropy", "doc_id")
    rounded = ranked.withColumn("score", F.round("score", 9))
    return rounded.orderBy(F.desc("score"), "doc_id").limit(10).select("doc_id")


@query("query_margin", POOL_SQL + " SELECT doc_id FROM p ORDER BY round(abs(2 * p - 1), 9), doc_id LIMIT 10")
def query_margin(spark, folder):
    ranked = al.informativeness(_pool(spark, folder), "margin", "doc_id")
    return ranked.orderBy(F.desc(F.round("score", 9)), "doc_id").limit(10).select("doc_id")


@query(
    "query_random",
    "SELECT least(10, count(*)) AS n, least(10, count(DISTINCT doc_id)) AS n_ids, least(10, count(doc_id)) AS n_known, true AS repeatable FROM documents",
)
def query_random(spark, folder):
    """Different rows of the pool, the same on each run."""
    pool = _pool(spark, folder)
    picked = al.query(pool, "random", 10, "doc_id").select("doc_id")
    again = al.query(pool.orderBy(F.desc("doc_id")), "random", 10, "doc_id").select(F.col("doc_id").alias("again"))
    known = picked.join(pool.select("doc_id", F.lit(True).alias("_in")), "doc_id", "left")
    both = known.join(again, F.col("doc_id") == F.col("again"), "left")
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_ids"), F.count("_in").alias("n_known"),
        (F.count("again") == F.count(F.lit(1))).alias("repeatable"),
    )


@query(
    "query_diagnostics",
    POOL_SQL + """, h AS (SELECT doc_id, CASE WHEN p IN (0, 1) THEN 0 ELSE -p * ln(p) - (1 - p) * ln(1 - p) END AS h FROM p),
    t AS (SELECT h FROM h ORDER BY h DESC LIMIT 10)
    SELECT (SELECT count(*) FROM h) AS pool_size, 10::BIGINT AS selected, round((SELECT min(h) FROM t), 6) AS selected_min,
    round((SELECT max(h) FROM t), 6) AS selected_max, round((SELECT min(h) FROM h), 6) AS pool_min, round((SELECT max(h) FROM h), 6) AS pool_max,
    round((SELECT avg(h) FROM t), 6) AS selected_mean, round((SELECT avg(h) FROM h), 6) AS pool_mean,
    round((SELECT (sum(h) - (SELECT sum(h) FROM t)) / (count(*) - 10) FROM h), 6) AS rest_mean, round((SELECT min(h) FROM h), 6) AS rest_min,
    round((SELECT h FROM h ORDER BY h DESC LIMIT 1 OFFSET 10), 6) AS rest_max""",
)
def query_diagnostics(spark, folder):
    pool = _pool(spark, folder)
    ranked = al.informativeness(pool, "entropy", "doc_id")
    rows = al.query_diagnostics(ranked, al.query(pool, "entropy", 10, "doc_id"), "doc_id")
    return rows.withColumns({c: near(c) for c in rows.columns if c not in ("pool_size", "selected")})


@query(
    "top_queried",
    POOL_SQL + """, h AS (SELECT doc_id, p, round(abs(2 * p - 1), 9) AS m FROM p ORDER BY m, doc_id LIMIT 5)
    SELECT doc_id, -m AS score, CASE WHEN p >= 1 - p THEN 'yes' ELSE 'no' END AS predicted, round(p, 6) AS p_yes, round(1 - p, 6) AS p_no FROM h""",
)
def top_queried(spark, folder):
    ranked = al.informativeness(_pool(spark, folder), "margin", "doc_id").withColumn("score", F.round("score", 9))
    top = al.top_queried(ranked, "doc_id", ["yes", "no"], 5)
    return top.select(
        "doc_id", "score", "predicted", near(F.col("by_class")["yes"]).alias("p_yes"), near(F.col("by_class")["no"]).alias("p_no")
    )


@query(
    "score_histogram",
    POOL_SQL + """, s AS (SELECT -abs(2 * p - 1) AS s FROM p), e AS (SELECT min(s) AS lo, (max(s) - min(s)) / 8.0 AS w FROM s)
    SELECT g.bin::INT AS bin, (SELECT count(*) FROM s WHERE least(floor((s - lo) / w), 7) = g.bin) AS n FROM e, range(8) g(bin)""",
)
def score_histogram(spark, folder):
    ranked = al.informativeness(_pool(spark, folder), "margin", "doc_id")
    return al.score_histogram(ranked, 8).select("bin", "n")


@query(
    "probability_histogram",
    """WITH p AS (SELECT quality, ((n_chars % 1000) / 1000.0)::DOUBLE AS p FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL)
    SELECT c.quality, g.bin::INT AS bin, (SELECT count(*) FROM p WHERE p.quality = c.quality AND least(floor(p / (1.0 / 20.0)), 19) = g.bin) AS n
    FROM (SELECT DISTINCT quality FROM p) c, range(20) g(bin)""",
)
def probability_histogram(spark, folder):
    p = ((F.col("n_chars") % 1000) / 1000.0)
    rows = labeled(spark, folder).where("quality IS NOT NULL").select("quality", F.array(p).alias("probabilities"))
    return al.probability_histogram(rows, "quality", 0, 20).select("quality", "bin", "n")


@query(
    "fit_checks",
    """WITH p AS (SELECT ((n_chars % 1000) / 1000.0)::DOUBLE AS m FROM documents)
    SELECT count(*) AS n, round(stddev_pop(m), 6) AS spread, false AS degenerate,
    (SELECT min(c) FROM (SELECT count(*) AS c FROM documents GROUP BY lang)) AS smallest_class, false AS unstable FROM p""",
)
def fit_checks(spark, folder):
    p = (F.col("n_chars") % 1000) / 1000.0
    rows = table(spark, folder, "documents").select("lang", F.array(p, F.lit(1.0) - p).alias("probabilities"))
    return al.fit_checks(rows, "lang").withColumn("spread", near("spread"))


def _history(spark, folder, rounds=2):
    experiment = al.Experiment.prepare(_split(spark, folder), "doc_id", "text", "quality", max_iter=100)
    return experiment.run("entropy", rounds).unionByName(experiment.run("random", rounds))


@query("al_cycle")
def al_cycle(spark, folder):
    return _history(spark, folder).drop("evaluated_at", "fit_seconds", "eval_seconds", "f1_per_class", "asked")


@query(
    "al_split_counts",
    """WITH n AS (SELECT count(*) AS n FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL),
    s AS (SELECT unnest(['entropy', 'margin', 'random']) AS strategy)
    SELECT strategy, i::INT AS iteration, (50 + 10 * i)::BIGINT AS n_labeled, (SELECT n - ceil(0.2 * n) - 50 FROM n)::BIGINT AS n_pool FROM s, range(3) r(i)""",
)
def al_split_counts(spark, folder):
    """Labeled rows per round: the initial ones and one batch more each time, never the same row twice."""
    split = _split(spark, folder)
    experiment = al.Experiment.prepare(split, "doc_id", "text", "quality", max_iter=5)
    n_pool = experiment.rows.agg(F.count_if(F.col("split") == "pool")).scalar()
    runs = [experiment.run(s, 2) for s in ("entropy", "margin", "random")]
    return runs[0].unionByName(runs[1]).unionByName(runs[2]).select(
        "strategy", "iteration", "n_labeled", n_pool.alias("n_pool")
    )


@query(
    "al_asked",
    """WITH n AS (SELECT count(*) - ceil(0.2 * count(*)) - 50 AS pool FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL),
    r AS (SELECT i, least(10, greatest(0, pool - 10 * i))::BIGINT AS n FROM n, range(2) r(i))
    SELECT s.strategy, i::INT AS iteration, r.n AS n_asked, r.n AS n_new, r.n AS n_from_pool, r.n AS n_ordered
    FROM (VALUES ('entropy'), ('margin'), ('random')) s(strategy), r""",
)
def al_asked(spark, folder):
    """The rows that each round asks for: from the pool, never asked before, the most informative first."""
    split = _split(spark, folder)
    experiment = al.Experiment.prepare(split, "doc_id", "text", "quality", max_iter=5)
    runs = [experiment.run(s, 2) for s in ("entropy", "margin", "random")]
    asked = runs[0].unionByName(runs[1]).unionByName(runs[2]).where("iteration < 2").select(
        "strategy", "iteration", F.posexplode("asked").alias("place", "doc_id")
    ).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    pool = experiment.rows.where("split = 'pool'").select("doc_id", F.lit(True).alias("in_pool"))
    earlier = Window.partitionBy("strategy", "doc_id").orderBy("iteration", "place")
    marked = asked.join(pool, "doc_id", "left").withColumn("time", F.row_number().over(earlier))
    return marked.groupBy("strategy", "iteration").agg(
        F.count(F.lit(1)).alias("n_asked"), F.count_if(F.col("time") == 1).alias("n_new"), F.count("in_pool").alias("n_from_pool"),
        F.count_distinct("place").alias("n_ordered"),
    )


# history figures derived from the orders: one run per status, one round per year
HISTORY_SQL = """hist AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'entropy' ELSE 'random' END AS strategy, (year(o_orderdate) - 1992)::INT AS iteration,
  (50 + 10 * (year(o_orderdate) - 1992))::BIGINT AS n_labeled, round(avg((o_totalprice > 250000)::INT), 4) AS f1,
  round(avg((o_totalprice > 200000)::INT), 4) AS accuracy FROM orders GROUP BY 1, 2, 3)"""


def _order_history(spark, folder):
    year = F.year("o_orderdate") - 1992
    return table(spark, folder, "orders").groupBy(
        F.when(F.col("o_orderstatus") == "F", "entropy").otherwise("random").alias("strategy"),
        year.alias("iteration"), (year * 10 + 50).cast("bigint").alias("n_labeled"),
    ).agg(
        near(F.avg((F.col("o_totalprice") > 250000).cast("int")), 4).alias("f1"),
        near(F.avg((F.col("o_totalprice") > 200000).cast("int")), 4).alias("accuracy"),
    )


@query(
    "compare_strategies",
    f"""WITH {HISTORY_SQL} SELECT iteration, n_labeled, max(accuracy) FILTER (WHERE strategy = 'entropy') AS entropy_accuracy,
    max(f1) FILTER (WHERE strategy = 'entropy') AS entropy_f1, max(accuracy) FILTER (WHERE strategy = 'random') AS random_accuracy,
    max(f1) FILTER (WHERE strategy = 'random') AS random_f1,
    round(max(f1) FILTER (WHERE strategy = 'entropy') - max(f1) FILTER (WHERE strategy = 'random'), 6) AS f1_delta FROM hist GROUP BY 1, 2""",
)
def compare_strategies(spark, folder):
    return al.compare_strategies(_order_history(spark, folder)).withColumn("f1_delta", near("f1_delta"))


@query(
    "round_deltas",
    f"""WITH {HISTORY_SQL} SELECT strategy, iteration, round(accuracy - lag(accuracy) OVER w, 6) AS accuracy_delta, round(f1 - lag(f1) OVER w, 6) AS f1_delta,
    coalesce(f1 < lag(f1) OVER w, false) AS degraded FROM hist WINDOW w AS (PARTITION BY strategy ORDER BY iteration)""",
)
def round_deltas(spark, folder):
    rows = al.round_deltas(_order_history(spark, folder))
    return rows.select("strategy", "iteration", near("accuracy_delta").alias("accuracy_delta"), near("f1_delta").alias("f1_delta"), "degraded")


@query(
    "savings",
    f"""WITH {HISTORY_SQL}, e AS (SELECT (SELECT arg_max(f1, iteration) FROM hist WHERE strategy = 'entropy') AS first_f1,
    (SELECT arg_max(f1, iteration) FROM hist WHERE strategy = 'random') AS second_f1, (SELECT max(n_labeled) FROM hist WHERE strategy = 'random') AS budget),
    n AS (SELECT e.*, (SELECT min(n_labeled) FROM hist WHERE strategy = 'entropy' AND f1 >= e.second_f1) AS n_needed FROM e)
    SELECT *, round((1.0 - n_needed::DOUBLE / budget) * 100.0, 1) AS saved_pct, round(first_f1 - second_f1, 4) AS f1_gain,
    round((first_f1 - second_f1) / second_f1 * 100.0, 1) AS f1_gain_pct FROM n""",
)
def savings(spark, folder):
    return al.savings(_order_history(spark, folder))


@query(
    "confidence_band",
    f"""WITH {HISTORY_SQL} SELECT strategy, n_labeled, round(avg(f1), 6) AS mean, stddev_samp(f1) AS std, count(*) AS runs FROM hist GROUP BY 1, 2""",
)
def confidence_band(spark, folder):
    return al.confidence_band(_order_history(spark, folder)).withColumn("mean", near("mean"))


@query(
    "mixed_features",
    """WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd FROM orders)
    SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS hot, 1.0::DOUBLE AS hot_sum, round((o_totalprice - m) / sd, 6) AS scaled FROM orders, s""",
)
def mixed_features(spark, folder):
    """One-hot place of the category and the standardised number of every order."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    prepared = al.mixed_features(["o_orderpriority"], ["o_totalprice"]).fit(orders).transform(orders)
    values = vector_to_array("features")
    width = F.size(values)
    hot = F.slice(values, 1, width - 1)
    return prepared.select(
        "o_orderkey", (F.array_position(hot, 1.0) - 1).alias("hot"),
        F.aggregate(hot, F.lit(0.0), lambda a, x: a + x).alias("hot_sum"), near(F.element_at(values, -1)).alias("scaled"),
    )


@query("mixed_feature_model")
def mixed_feature_model(spark, folder):
    """A forest on categories and numbers of the orders, summarised by predicted class."""
    orders = table(spark, folder, "orders").select(
        "o_orderpriority", "o_totalprice", (F.col("o_orderstatus") == "F").cast("double").alias("label")
    )
    pipeline = al.mixed_features(["o_orderpriority"], ["o_totalprice"])
    prepared = pipeline.fit(orders).transform(orders)
    model = al.classifier("random_forest").fit(prepared)
    scored = al.with_probabilities(model.transform(prepared))
    return scored.groupBy("label", "prediction").agg(
        F.count(F.lit(1)).alias("n"), near(F.avg(F.get("probabilities", 1)), 4).alias("mean_probability")
    )
