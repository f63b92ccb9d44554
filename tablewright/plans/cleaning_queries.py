"""Filling, clipping, removing, resampling and generic strategies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import text as tx
from tablewright.operators import cleaning, neighbors
from tablewright.plans.registry import REVIEWS_SQL, near, query, reviews, table
from tablewright.session import cut_lineage

WITH_REVIEWS = f"WITH {REVIEWS_SQL} "


@query(
    "fill_mean",
    WITH_REVIEWS + """SELECT doc_id, round(coalesce(quality::DOUBLE, (SELECT avg(quality) FROM rev)), 6) AS quality,
    round(coalesce(toxic::DOUBLE, (SELECT avg(toxic) FROM rev)), 6) AS toxic FROM rev""",
)
def fill_mean(spark, folder):
    rows = cleaning.fill_mean(reviews(spark, folder), ["quality", "toxic"])
    return rows.select("doc_id", near("quality").alias("quality"), near("toxic").alias("toxic"))


@query(
    "fill_median",
    WITH_REVIEWS + """SELECT doc_id, coalesce(quality::DOUBLE, (SELECT quantile_cont(quality::DOUBLE, 0.5) FROM rev)) AS quality,
    coalesce(toxic::DOUBLE, (SELECT quantile_cont(toxic::DOUBLE, 0.5) FROM rev)) AS toxic FROM rev""",
)
def fill_median(spark, folder):
    return cleaning.fill_median(reviews(spark, folder), ["quality", "toxic"]).select("doc_id", "quality", "toxic")


_KNOWN_SQL = """known AS (SELECT o_orderkey,
  CASE WHEN o_totalprice > 100000 THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN o_totalprice > 100000 THEN o_orderstatus END AS o_orderstatus FROM orders)"""


def _known(spark, folder):
    """Orders whose cheap rows lost their categories."""
    seen = F.col("o_totalprice") > 100000
    return table(spark, folder, "orders").select(
        "o_orderkey", F.when(seen, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(seen, F.col("o_orderstatus")).alias("o_orderstatus"),
    )


@query(
    "fill_mode",
    f"""WITH {_KNOWN_SQL}, filled AS (SELECT
    coalesce(o_orderpriority, (SELECT o_orderpriority FROM known WHERE o_orderpriority IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS o_orderpriority,
    coalesce(o_orderstatus, (SELECT o_orderstatus FROM known WHERE o_orderstatus IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS o_orderstatus FROM known)
    SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM filled GROUP BY 1, 2""",
)
def fill_mode(spark, folder):
    rows = cleaning.fill_mode(_known(spark, folder), ["o_orderpriority", "o_orderstatus"])
    return rows.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fill_interpolate",
    """WITH s AS (SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events),
    e AS (SELECT event_id, user_id, v,
      last_value(CASE WHEN v IS NOT NULL THEN event_id END IGNORE NULLS) OVER p AS t0,
      last_value(v IGNORE NULLS) OVER p AS v0,
      first_value(CASE WHEN v IS NOT NULL THEN event_id END IGNORE NULLS) OVER n AS t1,
      first_value(v IGNORE NULLS) OVER n AS v1 FROM s
      WINDOW p AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             n AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT event_id, user_id, CASE WHEN v IS NOT NULL THEN v WHEN t1 IS NULL THEN v0
      WHEN t0 IS NOT NULL THEN v0 + (v1 - v0) / (t1 - t0) * (event_id - t0) END AS value FROM e""",
)
def fill_interpolate(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    return cleaning.fill_interpolate(events, "event_id", "value", ["user_id"])


_CLIP_SQL = """SELECT l_returnflag, count(*) AS n, min(v) AS lo, max(v) AS hi,
  sum(v::DECIMAL(18, 4))::DOUBLE AS total FROM clipped GROUP BY l_returnflag"""


def _clip_summary(rows):
    v = F.col("l_extendedprice")
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        F.sum(v.cast("decimal(18,4)")).cast("double").alias("total"),
    )


@query(
    "clip_iqr",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
    clipped AS (SELECT l_returnflag, greatest(least(l_extendedprice, q3 + (q3 - q1) * 0.3), q1 - (q3 - q1) * 0.3) AS v
    FROM lineitem, q) """ + _CLIP_SQL,
)
def clip_iqr(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    return _clip_summary(cleaning.clip_outliers(rows, ["l_extendedprice"], "iqr", 0.3))


@query(
    "clip_zscore",
    """WITH q AS (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS s FROM documents)
    SELECT doc_id, round(greatest(least(n_chars::DOUBLE, m + s * 1.0), m - s * 1.0), 4) AS n_chars FROM documents, q""",
)
def clip_zscore(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "n_chars")
    clipped = cleaning.clip_outliers(rows, ["n_chars"], "zscore", 1.0)
    return clipped.select("doc_id", near("n_chars", 4).alias("n_chars"))


@query(
    "remove_iqr",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
    SELECT l_returnflag, count(*) AS n FROM lineitem, q
    WHERE l_extendedprice BETWEEN q1 - (q3 - q1) * 0.3 AND q3 + (q3 - q1) * 0.3 GROUP BY 1""",
)
def remove_iqr(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    kept = cleaning.remove_outliers(rows, ["l_extendedprice"], "iqr", 0.3)
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "remove_zscore",
    """WITH q AS (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS s FROM documents)
    SELECT doc_id, n_chars FROM documents, q WHERE n_chars BETWEEN m - s * 3.0 AND m + s * 3.0""",
)
def remove_zscore(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "n_chars")
    return cleaning.remove_outliers(rows, ["n_chars"], "zscore", 3.0)


@query(
    "log_transform",
    """SELECT c_custkey, round(CASE WHEN c_acctbal >= 0 THEN ln(1 + c_acctbal) END, 6) AS c_acctbal FROM customer""",
)
def log_transform(spark, folder):
    rows = cleaning.log_transform(table(spark, folder, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
    return rows.select("c_custkey", near("c_acctbal").alias("c_acctbal"))


@query("drop_rows", WITH_REVIEWS + "SELECT doc_id, quality, toxic FROM rev WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def drop_rows(spark, folder):
    return cleaning.drop_rows(reviews(spark, folder)).select("doc_id", "quality", "toxic")


@query("drop_columns", "SELECT doc_id, lang, source, n_chars FROM documents")
def drop_columns(spark, folder):
    return cleaning.drop_columns(reviews(spark, folder), 40.0).drop("text")


@query("drop_exact", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def drop_exact(spark, folder):
    return cleaning.drop_exact(table(spark, folder, "documents").drop("doc_id"))


@query("drop_subset", "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def drop_subset(spark, folder):
    return cleaning.drop_subset(table(spark, folder, "documents").select("doc_id", "text"), ["text"], "doc_id")


@query(
    "oversample",
    """WITH c AS (SELECT quality, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY quality), m AS (SELECT max(n) AS t FROM c)
    SELECT quality, m.t AS n, c.n AS originals, (m.t // c.n) + CASE WHEN m.t % c.n > 0 THEN 1 ELSE 0 END AS most_copies,
    m.t // c.n AS fewest_copies FROM c, m""",
)
def oversample(spark, folder):
    rows = cleaning.oversample(table(spark, folder, "labels"), ["doc_id"], "quality")
    per_row = rows.groupBy("quality", "doc_id").agg(F.count_distinct("copy").alias("c"))
    return per_row.groupBy("quality").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("originals"),
        F.max("c").alias("most_copies"), F.min("c").alias("fewest_copies"),
    )


@query(
    "undersample",
    """WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
    SELECT lang, (SELECT min(n) FROM c) AS n, (SELECT min(n) FROM c) AS distinct_rows FROM c""",
)
def undersample(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return cleaning.undersample(docs, ["doc_id"], "lang").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("distinct_rows")
    )


@query(
    "class_weights",
    """WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
    SELECT d.doc_id, d.lang, (SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * c.n)::DOUBLE AS weight
    FROM documents d JOIN c ON d.lang = c.lang""",
)
def class_weights(spark, folder):
    return cleaning.class_weights(table(spark, folder, "documents").select("doc_id", "lang"), ["doc_id"], "lang")


GENTLE = {
    "duplicates": "drop_exact",
    "missing": {"numeric": "fill_median", "categorical": "fill_mode"},
    "outliers": {"method": "clip_iqr", "factor": 1.5},
}
HARSH = {
    "duplicates": ["text"],
    "missing": {"drop_cols": 80.0, "drop_rows": 0},
    "outliers": {"method": "remove_zscore", "factor": 3.0},
}


@query(
    "apply_strategy_gentle",
    WITH_REVIEWS + """, d AS (SELECT min(doc_id) AS doc_id, lang, source, n_chars, quality, toxic FROM rev
      GROUP BY text, lang, source, n_chars, quality, toxic),
    m AS (SELECT quantile_cont(quality::DOUBLE, 0.5) AS mq, quantile_cont(toxic::DOUBLE, 0.5) AS mt FROM d),
    f AS (SELECT doc_id, lang, n_chars::DOUBLE AS n_chars, coalesce(quality::DOUBLE, mq) AS quality,
      coalesce(toxic::DOUBLE, mt) AS toxic FROM d, m),
    q AS (SELECT quantile_cont(n_chars, 0.25) AS a1, quantile_cont(n_chars, 0.75) AS a3,
      quantile_cont(quality, 0.25) AS b1, quantile_cont(quality, 0.75) AS b3,
      quantile_cont(toxic, 0.25) AS c1, quantile_cont(toxic, 0.75) AS c3 FROM f)
    SELECT doc_id, lang, greatest(least(n_chars, a3 + (a3 - a1) * 1.5), a1 - (a3 - a1) * 1.5) AS n_chars,
      greatest(least(quality, b3 + (b3 - b1) * 1.5), b1 - (b3 - b1) * 1.5) AS quality,
      greatest(least(toxic, c3 + (c3 - c1) * 1.5), c1 - (c3 - c1) * 1.5) AS toxic FROM f, q""".replace(" , d AS", ", d AS"),
)
def apply_strategy_gentle(spark, folder):
    rows, _ = cleaning.apply_strategy(reviews(spark, folder), GENTLE, "doc_id")
    return rows.select("doc_id", "lang", "n_chars", "quality", "toxic")


@query(
    "apply_strategy_harsh_log",
    WITH_REVIEWS + """, o AS (SELECT count(*) AS rows, sum((quality IS NULL)::INT + (toxic IS NULL)::INT)::BIGINT AS missing FROM rev),
    d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM rev) WHERE rn = 1),
    t AS (SELECT * FROM d WHERE quality IS NOT NULL),
    z AS (SELECT * FROM t, (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS s, avg(toxic) AS tm, stddev_pop(toxic) AS ts FROM t)
      WHERE n_chars BETWEEN m - s * 3.0 AND m + s * 3.0 AND toxic BETWEEN tm - ts * 3.0 AND tm + ts * 3.0)
    SELECT 0 AS place, 'original' AS step, rows, missing, 7 AS cols FROM o
    UNION ALL SELECT 1, 'drop_subset', count(*), sum((quality IS NULL)::INT + (toxic IS NULL)::INT), 7 FROM d
    UNION ALL SELECT 2, 'drop_missing_target', count(*), 0, 7 FROM t
    UNION ALL SELECT 3, 'drop_cols', count(*), 0, 7 FROM t
    UNION ALL SELECT 4, 'drop_rows', count(*), 0, 7 FROM t
    UNION ALL SELECT 5, 'remove_zscore', count(*), 0, 7 FROM z""",
)
def apply_strategy_harsh_log(spark, folder):
    _, log = cleaning.apply_strategy(reviews(spark, folder), HARSH, "doc_id", "quality")
    return log


@query(
    "fill_knn",
    """WITH r AS (SELECT p_partkey, p_retailprice AS a, length(p_name)::DOUBLE AS b, CASE WHEN p_partkey % 10 <> 0 THEN p_size::DOUBLE END AS v FROM part),
    s AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM r),
    z AS (SELECT p_partkey, v, a, b, CASE WHEN sa > 0 THEN (a - ma) / sa ELSE 0 END AS x, CASE WHEN sb > 0 THEN (b - mb) / sb ELSE 0 END AS y FROM r, s),
    p AS (SELECT a, b, any_value(x) AS x, any_value(y) AS y, count(*) AS w, avg(v) AS m FROM z WHERE v IS NOT NULL GROUP BY a, b),
    q AS (SELECT DISTINCT a, b, x, y FROM z WHERE v IS NULL),
    d AS (SELECT q.a, q.b, p.w, p.m, coalesce(sum(p.w) OVER (PARTITION BY q.a, q.b
        ORDER BY sqrt((q.x - p.x) ** 2 + (q.y - p.y) ** 2), p.x, p.y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q, p),
    f AS (SELECT a, b, sum(m * least(w, 5 - before)) / sum(least(w, 5 - before)) AS fill FROM d WHERE before < 5 GROUP BY a, b)
    SELECT z.p_partkey, round(coalesce(z.v, f.fill), 4) AS p_size FROM z LEFT JOIN f ON z.a = f.a AND z.b = f.b""",
)
def fill_knn(spark, folder):
    """Sizes of every tenth part filled from the parts nearest in price and length of name."""
    parts = table(spark, folder, "part").select(
        "p_partkey", "p_retailprice", F.length("p_name").cast("double").alias("name_length"),
        F.when(F.col("p_partkey") % 10 != 0, F.col("p_size").cast("double")).alias("p_size"),
    )
    filled = neighbors.fill_knn(parts, "p_partkey", "p_size", ["p_retailprice", "name_length"], 5)
    return filled.select("p_partkey", near("p_size", 4).alias("p_size"))


_KNN = ["a", "b", "c", "d"]


@query(
    "fill_knn_wide",
    f"""WITH r AS (SELECT o_orderkey, o_custkey::DOUBLE AS a, date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::DOUBLE AS b, (o_orderkey % 997)::DOUBLE AS c,
      length(o_orderpriority)::DOUBLE AS d, CASE WHEN o_orderkey % 100 <> 0 THEN o_totalprice END AS v FROM orders),
    s AS (SELECT {", ".join(f"avg({c}) AS m{c}, stddev_pop({c}) AS s{c}" for c in _KNN)} FROM r),
    z AS (SELECT o_orderkey, v, {", ".join(f"({c} - m{c}) / s{c} AS {c}" for c in _KNN)} FROM r, s),
    p AS (SELECT {", ".join(_KNN)}, count(*) AS w, avg(v) AS m FROM z WHERE v IS NOT NULL GROUP BY ALL),
    d AS (SELECT q.o_orderkey, p.w, p.m, coalesce(sum(p.w) OVER (PARTITION BY q.o_orderkey
        ORDER BY sqrt({" + ".join(f"(q.{c} - p.{c}) ** 2" for c in _KNN)}), {", ".join(f"p.{c}" for c in _KNN)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT * FROM z WHERE v IS NULL) q, p),
    f AS (SELECT o_orderkey, sum(m * least(w, 5 - before)) / sum(least(w, 5 - before)) AS fill FROM d WHERE before < 5 GROUP BY 1)
    SELECT z.o_orderkey, round(coalesce(z.v, f.fill), 3) AS o_totalprice FROM z LEFT JOIN f ON z.o_orderkey = f.o_orderkey""",
)
def fill_knn_wide(spark, folder):
    """Prices of every hundredth order filled from the orders nearest in four figures."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("double").alias("a"), F.datediff("o_orderdate", F.lit("1970-01-01")).cast("double").alias("b"),
        (F.col("o_orderkey") % 997).cast("double").alias("c"), F.length("o_orderpriority").cast("double").alias("d"),
        F.when(F.col("o_orderkey") % 100 != 0, F.col("o_totalprice")).alias("o_totalprice"),
    )
    filled = neighbors.fill_knn(orders, "o_orderkey", "o_totalprice", _KNN, 5)
    return filled.select("o_orderkey", near("o_totalprice", 3).alias("o_totalprice"))


@query(
    "smote_wide",
    """WITH j AS (SELECT quality, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY quality)
    SELECT quality, (SELECT max(n) FROM j) AS n, (SELECT max(n) FROM j) - n AS n_made, (SELECT max(n) FROM j) - n AS n_between FROM j""",
)
def smote_wide(spark, folder):
    """Four figures of a text; every made row lies on the line from its base row to a given row of its class."""
    features = ["n_chars", "n_words", "n_lines", "n_kinds"]
    # texts are read once, by all tasks however few row groups they come in; their figures are read several times
    texts = reviews(spark, folder).where("quality IS NOT NULL").select("doc_id", "quality", "n_chars", "text")
    rows = cut_lineage(texts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id").select(
        "doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"), tx.word_count("text").cast("double").alias("n_words"),
        F.regexp_count("text", F.lit("\n")).cast("double").alias("n_lines"),
        F.size(F.array_distinct(F.split("text", ""))).cast("double").alias("n_kinds"),
    ))
    balanced = cut_lineage(neighbors.smote(rows, "doc_id", "quality", features, 5))
    # the base row and its neighbours, found again, and how far along each line a made row would lie
    point = F.array(*features)
    distinct = rows.groupBy(F.col("quality").alias("g"), point.alias("p")).agg(F.lit(1).cast("bigint").alias("w"))
    made = balanced.where("copy > 0").select(F.col("quality").alias("g"), "doc_id", "copy", point.alias("made"))
    based = made.join(rows.select("doc_id", point.alias("q")), "doc_id")
    lines = neighbors.nearest(based.select("g", "q").distinct(), distinct, 5, len(features), exclude_self=True)
    held = based.join(lines, ["g", "q"], "left")
    step = F.aggregate(
        F.zip_with(F.zip_with("p", "q", lambda a, b: a - b), F.zip_with("made", "q", lambda a, b: a - b),
                   lambda along, moved: F.when(along != 0, moved / along)),
        F.struct(F.lit(1.0).alias("lo"), F.lit(0.0).alias("hi")),
        lambda s, x: F.struct(F.least(s["lo"], x).alias("lo"), F.greatest(s["hi"], x).alias("hi")),
    )
    flat = F.forall(F.arrays_zip(F.col("p").alias("p"), F.col("q").alias("q"), F.col("made").alias("m")), lambda s: (s["p"] != s["q"]) | (s["m"] == s["q"]))
    between = F.coalesce(flat & (step["hi"] - step["lo"] <= 1e-6) & (step["lo"] >= 0) & (step["hi"] <= 1), F.col("p").isNull())
    checked = held.groupBy("g", "doc_id", "copy").agg(F.max(between).alias("ok")).groupBy(F.col("g").alias("quality")).agg(
        F.count_if("ok").alias("n_between")
    )
    counts = balanced.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("copy") > 0).alias("n_made"))
    return counts.join(checked, "quality", "left").select("quality", "n", "n_made", F.coalesce("n_between", F.lit(0)).alias("n_between"))


@query(
    "smote",
    """WITH j AS (SELECT quality, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY quality)
    SELECT quality, (SELECT max(n) FROM j) AS n, (SELECT max(n) FROM j) - n AS n_made FROM j""",
)
def smote(spark, folder):
    rows = reviews(spark, folder).where("quality IS NOT NULL").select(
        "doc_id", "quality", "n_chars", F.length("source").alias("source_length")
    )
    balanced = neighbors.smote(rows, "doc_id", "quality", ["n_chars", "source_length"], 5)
    return balanced.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("copy") > 0).alias("n_made")
    )
