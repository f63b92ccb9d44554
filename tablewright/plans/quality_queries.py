"""Masks, quality score, issue scan and cleaning decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import masks
from tablewright.operators import cleaning, profile, quality
from tablewright.plans.registry import REVIEWS_SQL, ROLES, near, query, reviews, table

_DAMAGED = "coalesce(regexp_matches(text, '[\\x{{FFFD}}?]{{{0},}}'), false)"
DAMAGED = _DAMAGED.format(3)
SHORT = "coalesce(length(text) < 50, false)"

FACTS_SQL = f"""
WITH {REVIEWS_SQL},
base AS (SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE {DAMAGED}) AS n_damaged,
  count(*) FILTER (WHERE {SHORT} AND NOT {DAMAGED}) AS n_short,
  sum((doc_id IS NULL)::INT + (text IS NULL)::INT + (lang IS NULL)::INT + (source IS NULL)::INT
    + (n_chars IS NULL)::INT + (quality IS NULL)::INT + (toxic IS NULL)::INT)::BIGINT AS n_missing
  FROM rev),
dup AS (SELECT coalesce(sum(c), 0)::BIGINT AS n_duplicate FROM
  (SELECT source, count(*) AS c FROM rev WHERE source IS NOT NULL GROUP BY source HAVING count(*) > 1)),
leak AS (SELECT count(*) AS n_groups, coalesce(bool_and(d = 1), true) AS is_constant FROM
  (SELECT lang, count(DISTINCT quality) AS d FROM rev WHERE lang IS NOT NULL GROUP BY lang)),
facts AS (SELECT base.*, dup.n_duplicate, leak.n_groups, leak.is_constant, 7 AS n_cols
  FROM base, dup, leak)
"""

ISSUES_SQL = FACTS_SQL + """,
issues AS (
SELECT 1 AS place, 'encoding_corruption' AS type, 'critical' AS severity, n_damaged AS count,
  n_damaged::DOUBLE / n_rows::DOUBLE * 100.0 AS pct,
  least(n_damaged::DOUBLE / n_rows::DOUBLE * 100.0 * 25.0, 30.0) AS penalty FROM facts WHERE n_damaged > 0
UNION ALL SELECT 2, 'short_review', 'medium', n_short, n_short::DOUBLE / n_rows::DOUBLE * 100.0,
  least(n_short::DOUBLE / n_rows::DOUBLE * 100.0 * 15.0, 15.0) FROM facts WHERE n_short > 0
UNION ALL SELECT 3, 'duplicate_reviewer', 'high', n_duplicate, n_duplicate::DOUBLE / n_rows::DOUBLE * 100.0,
  least(n_duplicate::DOUBLE / n_rows::DOUBLE * 100.0 * 10.0, 15.0) FROM facts WHERE n_duplicate > 0
UNION ALL SELECT 4, 'perfume_level_rating', 'high', n_groups, 100.0, 10.0 FROM facts WHERE is_constant
UNION ALL SELECT 5, 'missing_values', 'high', n_missing,
  n_missing::DOUBLE / (n_rows * n_cols)::DOUBLE * 100.0,
  least(n_missing::DOUBLE / (n_rows * n_cols)::DOUBLE * 100.0 * 20.0, 20.0) FROM facts WHERE n_missing > 0)
"""


@query("quality_issues", ISSUES_SQL + "SELECT place, type, severity, count, pct, penalty FROM issues")
def quality_issues(spark, folder):
    return quality.quality_issues(reviews(spark, folder), **ROLES).drop("description")


@query("quality_facts", FACTS_SQL + "SELECT * FROM facts")
def quality_facts(spark, folder):
    return quality.quality_facts(reviews(spark, folder), **ROLES)


@query(
    "quality_report",
    ISSUES_SQL + """SELECT greatest(0.0, round(100.0 - sum(penalty), 1))::DOUBLE AS quality_score,
    (SELECT n_rows FROM facts) AS n_rows, 7 AS n_cols, round(sum(penalty), 1)::DOUBLE AS total_penalty,
    count(*)::INT AS n_issues FROM issues""",
)
def quality_report(spark, folder):
    report = quality.quality_report(reviews(spark, folder), **ROLES)
    return report.withColumn("n_issues", F.size("issues")).drop("issues")


@query(
    "text_masks",
    f"""SELECT lang, count(*) FILTER (WHERE d) AS damaged, count(*) FILTER (WHERE s) AS short,
    count(*) FILTER (WHERE s AND NOT d) AS short_only, count(*) FILTER (WHERE s OR d) AS either,
    count(*) FILTER (WHERE s AND d) AS both_masks
    FROM (SELECT lang, {_DAMAGED.format(1)} AS d, coalesce(length(text) < 400, false) AS s FROM documents)
    GROUP BY lang""",
)
def text_masks(spark, folder):
    d, s = masks.damaged_text("text", 1), masks.short_text("text", 400)
    return table(spark, folder, "documents").groupBy("lang").agg(
        F.count_if(d).alias("damaged"), F.count_if(s).alias("short"),
        F.count_if(s & ~d).alias("short_only"), F.count_if(s | d).alias("either"),
        F.count_if(s & d).alias("both_masks"),
    )


CLEAN_SQL = f"{REVIEWS_SQL}, clean AS (SELECT * FROM rev WHERE NOT {DAMAGED} AND NOT {SHORT})"
A_SQL = CLEAN_SQL + """, a AS (SELECT * FROM (SELECT *, row_number() OVER
 (PARTITION BY source ORDER BY length(text) DESC NULLS LAST, doc_id) AS rn FROM clean) WHERE rn = 1)"""


@query("strategy_conservative", f"WITH {A_SQL} SELECT doc_id, lang, source, n_chars FROM a")
def strategy_conservative(spark, folder):
    rows = cleaning.strategy_conservative(reviews(spark, folder), "text", "source", "doc_id")
    return rows.select("doc_id", "lang", "source", "n_chars")


@query(
    "strategy_soft",
    f"WITH {REVIEWS_SQL} SELECT doc_id, lang, {SHORT} AS is_short_review FROM rev WHERE NOT {DAMAGED}",
)
def strategy_soft(spark, folder):
    return cleaning.strategy_soft(reviews(spark, folder), "text").select("doc_id", "lang", "is_short_review")


@query(
    "strategy_flag_duplicates",
    f"""WITH {CLEAN_SQL} SELECT doc_id, source,
    coalesce(count(source) OVER (PARTITION BY source) > 1, false) AS is_duplicate_reviewer FROM clean""",
)
def strategy_flag_duplicates(spark, folder):
    rows = cleaning.strategy_flag_duplicates(reviews(spark, folder), "text", "source", "doc_id")
    return rows.select("doc_id", "source", "is_duplicate_reviewer")


@query(
    "keep_longest_per_key",
    """SELECT doc_id, lang, source, n_chars FROM (SELECT *, row_number() OVER
    (PARTITION BY lang, source ORDER BY length(text) DESC NULLS LAST, doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def keep_longest_per_key(spark, folder):
    rows = cleaning.keep_longest(table(spark, folder, "documents"), ["lang", "source"], "text", "doc_id")
    return rows.select("doc_id", "lang", "source", "n_chars")


@query(
    "flag_duplicates",
    """SELECT is_duplicate, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM (SELECT o_orderkey,
    count(*) OVER (PARTITION BY o_custkey) > 1 AS is_duplicate FROM orders) GROUP BY is_duplicate""",
)
def flag_duplicates(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    flagged = profile.flag_duplicate_keys(orders, "o_custkey", ["o_orderkey"])
    return flagged.groupBy("is_duplicate").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "group_constant_target",
    """WITH x AS (SELECT l_partkey, p_retailprice, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT 'p_retailprice' AS target, count(*) AS n_groups, bool_and(d = 1) AS is_constant FROM
      (SELECT l_partkey, count(DISTINCT p_retailprice) AS d FROM x GROUP BY l_partkey)
    UNION ALL SELECT 'l_quantity', count(*), bool_and(d = 1) FROM
      (SELECT l_partkey, count(DISTINCT l_quantity) AS d FROM x GROUP BY l_partkey)""",
)
def group_constant_target(spark, folder):
    joined = table(spark, folder, "lineitem").select("l_partkey", "l_quantity").join(
        table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey"
    )
    parts = [
        profile.group_constant(joined, "l_partkey", t).select(F.lit(t).alias("target"), "n_groups", "is_constant")
        for t in ("p_retailprice", "l_quantity")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "strategy_metrics",
    f"""WITH {A_SQL}, o AS (SELECT count(*) AS n FROM rev), c AS (SELECT count(*) AS n FROM a),
    m AS (SELECT sum((quality IS NULL)::INT + (toxic IS NULL)::INT)::DOUBLE AS g FROM a),
    leak AS (SELECT bool_and(d = 1) AS k FROM (SELECT count(DISTINCT quality) AS d FROM a GROUP BY lang))
    SELECT o.n AS rows_before, c.n AS rows_after,
    round((1.0 - c.n::DOUBLE / o.n::DOUBLE) * 100.0, 2)::DOUBLE AS loss_pct,
    round(100.0 - CASE WHEN leak.k THEN 10.0 ELSE 0.0 END - least(m.g / (c.n * 7)::DOUBLE * 100.0 * 20.0, 20.0), 1)::DOUBLE
      AS quality_score FROM o, c, m, leak""",
)
def strategy_metrics(spark, folder):
    rows = reviews(spark, folder)
    clean = cleaning.strategy_conservative(rows, "text", "source", "doc_id")
    return quality.strategy_metrics(rows, clean, **ROLES).drop("issues_remaining")


@query(
    "data_loss",
    f"""WITH {CLEAN_SQL}, b AS (SELECT (SELECT count(*) FROM rev) AS rows_before, (SELECT count(*) FROM clean) AS rows_after)
    SELECT *, (1.0 - rows_after::DOUBLE / rows_before::DOUBLE) * 100.0 AS loss_pct,
    (1.0 - rows_after::DOUBLE / rows_before::DOUBLE) * 100.0 > 30.0 AS too_much FROM b""",
)
def data_loss(spark, folder):
    rows = reviews(spark, folder)
    return quality.data_loss(rows, cleaning.without_bad_text(rows, "text"))


@query(
    "decision_log",
    f"""SELECT 'encoding_corruption' AS issue, 'drop' AS action, count(*) FILTER (WHERE {DAMAGED}) AS rows FROM documents
    UNION ALL SELECT 'short_review', 'drop', count(*) FILTER (WHERE {SHORT} AND NOT {DAMAGED}) FROM documents
    UNION ALL SELECT 'encoding_and_short', 'overlap', count(*) FILTER (WHERE {SHORT} AND {DAMAGED}) FROM documents""",
)
def decision_log(spark, folder):
    return quality.decision_log(table(spark, folder, "documents"), "text")


SCAN_SQL = f"""
WITH {REVIEWS_SQL}, n AS (SELECT count(*)::DOUBLE AS n FROM rev),
gaps AS (SELECT u.name AS "column", u.value AS count, u.value::DOUBLE / n.n * 100.0 AS pct FROM
  (UNPIVOT (SELECT count(*) FILTER (WHERE doc_id IS NULL) AS doc_id, count(*) FILTER (WHERE text IS NULL) AS text,
    count(*) FILTER (WHERE lang IS NULL) AS lang, count(*) FILTER (WHERE source IS NULL) AS source,
    count(*) FILTER (WHERE n_chars IS NULL) AS n_chars, count(*) FILTER (WHERE quality IS NULL) AS quality,
    count(*) FILTER (WHERE toxic IS NULL) AS toxic FROM rev)
   ON doc_id, text, lang, source, n_chars, quality, toxic INTO NAME name VALUE value) u, n),
num AS (SELECT * FROM (UNPIVOT (SELECT doc_id::DOUBLE AS doc_id, n_chars::DOUBLE AS n_chars, toxic::DOUBLE AS toxic FROM rev)
  ON doc_id, n_chars, toxic INTO NAME "column" VALUE v)),
lim AS (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, avg(v) AS m, stddev_pop(v) AS s
  FROM num GROUP BY 1),
outl AS (SELECT num."column", count(*) FILTER (WHERE v < q1 - (q3 - q1) * 1.5 OR v > q3 + (q3 - q1) * 1.5) AS i,
  count(*) FILTER (WHERE abs(v - m) > s * 3.0) AS z FROM num JOIN lim ON num."column" = lim."column" GROUP BY 1),
cls AS (SELECT max(c) AS hi, max(c)::DOUBLE / min(c)::DOUBLE AS r FROM
  (SELECT count(*) AS c FROM rev WHERE quality IS NOT NULL GROUP BY quality)),
found AS (
SELECT 'missing' AS type, CASE WHEN pct > 30 THEN 'high' WHEN pct >= 10 THEN 'medium' ELSE 'low' END AS severity,
  "column", count, pct FROM gaps
UNION ALL SELECT 'outliers_iqr', CASE WHEN i / n * 100.0 > 5 THEN 'high' WHEN i / n * 100.0 >= 1 THEN 'medium' ELSE 'low' END,
  "column", i, i::DOUBLE / n * 100.0 FROM outl, n
UNION ALL SELECT 'outliers_zscore', CASE WHEN z / n * 100.0 > 5 THEN 'high' WHEN z / n * 100.0 >= 1 THEN 'medium' ELSE 'low' END,
  "column", z, z::DOUBLE / n * 100.0 FROM outl, n
UNION ALL SELECT 'imbalance', CASE WHEN r > 10 THEN 'high' WHEN r >= 3 THEN 'medium' ELSE 'low' END, 'quality', hi, r
  FROM cls WHERE r > 1)
"""


@query("detect_all", SCAN_SQL + 'SELECT type, severity, "column", count, pct FROM found WHERE count > 0')
def detect_all(spark, folder):
    return quality.detect_all(reviews(spark, folder), "quality")


@query(
    "scan_score",
    SCAN_SQL + """SELECT count(*) AS n_issues, greatest(0.0, 100.0 - sum(CASE severity WHEN 'high' THEN 10.0
    WHEN 'medium' THEN 5.0 ELSE 2.0 END))::DOUBLE AS score FROM found WHERE count > 0""",
)
def scan_score(spark, folder):
    return quality.scan_score(quality.detect_all(reviews(spark, folder), "quality"))


@query(
    "outlier_counts",
    """WITH num AS (SELECT * FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
      ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME "column" VALUE v)),
    lim AS (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, avg(v) AS m, stddev_pop(v) AS s
      FROM num GROUP BY 1)
    SELECT num."column", count(*) AS n,
    count(*) FILTER (WHERE v < q1 - (q3 - q1) * 0.4 OR v > q3 + (q3 - q1) * 0.4) AS n_iqr,
    count(*) FILTER (WHERE abs(v - m) > s * 1.6) AS n_zscore
    FROM num JOIN lim ON num."column" = lim."column" GROUP BY 1""",
)
def outlier_counts(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return profile.outlier_counts(table(spark, folder, "lineitem").select(*columns), columns, 0.4, 1.6)


@query(
    "iqr_outliers",
    """WITH q AS (SELECT quantile_cont(n_chars::DOUBLE, 0.25) AS q1, quantile_cont(n_chars::DOUBLE, 0.75) AS q3 FROM documents)
    SELECT doc_id, n_chars, n_chars < q1 - (q3 - q1) * 1.5 OR n_chars > q3 + (q3 - q1) * 1.5 AS is_outlier
    FROM documents, q""",
)
def iqr_outliers(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return cleaning.flag_outliers(docs, "n_chars", "iqr", 1.5)


@query(
    "zscore_outliers",
    """WITH q AS (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS s FROM documents)
    SELECT doc_id, n_chars, n_chars < m - s * 3.0 OR n_chars > m + s * 3.0 AS is_outlier FROM documents, q""",
)
def zscore_outliers(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return cleaning.flag_outliers(docs, "n_chars", "zscore", 3.0)


@query(
    "quality_bands",
    """SELECT band, count(*) AS n FROM (SELECT CASE WHEN o_totalprice / 5000.0 >= 80 THEN 'good'
    WHEN o_totalprice / 5000.0 >= 60 THEN 'fair' ELSE 'poor' END AS band FROM orders) GROUP BY band""",
)
def quality_bands(spark, folder):
    from tablewright.operators.compare import score_band

    orders = table(spark, folder, "orders").select(score_band(F.col("o_totalprice") / 5000.0).alias("band"))
    return orders.groupBy("band").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fix_report",
    f"""WITH {A_SQL} SELECT 'conservative' AS name, (SELECT count(*) FROM a) AS rows, (SELECT count(*) FROM rev) AS n_rows, 7::BIGINT AS n_cols,
    (SELECT count(*) FROM rev WHERE {SHORT} AND NOT {DAMAGED}) AS short_dropped
    UNION ALL SELECT 'flagged', (SELECT count(*) FROM clean), (SELECT count(*) FROM rev), 7,
    (SELECT count(*) FROM rev WHERE {SHORT} AND NOT {DAMAGED})""",
)
def fix_report(spark, folder):
    rows = reviews(spark, folder)
    sets = {
        "conservative": cleaning.strategy_conservative(rows, "text", "source", "doc_id"),
        "flagged": cleaning.strategy_flag_duplicates(rows, "text", "source", "doc_id"),
    }
    report = quality.fix_report(rows, sets, **ROLES)
    short = F.filter("decisions", lambda d: d["issue"] == "short_review")[0]["rows_dropped"]
    return report.select(
        F.explode("strategies").alias("s"), F.get("original_shape", 0).alias("n_rows"),
        F.get("original_shape", 1).alias("n_cols"), short.alias("short_dropped"),
    ).select("s.name", "s.rows", "n_rows", "n_cols", "short_dropped")
