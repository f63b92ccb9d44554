"""Prefix match, merges, fuzzy keys, sections, set operations and before/after comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import text as tx
from tablewright.operators import cleaning, compare, matching
from tablewright.plans.quality_queries import A_SQL, CLEAN_SQL, DAMAGED, SHORT
from tablewright.plans.registry import REVIEWS_SQL, ROLES, near, query, reviews, table

PRODUCTS_SQL = """f AS (SELECT p_partkey, upper(p_brand) || ' ' || p_name AS product FROM part),
 names AS (SELECT DISTINCT substr(p_brand, 1, 7) AS name FROM part UNION SELECT DISTINCT p_brand FROM part WHERE p_size <= 2
   UNION SELECT DISTINCT p_brand || ' ' || split_part(p_name, ' ', 1) FROM part WHERE p_size = 3),
 best AS (SELECT p_partkey, product, name AS matched_name FROM (SELECT f.*, n.name,
   row_number() OVER (PARTITION BY p_partkey ORDER BY length(n.name) DESC NULLS LAST) AS rn
   FROM f LEFT JOIN names n ON starts_with(lower(f.product), lower(n.name))) WHERE rn = 1)"""


def _names(part):
    """Product names derived from brands: short and long ones, many a prefix of another."""
    return (
        part.select(F.substring("p_brand", 1, 7).alias("name"))
        .union(part.where("p_size <= 2").select("p_brand"))
        .union(part.where("p_size = 3").select(F.concat_ws(" ", "p_brand", tx.first_token("p_name"))))
        .distinct()
    )


def _products(spark, folder):
    part = table(spark, folder, "part")
    fact = part.select("p_partkey", F.concat(F.upper("p_brand"), F.lit(" "), F.col("p_name")).alias("product"))
    return matching.longest_prefix_match(fact, _names(part), "product", "name", ["p_partkey"])


@query("longest_prefix_join", f"WITH {PRODUCTS_SQL} SELECT * FROM best")
def longest_prefix_join(spark, folder):
    return _products(spark, folder)


@query(
    "merge_reviews",
    f"""WITH {PRODUCTS_SQL}, dim AS (SELECT name AS perfume_name, length(name)::INT AS rating FROM names)
    SELECT b.matched_name AS perfume_name, rating, f.p_size AS reviewer FROM best b JOIN part f ON f.p_partkey = b.p_partkey
    LEFT JOIN dim ON dim.perfume_name = b.matched_name""",
)
def merge_reviews(spark, folder):
    part = table(spark, folder, "part")
    corpus = part.select(
        F.col("p_partkey").alias("no"), F.concat(F.upper("p_brand"), F.lit(" "), F.col("p_name")).alias("product"),
        F.col("p_size").alias("user"),
    )
    dimension = _names(part).withColumn("rating", F.length("name"))
    return matching.merge_reviews(corpus, dimension, ["no"], columns=["perfume_name", "rating", "reviewer"])


@query("unmatched_keys", "SELECT DISTINCT source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality IS NOT NULL)")
def unmatched_keys(spark, folder):
    return matching.unmatched_keys(reviews(spark, folder), "quality", "source")


@query(
    "rows_without_partner",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
)
def rows_without_partner(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return matching.rows_without_partner(table(spark, folder, "customer").select("c_custkey", "c_name"), orders, ["c_custkey"])


@query(
    "enrich",
    """SELECT c_custkey, c_nationkey AS n_nationkey, n_name, n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def enrich(spark, folder):
    fact = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return matching.enrich(fact, table(spark, folder, "nation"), "n_nationkey")


@query(
    "enrich_missing_keys",
    f"""WITH {REVIEWS_SQL}, dim AS (SELECT quality, count(*) AS n_docs FROM rev GROUP BY quality)
    SELECT rev.doc_id, rev.quality, dim.n_docs FROM rev LEFT JOIN dim ON rev.quality IS NOT DISTINCT FROM dim.quality""",
)
def enrich_missing_keys(spark, folder):
    rows = reviews(spark, folder).select("doc_id", "quality")
    dim = rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n_docs"))
    return matching.enrich(rows, dim, "quality", match_missing=True)


@query(
    "merge_with_origin",
    """WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS k, a.n AS n_x, b.n AS n_y, CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only'
      ELSE 'both' END AS _merge FROM a FULL JOIN b ON a.k = b.k""",
)
def merge_with_origin(spark, folder):
    a = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    b = table(spark, folder, "events").groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return matching.merge_tables(a, b, ["k"], "outer", indicator="_merge")


@query(
    "merge_diagnostics",
    """WITH a AS (SELECT user_id AS k, count(*) AS a FROM events GROUP BY 1),
    b AS (SELECT o_custkey AS k, count(*) AS b FROM orders GROUP BY 1),
    j AS (SELECT a, b FROM a FULL JOIN b ON a.k = b.k)
    SELECT sum(a)::BIGINT AS rows_left, sum(b)::BIGINT AS rows_right,
    sum(coalesce(a, 0) * coalesce(b, 0))::BIGINT AS rows_inner,
    sum(coalesce(a, 0) * coalesce(b, 0) + CASE WHEN b IS NULL THEN a ELSE 0 END)::BIGINT AS rows_left_join,
    sum(coalesce(a, 0) * coalesce(b, 0) + CASE WHEN b IS NULL THEN a ELSE 0 END + CASE WHEN a IS NULL THEN b ELSE 0 END)::BIGINT AS rows_outer,
    sum(CASE WHEN b IS NULL THEN a ELSE 0 END)::BIGINT AS lost_left, sum(CASE WHEN a IS NULL THEN b ELSE 0 END)::BIGINT AS lost_right,
    count(*) FILTER (WHERE a > 1 AND b > 1) AS many_to_many_keys FROM j""",
)
def merge_diagnostics(spark, folder):
    a = table(spark, folder, "events").select(F.col("user_id").alias("k"))
    b = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"))
    return matching.merge_diagnostics(a, b, ["k"])


@query(
    "canonical_keys",
    """WITH al AS (SELECT DISTINCT p_type AS alias, substr(p_type, 1, 3) AS short FROM part WHERE p_type < 'N')
    SELECT p_partkey, p_type, coalesce(short, p_type) AS canonical_key FROM part LEFT JOIN al ON p_type = alias""",
)
def canonical_keys(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_type")
    aliases = part.where("p_type < 'N'").select(F.col("p_type").alias("alias"), F.substring("p_type", 1, 3).alias("short")).distinct()
    return matching.canonical_keys(part, "p_type", aliases, "alias", "short", ["p_partkey"])


# ASCII letters only: the SQL engine measures edits in bytes
WORDS_SQL = """SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) AS w FROM """


def _words(df):
    found = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), F.lit(0))
    return df.select(F.explode(found).alias("w")).distinct()


@query(
    "fuzzy_match",
    f"""WITH a AS ({WORDS_SQL} benchmark), b AS ({WORDS_SQL} conversations),
    o AS (SELECT w FROM a WHERE w NOT IN (SELECT w FROM b)),
    m AS (SELECT o.w AS left_key, b.w AS right_key, levenshtein(o.w, b.w) AS distance FROM o, b
      WHERE abs(length(o.w) - length(b.w)) <= 1 AND levenshtein(o.w, b.w) <= 1)
    SELECT left_key, right_key, distance::INT AS distance FROM (SELECT *, row_number() OVER
      (PARTITION BY left_key ORDER BY distance, right_key) AS rn FROM m) WHERE rn = 1""",
)
def fuzzy_match(spark, folder):
    return matching.fuzzy_match(
        _words(table(spark, folder, "benchmark")), _words(table(spark, folder, "conversations")), "w", "w", 1
    )


@query(
    "fuzzy_names",
    """WITH b AS (SELECT 'https://shop.example/customer/' || c_name || '/orders' AS k FROM customer),
    a AS (SELECT DISTINCT replace(replace(k, '7/orders', '/orders'), '1', 'l') AS k FROM b WHERE k LIKE '%7/orders'),
    o AS (SELECT k FROM a WHERE k NOT IN (SELECT k FROM b)),
    m AS (SELECT o.k AS left_key, b.k AS right_key, levenshtein(o.k, b.k) AS distance FROM o JOIN b
      ON abs(length(o.k) - length(b.k)) <= 2 AND levenshtein(o.k, b.k) <= 2)
    SELECT left_key, right_key, distance::INT AS distance FROM (SELECT *, row_number() OVER
      (PARTITION BY left_key ORDER BY distance, right_key) AS rn FROM m) WHERE rn = 1""",
)
def fuzzy_names(spark, folder):
    """Addresses that begin and end alike, a tenth of them with a character lost and others mistaken."""
    known = table(spark, folder, "customer").select(
        F.concat(F.lit("https://shop.example/customer/"), F.col("c_name"), F.lit("/orders")).alias("k")
    )
    typed = known.where(F.col("k").endswith("7/orders")).select(
        F.replace(F.replace("k", F.lit("7/orders"), F.lit("/orders")), F.lit("1"), F.lit("l")).alias("k")
    )
    return matching.fuzzy_match(typed, known, "k", "k", 2)


EVENT_SECTIONS = [("top", ["VIEW"]), ("middle", ["CLICK", "CART"]), ("base", ["PURCHASE"])]


@query(
    "assign_sections",
    """WITH h AS (SELECT user_id, event_id, CASE WHEN event_type = 'view' THEN 'top' WHEN event_type IN ('click', 'cart') THEN 'middle'
      WHEN event_type = 'purchase' THEN 'base' END AS section FROM events WHERE event_type IN ('view', 'click', 'cart', 'purchase')),
    l AS (SELECT user_id, event_id, event_type AS text FROM events),
    m AS (SELECT l.user_id, l.event_id, l.text, h.section, row_number() OVER (PARTITION BY l.event_id ORDER BY h.event_id DESC) AS rn
      FROM l JOIN h ON l.user_id = h.user_id AND h.event_id - 5 <= l.event_id)
    SELECT user_id, event_id, text, section FROM m WHERE rn = 1""",
)
def assign_sections(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", F.col("event_type").alias("text"), "value")
    return matching.assign_sections(
        events, events, "user_id", "event_id", "text", 5.0, 60, EVENT_SECTIONS
    )


@query(
    "counts_side_by_side",
    f"""WITH {A_SQL}, o AS (SELECT source, count(*) AS n FROM rev GROUP BY 1)
    SELECT o.source, o.n::BIGINT AS n_original, (SELECT count(*) FROM clean WHERE clean.source = o.source) AS n_clean,
    (SELECT count(*) FROM a WHERE a.source = o.source) AS n_conservative FROM o""",
)
def counts_side_by_side(spark, folder):
    rows = reviews(spark, folder)
    sets = {
        "original": rows,
        "clean": cleaning.without_bad_text(rows, "text"),
        "conservative": cleaning.strategy_conservative(rows, "text", "source", "doc_id"),
    }
    return matching.counts_side_by_side(sets, "source", "original")


@query(
    "stack_distinct",
    """SELECT lang AS name, NULL::VARCHAR AS role FROM documents UNION SELECT NULL, role FROM conversations""",
)
def stack_distinct(spark, folder):
    a = table(spark, folder, "documents").select(F.col("lang").alias("name"))
    b = table(spark, folder, "conversations").select("role")
    return matching.stack_tables(a, b, distinct=True)


@query(
    "stack_rows",
    """SELECT kind, count(*) AS n FROM (SELECT 'c' AS kind, c_acctbal FROM customer UNION ALL SELECT 's', s_acctbal FROM supplier) GROUP BY kind""",
)
def stack_rows(spark, folder):
    a = table(spark, folder, "customer").select(F.lit("c").alias("kind"), F.col("c_acctbal").alias("balance"))
    b = table(spark, folder, "supplier").select(F.lit("s").alias("kind"), F.col("s_acctbal").alias("balance"))
    return matching.stack_tables(a, b).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "side_by_side",
    """SELECT coalesce(n_nationkey, r_regionkey)::INT AS k, n_name, r_name FROM nation FULL JOIN region ON n_nationkey = r_regionkey""",
)
def side_by_side(spark, folder):
    a = table(spark, folder, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    b = table(spark, folder, "region").select(F.col("r_regionkey").alias("k"), "r_name")
    return matching.side_by_side(a, b, "k")


_KS_SQL = """, u AS (SELECT length(text)::DOUBLE AS v, 1 AS a, 0 AS b FROM {0} UNION ALL SELECT length(text), 0, 1 FROM {1}),
 g AS (SELECT v, sum(a) AS a, sum(b) AS b FROM u WHERE v IS NOT NULL GROUP BY v),
 t AS (SELECT sum(a) AS n1, sum(b) AS n2 FROM g),
 c AS (SELECT sum(a) OVER w / n1 AS f1, sum(b) OVER w / n2 AS f2, n1, n2 FROM g, t WINDOW w AS (ORDER BY v))
 SELECT max(abs(f1 - f2)) AS statistic, any_value(n1)::BIGINT AS n1, any_value(n2)::BIGINT AS n2 FROM c"""


@query("ks_two_sample", f"WITH {A_SQL}" + _KS_SQL.format("rev", "a"))
def ks_two_sample(spark, folder):
    rows = reviews(spark, folder)
    clean = cleaning.strategy_conservative(rows, "text", "source", "doc_id")
    return compare.ks_two_sample(rows, clean, F.length("text")).select("statistic", "n1", "n2")


def _ks_rows_sql(pairs) -> str:
    """Statistic, sizes and asymptotic p-value of each pair, in SQL."""
    parts = []
    for name, (a, b) in pairs.items():
        parts.append(f"""SELECT '{name}' AS pair, statistic, n1, n2,
          statistic * sqrt(n1::DOUBLE * n2 / (n1 + n2)) AS x FROM (WITH {_KS_SQL.format(a, b).lstrip().lstrip(',')})""")
    return f"""SELECT pair, statistic, n1, n2, CASE WHEN x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
      2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * x * x))))) END AS pvalue
      FROM ({' UNION ALL '.join(parts)})"""


@query(
    "ks_p_values",
    f"""WITH {A_SQL}, k AS ({_ks_rows_sql({"original_clean": ("rev", "clean"), "original_conservative": ("rev", "a"), "clean_conservative": ("clean", "a")})})
    SELECT pair, statistic, n1, n2, round(pvalue, 6) AS pvalue, pvalue < 0.05 AS differs FROM k""",
)
def ks_p_values(spark, folder):
    rows = reviews(spark, folder)
    clean = cleaning.without_bad_text(rows, "text")
    one = cleaning.strategy_conservative(rows, "text", "source", "doc_id")
    pairs = {"original_clean": (rows, clean), "original_conservative": (rows, one), "clean_conservative": (clean, one)}
    parts = [
        compare.ks_two_sample(a, b, F.length("text")).withColumn("pair", F.lit(name))
        for name, (a, b) in pairs.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("pvalue", near("pvalue"))


@query(
    "profile_change",
    """WITH u AS (SELECT 'l_quantity' AS "column", l_quantity AS v, l_returnflag FROM lineitem
      UNION ALL SELECT 'l_extendedprice', l_extendedprice, l_returnflag FROM lineitem),
    p AS (SELECT "column", count(v) AS n_before, avg(v) AS mean_before, stddev_samp(v) AS std_before, min(v) AS min_before, max(v) AS max_before,
      count(v) FILTER (WHERE l_returnflag <> 'R') AS n_after, avg(v) FILTER (WHERE l_returnflag <> 'R') AS mean_after,
      stddev_samp(v) FILTER (WHERE l_returnflag <> 'R') AS std_after, min(v) FILTER (WHERE l_returnflag <> 'R') AS min_after,
      max(v) FILTER (WHERE l_returnflag <> 'R') AS max_after FROM u GROUP BY 1)
    SELECT "column", n_before, n_after, min_before, min_after, max_before, max_after, round(mean_before, 4) AS mean_before,
    round(mean_after, 4) AS mean_after, round(std_before, 4) AS std_before, round(std_after, 4) AS std_after,
    round(mean_after - mean_before, 4) AS mean_shift FROM p""",
)
def profile_change(spark, folder):
    rows = table(spark, folder, "lineitem")
    found = compare.profile_change(rows, rows.where("l_returnflag <> 'R'"), ["l_quantity", "l_extendedprice"])
    return found.withColumns(
        {c: near(c, 4) for c in ("mean_before", "mean_after", "std_before", "std_after", "mean_shift")}
    )


@query(
    "correlation_change",
    """SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, round(corr(l_quantity, l_extendedprice), 6) AS r_before,
    round(corr(l_quantity, l_extendedprice) FILTER (WHERE l_returnflag <> 'R'), 6) AS r_after FROM lineitem""",
)
def correlation_change(spark, folder):
    rows = table(spark, folder, "lineitem")
    found = compare.correlation_change(rows, rows.where("l_returnflag <> 'R'"), ["l_quantity", "l_extendedprice"])
    return found.withColumns({"r_before": near("r_before"), "r_after": near("r_after")})


_TABLE_SQL = """SELECT '{0}' AS dataset, unnest(['rows', 'missing', 'duplicates', 'loss_pct', 'imbalance_ratio', 'outliers_iqr']) AS metric,
 unnest([n, g, n - d, (1 - n / (SELECT count(*) FROM rev)) * 100.0, r, o]) AS value FROM (SELECT count(*)::DOUBLE AS n,
 sum((quality IS NULL)::INT + (toxic IS NULL)::INT)::DOUBLE AS g,
 (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars, quality, toxic FROM {1}))::DOUBLE AS d,
 (SELECT max(c)::DOUBLE / min(c) FROM (SELECT count(*) AS c FROM {1} WHERE quality IS NOT NULL GROUP BY quality)) AS r,
 (SELECT sum(o) FROM (SELECT count(*) FILTER (WHERE n_chars < q1 - (q3 - q1) * 1.5 OR n_chars > q3 + (q3 - q1) * 1.5) AS o
   FROM {1}, (SELECT quantile_cont(n_chars::DOUBLE, 0.25) AS q1, quantile_cont(n_chars::DOUBLE, 0.75) AS q3 FROM {1})
   UNION ALL SELECT count(*) FILTER (WHERE toxic < q1 - (q3 - q1) * 1.5 OR toxic > q3 + (q3 - q1) * 1.5)
   FROM {1}, (SELECT quantile_cont(toxic::DOUBLE, 0.25) AS q1, quantile_cont(toxic::DOUBLE, 0.75) AS q3 FROM {1})))::DOUBLE AS o FROM {1})"""


@query(
    "comparison_table",
    f"WITH {CLEAN_SQL} " + _TABLE_SQL.format("original", "rev") + " UNION ALL " + _TABLE_SQL.format("clean", "clean"),
)
def comparison_table(spark, folder):
    rows = reviews(spark, folder).drop("doc_id")
    sets = {"original": rows, "clean": cleaning.without_bad_text(rows, "text")}
    wanted = ["rows", "missing", "duplicates", "loss_pct", "imbalance_ratio", "outliers_iqr"]
    return compare.comparison_table(sets, "original", "quality").where(F.col("metric").isin(wanted))


def _score_sql(t: str, columns: list[str]) -> str:
    """Quality score of a table of reviews as a scalar subquery."""
    gaps = " + ".join(f"({c} IS NULL)::INT" for c in columns)
    return f"""(SELECT greatest(0.0, round(100.0 - (least(nd / n * 100.0 * 25.0, 30.0) + least(ns / n * 100.0 * 15.0, 15.0)
      + least(dup / n * 100.0 * 10.0, 15.0) + CASE WHEN leak THEN 10.0 ELSE 0.0 END + least(gaps / (n * {len(columns)}) * 100.0 * 20.0, 20.0)), 1))
      FROM (SELECT count(*)::DOUBLE AS n, (count(*) FILTER (WHERE {DAMAGED}))::DOUBLE AS nd,
        (count(*) FILTER (WHERE {SHORT} AND NOT {DAMAGED}))::DOUBLE AS ns, sum({gaps})::DOUBLE AS gaps FROM {t}),
      (SELECT coalesce(sum(c), 0)::DOUBLE AS dup FROM (SELECT count(*) AS c FROM {t} WHERE source IS NOT NULL GROUP BY source HAVING count(*) > 1)),
      (SELECT coalesce(bool_and(d = 1), true) AS leak FROM (SELECT count(DISTINCT quality) AS d FROM {t} WHERE lang IS NOT NULL GROUP BY lang)))"""


CONTENT = ["text", "lang", "source", "n_chars", "quality", "toxic"]


def _more_metrics_sql(name: str, t: str) -> str:
    z = " + ".join(
        f"(SELECT count(*) FILTER (WHERE abs({c} - m) > s * 3.0) FROM {t}, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM {t}))"
        for c in ("n_chars", "toxic")
    )
    gaps = " + ".join(f"({c} IS NULL)::INT" for c in CONTENT)
    return f"""SELECT '{name}' AS dataset, unnest(['cols', 'missing_pct', 'outliers_zscore', 'quality_score']) AS metric,
      unnest([{len(CONTENT)}.0::DOUBLE, (SELECT sum({gaps})::DOUBLE / count(*) / {len(CONTENT)} * 100.0 FROM {t}), ({z})::DOUBLE, {_score_sql(t, CONTENT)}::DOUBLE]) AS value"""


@query(
    "comparison_table_wide",
    f"WITH {CLEAN_SQL}, m AS (" + " UNION ALL ".join([
        _TABLE_SQL.format("original", "rev"), _TABLE_SQL.format("clean", "clean"),
        _more_metrics_sql("original", "rev"), _more_metrics_sql("clean", "clean"),
    ]) + """) SELECT metric, round(max(value) FILTER (WHERE dataset = 'original'), 6) AS original,
    round(max(value) FILTER (WHERE dataset = 'clean'), 6) AS clean FROM m GROUP BY metric""",
)
def comparison_table_wide(spark, folder):
    rows = reviews(spark, folder).drop("doc_id")
    sets = {"original": rows, "clean": cleaning.without_bad_text(rows, "text")}
    wide = compare.comparison_table(sets, "original", "quality", ROLES, wide=True)
    return wide.withColumns({c: near(c) for c in sets})


ALL_COLUMNS = ["doc_id", *CONTENT]


@query(
    "strategy_comparison",
    f"""WITH {A_SQL}, k AS ({_ks_rows_sql({"conservative": ("rev", "a"), "flagged": ("rev", "clean")})}),
    s AS (""" + " UNION ALL ".join(
        f"SELECT '{name}' AS strategy, (SELECT count(*) FROM {t}) AS rows, {_score_sql(t, ALL_COLUMNS)}::DOUBLE AS quality_score"
        for name, t in (("original", "rev"), ("conservative", "a"), ("flagged", "clean"))
    ) + """), l AS (SELECT *, round((1 - rows::DOUBLE / (SELECT count(*) FROM rev)) * 100.0, 2) AS loss_pct FROM s),
    b AS (SELECT strategy FROM l WHERE strategy <> 'original' ORDER BY quality_score DESC, loss_pct, strategy LIMIT 1)
    SELECT l.strategy, l.rows, l.loss_pct, l.quality_score, round(k.statistic, 4) AS ks_statistic, round(k.pvalue, 4) AS ks_pvalue,
    l.strategy = (SELECT strategy FROM b) AS recommended FROM l LEFT JOIN k ON k.pair = l.strategy""",
)
def strategy_comparison(spark, folder):
    rows = reviews(spark, folder)
    sets = {
        "conservative": cleaning.strategy_conservative(rows, "text", "source", "doc_id"),
        "flagged": cleaning.strategy_flag_duplicates(rows, "text", "source", "doc_id"),
    }
    return compare.strategy_comparison(rows, sets, **ROLES)
