"""Profiles, distributions, group summaries and item lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import scalars, text as tx
from tablewright.operators import cleaning, compare, missingness, profile, sketches
from tablewright.operators.ordered import exact_quantiles
from tablewright.plans.quality_queries import A_SQL, CLEAN_SQL
from tablewright.plans.registry import REVIEWS_SQL, near, query, reviews, table
from tablewright.session import cut_lineage


@query(
    "missing_profile",
    f"""WITH {REVIEWS_SQL}, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE doc_id IS NULL) AS doc_id,
    count(*) FILTER (WHERE text IS NULL) AS text, count(*) FILTER (WHERE lang IS NULL) AS lang,
    count(*) FILTER (WHERE source IS NULL) AS source, count(*) FILTER (WHERE n_chars IS NULL) AS n_chars,
    count(*) FILTER (WHERE quality IS NULL) AS quality, count(*) FILTER (WHERE toxic IS NULL) AS toxic FROM rev),
    u AS (SELECT n, name, value FROM (UNPIVOT c ON doc_id, text, lang, source, n_chars, quality, toxic INTO NAME name VALUE value))
    SELECT name AS "column", value AS n_missing, value::DOUBLE / n::DOUBLE * 100.0 AS pct_missing,
    CASE WHEN value::DOUBLE / n * 100.0 > 30 THEN 'high' WHEN value::DOUBLE / n * 100.0 >= 10 THEN 'medium' ELSE 'low' END AS severity
    FROM u""",
)
def missing_profile(spark, folder):
    return profile.missing_profile(reviews(spark, folder))


@query(
    "mostly_missing",
    f"""WITH {REVIEWS_SQL}, n AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE quality IS NULL) AS q,
    count(*) FILTER (WHERE toxic IS NULL) AS t FROM rev)
    SELECT 'quality' AS "column", q AS n_missing, q / n * 100.0 AS pct_missing FROM n WHERE q / n * 100.0 > 50
    UNION ALL SELECT 'toxic', t, t / n * 100.0 FROM n WHERE t / n * 100.0 > 50""",
)
def mostly_missing(spark, folder):
    return profile.mostly_missing(reviews(spark, folder), 50.0).drop("severity")


@query(
    "missing_patterns",
    f"""WITH {REVIEWS_SQL} SELECT concat_ws(',', CASE WHEN quality IS NULL THEN 'quality' END,
    CASE WHEN toxic IS NULL THEN 'toxic' END) AS missing_columns, count(*) AS n FROM rev GROUP BY 1""",
)
def missing_patterns(spark, folder):
    return profile.missing_patterns(reviews(spark, folder))


@query(
    "missing_correlation",
    f"""WITH {REVIEWS_SQL} SELECT 'quality' AS x, 'toxic' AS y,
    round(corr((quality IS NULL)::INT, (toxic IS NULL)::INT), 6) AS r FROM rev""",
)
def missing_correlation(spark, folder):
    found = profile.missing_correlation(reviews(spark, folder), ["quality", "toxic"])
    return found.withColumn("r", near("r"))


@query(
    "full_duplicates",
    """WITH g AS (SELECT count(*) AS c FROM documents GROUP BY text, lang, source, n_chars),
    s AS (SELECT sum(c)::BIGINT AS n_rows, sum(c - 1)::BIGINT AS n_duplicates FROM g)
    SELECT *, n_duplicates::DOUBLE / n_rows::DOUBLE * 100.0 AS pct_duplicates,
    CASE WHEN n_duplicates::DOUBLE / n_rows * 100.0 > 5 THEN 'high' WHEN n_duplicates::DOUBLE / n_rows * 100.0 >= 1
      THEN 'medium' ELSE 'low' END AS severity FROM s""",
)
def full_duplicates(spark, folder):
    return profile.full_duplicates(table(spark, folder, "documents").drop("doc_id"))


@query(
    "key_duplicates",
    """WITH g AS (SELECT count(*) AS c FROM orders GROUP BY o_custkey, o_orderpriority),
    s AS (SELECT sum(c)::BIGINT AS n_rows, sum(c - 1)::BIGINT AS n_duplicates FROM g)
    SELECT *, n_duplicates::DOUBLE / n_rows::DOUBLE * 100.0 AS pct_duplicates, 'high' AS severity FROM s""",
)
def key_duplicates(spark, folder):
    return profile.key_duplicates(table(spark, folder, "orders"), ["o_custkey", "o_orderpriority"])


@query(
    "value_counts",
    f"""WITH {REVIEWS_SQL} SELECT 'present' AS kind, quality::VARCHAR AS value, count(*) AS n FROM rev
    WHERE quality IS NOT NULL GROUP BY quality
    UNION ALL SELECT 'all', quality::VARCHAR, count(*) FROM rev GROUP BY quality""",
)
def value_counts(spark, folder):
    rows = reviews(spark, folder)
    value = F.col("quality").cast("string").alias("value")
    present = profile.value_counts(rows, "quality").select(F.lit("present").alias("kind"), value, "n")
    every = profile.value_counts(rows, "quality", dropna=False).select(F.lit("all").alias("kind"), value, "n")
    return present.unionByName(every)


@query(
    "distinct_counts",
    """SELECT count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_suppkey) AS l_suppkey,
    count(DISTINCT l_shipdate) AS l_shipdate FROM lineitem""",
)
def distinct_counts(spark, folder):
    return profile.distinct_counts(table(spark, folder, "lineitem"), ["l_partkey", "l_suppkey", "l_shipdate"])


@query(
    "repeated_keys",
    """SELECT count(*) AS n_keys, sum(c)::BIGINT AS n_rows FROM
    (SELECT count(*) AS c FROM events WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1)""",
)
def repeated_keys(spark, folder):
    return profile.repeated_keys(table(spark, folder, "events"), "user_id")


@query("top_repeated_keys", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1 ORDER BY n DESC, user_id LIMIT 10")
def top_repeated_keys(spark, folder):
    return profile.top_repeated_keys(table(spark, folder, "events"), "user_id", 10)


@query(
    "table_overview",
    """SELECT * FROM (VALUES (0, 'doc_id', 'bigint'), (1, 'text', 'string'), (2, 'lang', 'string'), (3, 'source', 'string'),
    (4, 'n_chars', 'bigint')) t(position, "column", type), (SELECT count(*) AS n_rows FROM documents), (SELECT 5 AS n_cols)""",
)
def table_overview(spark, folder):
    return profile.table_overview(table(spark, folder, "documents"))


@query("head_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5")
def head_rows(spark, folder):
    return profile.head_rows(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 5)


SUMMARY_SQL = f"""WITH {REVIEWS_SQL}, s AS (SELECT source,
  first(lang ORDER BY doc_id) AS lang, first(quality ORDER BY doc_id) FILTER (WHERE quality IS NOT NULL) AS quality,
  count(text) AS n_texts, avg(length(text)) AS mean_length FROM rev WHERE source IS NOT NULL GROUP BY source) """


def _summary(spark, folder):
    return profile.group_summary(reviews(spark, folder), "source", "doc_id", "text", ["lang", "quality"])


@query("group_summary", SUMMARY_SQL + "SELECT * FROM s")
def group_summary(spark, folder):
    return _summary(spark, folder)


@query(
    "mean_of_groups",
    SUMMARY_SQL + "SELECT round(avg(quality), 6) AS mean_quality, round(avg(mean_length), 6) AS mean_mean_length FROM s",
)
def mean_of_groups(spark, folder):
    means = profile.mean_of_groups(_summary(spark, folder), ["quality", "mean_length"])
    return means.select(*[near(c).alias(c) for c in means.columns])


@query(
    "best_group",
    SUMMARY_SQL + """SELECT 'n_texts' AS measure, (SELECT source FROM s ORDER BY n_texts DESC, source LIMIT 1) AS best,
    (SELECT max(n_texts) FROM s)::DOUBLE AS value
    UNION ALL SELECT 'mean_length', (SELECT source FROM s ORDER BY mean_length DESC, source LIMIT 1), (SELECT max(mean_length) FROM s)""",
)
def best_group(spark, folder):
    return profile.best_group(_summary(spark, folder), "source", ["n_texts", "mean_length"])


_STATS_SQL = """SELECT '{0}' AS dataset, count(*) AS n_rows, avg(length(text)) AS mean_len, min(length(text)) AS min_len,
  avg(len(regexp_extract_all(text, '[^\\s\\p{{Z}}]+'))) AS mean_words, median(length(text)) AS median_len,
  count(DISTINCT source) AS unique_keys, count(DISTINCT lang) AS unique_groups FROM {1}"""


@query(
    "text_stats",
    f"WITH {A_SQL} " + _STATS_SQL.format("original", "rev") + " UNION ALL " + _STATS_SQL.format("clean", "clean")
    + " UNION ALL " + _STATS_SQL.format("conservative", "a"),
)
def text_stats(spark, folder):
    rows = reviews(spark, folder)
    sets = {
        "original": rows,
        "clean": cleaning.without_bad_text(rows, "text"),
        "conservative": cleaning.strategy_conservative(rows, "text", "source", "doc_id"),
    }
    parts = [
        profile.text_stats(df, "text", "source", "lang").withColumn("dataset", F.lit(name))
        for name, df in sets.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "numeric_profile",
    """WITH u AS (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
    ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME "column" VALUE v)
    SELECT "column", count(v) AS n, round(avg(v), 5) AS mean, round(stddev_samp(v), 5) AS std, min(v) AS min, max(v) AS max
    FROM u GROUP BY 1""",
)
def numeric_profile(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = profile.numeric_profile(table(spark, folder, "lineitem"), columns)
    return rows.withColumns({"mean": near("mean", 5), "std": near("std", 5)})


@query("pearson", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem")
def pearson(spark, folder):
    return profile.pearson(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice").select(near("r").alias("r"))


@query(
    "correlation_matrix",
    """SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem
    UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) FROM lineitem
    UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM lineitem""",
)
def correlation_matrix(spark, folder):
    found = profile.correlation_matrix(
        table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]
    )
    return found.withColumn("r", near("r"))


@query(
    "imbalance",
    """WITH c AS (SELECT count(*) AS n FROM labels WHERE toxic IS NOT NULL GROUP BY toxic)
    SELECT max(n) AS majority, min(n) AS minority, max(n)::DOUBLE / min(n)::DOUBLE AS ratio,
    CASE WHEN max(n)::DOUBLE / min(n) > 10 THEN 'high' WHEN max(n)::DOUBLE / min(n) >= 3 THEN 'medium' ELSE 'low' END AS severity FROM c""",
)
def imbalance(spark, folder):
    return profile.imbalance(table(spark, folder, "labels"), "toxic")


@query(
    "histogram",
    """WITH e AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi, count(n_chars) AS t FROM documents),
    b AS (SELECT least(floor((n_chars - lo) / ((hi - lo) / 40.0))::INT, 39) AS bin, count(*) AS n FROM documents, e GROUP BY 1)
    SELECT g.bin::INT AS bin, coalesce(b.n, 0) AS n, round(lo + g.bin * ((hi - lo) / 40.0), 6) AS bin_lo,
    round(lo + (g.bin + 1) * ((hi - lo) / 40.0), 6) AS bin_hi, round(coalesce(b.n, 0) / (t * ((hi - lo) / 40.0)), 9) AS density
    FROM e, range(40) g(bin) LEFT JOIN b ON g.bin = b.bin""",
)
def histogram(spark, folder):
    rows = profile.histogram(table(spark, folder, "documents"), "n_chars", 40)
    return rows.withColumns({"bin_lo": near("bin_lo"), "bin_hi": near("bin_hi"), "density": near("density", 9)})


@query(
    "histogram_by_class",
    """WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
    b AS (SELECT l_returnflag, least(floor((l_extendedprice - lo) / ((hi - lo) / 15.0))::INT, 14) AS bin, count(*) AS n
      FROM lineitem, e GROUP BY 1, 2), c AS (SELECT DISTINCT l_returnflag FROM lineitem)
    SELECT c.l_returnflag, g.bin::INT AS bin, coalesce(b.n, 0) AS n FROM c CROSS JOIN range(15) g(bin)
    LEFT JOIN b ON g.bin = b.bin AND c.l_returnflag = b.l_returnflag""",
)
def histogram_by_class(spark, folder):
    rows = profile.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 15, by="l_returnflag")
    return rows.select("l_returnflag", "bin", "n")


@query(
    "density_curve",
    """WITH v AS (SELECT n_chars::DOUBLE AS v, count(*) AS w FROM documents GROUP BY 1),
    f AS (SELECT count(*)::DOUBLE AS n, stddev_samp(n_chars) AS sd, min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents),
    p AS (SELECT point, lo - (hi - lo) * 0.5 + point * ((hi - lo) * 2.0 / 63.0) AS x, n, sd * pow(n, -0.2) AS h FROM f, range(64) g(point))
    SELECT point::INT AS point, round(x, 4) AS x, round(sum(w * exp(-0.5 * ((x - v) / h) * ((x - v) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) * 1e6, 5) AS density
    FROM p, v GROUP BY point, x""",
)
def density_curve(spark, folder):
    rows = profile.density_curve(table(spark, folder, "documents"), "n_chars", 64)
    return rows.select("point", near("x", 4).alias("x"), near(F.col("density") * 1e6, 5).alias("density"))


_BOX_SQL = """, m AS (SELECT {0} quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM x {1})"""


@query(
    "box_stats",
    """WITH x AS (SELECT n_chars::DOUBLE AS v FROM documents)""" + _BOX_SQL.format("", "") + """
    SELECT q1, median, q3, min(v) FILTER (WHERE v >= q1 - (q3 - q1) * 1.5) AS whisker_lo,
    max(v) FILTER (WHERE v <= q3 + (q3 - q1) * 1.5) AS whisker_hi FROM x, m GROUP BY q1, median, q3""",
)
def box_stats(spark, folder):
    return profile.box_stats(table(spark, folder, "documents"), "n_chars")


@query(
    "box_stats_by_group",
    """WITH x AS (SELECT l_returnflag, l_extendedprice AS v FROM lineitem)""" + _BOX_SQL.format("l_returnflag,", "GROUP BY 1") + """
    SELECT x.l_returnflag, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
    min(v) FILTER (WHERE v >= q1 - (q3 - q1) * 1.5) AS whisker_lo,
    max(v) FILTER (WHERE v <= q3 + (q3 - q1) * 1.5) AS whisker_hi FROM x JOIN m ON x.l_returnflag = m.l_returnflag
    GROUP BY x.l_returnflag, q1, median, q3""",
)
def box_stats_by_group(spark, folder):
    rows = profile.box_stats(table(spark, folder, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return rows.withColumns({q: near(q) for q in ("q1", "median", "q3")})


@query(
    "groups_by_median",
    """WITH m AS (SELECT source, median(n_chars) AS median FROM documents WHERE source IS NOT NULL GROUP BY source)
    SELECT source, median, row_number() OVER (ORDER BY median DESC, source) AS place FROM m""",
)
def groups_by_median(spark, folder):
    return profile.groups_by_median(table(spark, folder, "documents"), "source", "n_chars")


@query(
    "group_quantiles",
    """SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50,
    round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY event_type""",
)
def group_quantiles(spark, folder):
    rows = profile.group_quantiles(
        table(spark, folder, "events"), "event_type", "value", {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    )
    return rows.select("event_type", *[near(q).alias(q) for q in ("p10", "p50", "p90")])


@query(
    "monthly_counts",
    """SELECT date_trunc('month', o_orderdate)::DATE AS period, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2""",
)
def monthly_counts(spark, folder):
    # dates pass through text, as the corpus stores them
    written = F.date_format("o_orderdate", "d.M.yyyy")
    day = scalars.parse_day(written)
    return profile.period_counts(table(spark, folder, "orders").select(day.alias("day"), "o_orderpriority"), "day", "o_orderpriority")


@query(
    "monthly_counts_events",
    """SELECT date_trunc('month', ts)::DATE AS period, event_type, count(*) AS n FROM events GROUP BY 1, 2""",
)
def monthly_counts_events(spark, folder):
    rows = table(spark, folder, "events").select(F.to_date("ts").alias("day"), "event_type")
    return profile.period_counts(rows, "day", "event_type")


@query(
    "parse_dates",
    """WITH t AS (SELECT o_orderkey, day(o_orderdate) || '.' || ((month(o_orderdate) + 6) % 14) || '.' || year(o_orderdate) AS s FROM orders)
    SELECT s IS NOT NULL AND try_strptime(s, '%d.%m.%Y') IS NULL AS invalid, count(*) AS n,
    min(try_strptime(s, '%d.%m.%Y')::DATE) AS first_day FROM t GROUP BY 1""",
)
def parse_dates(spark, folder):
    d = F.col("o_orderdate")
    s = F.concat_ws(".", F.dayofmonth(d), (F.month(d) + 6) % 14, F.year(d))
    rows = table(spark, folder, "orders").select(scalars.parse_day(s).alias("day"))
    return rows.groupBy(F.col("day").isNull().alias("invalid")).agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day")
    )


@query(
    "trend",
    """SELECT date_trunc('month', o_orderdate)::DATE AS period, count(o_totalprice) AS n, round(avg(o_totalprice), 2) AS mean
    FROM orders GROUP BY 1""",
)
def trend(spark, folder):
    rows = profile.trend(table(spark, folder, "orders"), "o_orderdate", "o_totalprice")
    return rows.withColumn("mean", near("mean", 2))


@query(
    "seasonality",
    """SELECT month(o_orderdate)::INT AS month, count(o_totalprice) AS n, round(avg(o_totalprice), 2) AS mean FROM orders GROUP BY 1""",
)
def seasonality(spark, folder):
    rows = profile.seasonality(table(spark, folder, "orders"), "o_orderdate", "o_totalprice")
    return rows.withColumn("mean", near("mean", 2))


@query(
    "table_facts",
    """SELECT count(*) AS n_rows, round(avg(o_totalprice), 4) AS mean_value, avg(length(o_orderpriority)) AS mean_length,
    min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day FROM orders""",
)
def table_facts(spark, folder):
    orders = table(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    rows = profile.table_facts(orders, "o_totalprice", "o_orderpriority", "day")
    return rows.withColumn("mean_value", near("mean_value", 4))


LEVELS = {"Top": "text", "Middle": "source", "Base": "lang"}
ITEMS_SQL = """items AS (SELECT doc_id, source, level, trim(item, ' \t\n\r') AS item FROM (
  SELECT doc_id, source, 'Top' AS level, unnest(string_split(text, ',')) AS item FROM documents
  UNION ALL SELECT doc_id, source, 'Middle', unnest(string_split(source, ',')) FROM documents
  UNION ALL SELECT doc_id, source, 'Base', unnest(string_split(lang, ',')) FROM documents)
  WHERE trim(item, ' \t\n\r') <> '')"""


def _items(spark, folder):
    return profile.list_items(table(spark, folder, "documents"), LEVELS, ["doc_id", "source"])


@query("top_items", f"WITH {ITEMS_SQL} SELECT item, count(*) AS n FROM items GROUP BY item ORDER BY n DESC, item LIMIT 20")
def top_items(spark, folder):
    return profile.top_items(profile.item_counts(_items(spark, folder)), 20)


@query(
    "top_items_per_level",
    f"""WITH {ITEMS_SQL}, c AS (SELECT level, item, count(*) AS n FROM items GROUP BY 1, 2)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY level ORDER BY n DESC, item)::INT AS place FROM c) WHERE place <= 10""",
)
def top_items_per_level(spark, folder):
    return profile.top_items_per_level(profile.item_counts(_items(spark, folder), by_level=True), 10)


@query(
    "items_in_distinct_sources",
    f"WITH {ITEMS_SQL} SELECT item, count(DISTINCT source) AS n FROM items GROUP BY item ORDER BY n DESC, item LIMIT 20",
)
def items_in_distinct_sources(spark, folder):
    return profile.top_items(profile.item_counts(_items(spark, folder), distinct_per="source"), 20)


@query("unique_items", f"WITH {ITEMS_SQL} SELECT count(DISTINCT item) AS n FROM items")
def unique_items(spark, folder):
    return profile.unique_items(_items(spark, folder)).agg(F.count(F.lit(1)).alias("n"))


PRESENCE_SQL = """WITH i AS (SELECT p_partkey, p_brand, unnest([p_type, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)]) AS item FROM part),
 top AS (SELECT item FROM i GROUP BY item ORDER BY count(*) DESC, item LIMIT 15),
 f AS (SELECT p_brand, min(p_partkey) AS k FROM part GROUP BY 1)"""


def _parts(spark, folder):
    name = F.split("p_name", " ")
    return table(spark, folder, "part").select(
        "p_partkey", "p_brand", "p_type", name[0].alias("first_word"), F.get(name, 1).alias("second_word")
    )


PART_LISTS = {"Top": "p_type", "Middle": "first_word", "Base": "second_word"}


@query(
    "presence_matrix",
    PRESENCE_SQL + """ SELECT top.item, f.p_brand, (EXISTS (SELECT 1 FROM i WHERE i.p_partkey = f.k AND i.item = top.item))::INT AS present
    FROM top, f""",
)
def presence_matrix(spark, folder):
    return profile.presence_matrix(_parts(spark, folder), "p_brand", "p_partkey", PART_LISTS, 15)


@query(
    "items_per_group",
    PRESENCE_SQL + " SELECT f.p_brand, count(*) FILTER (WHERE i.item <> '')::INT AS n_items FROM f JOIN i ON i.p_partkey = f.k GROUP BY 1",
)
def items_per_group(spark, folder):
    return profile.items_per_group(_parts(spark, folder), "p_brand", "p_partkey", PART_LISTS)


@query(
    "first_row_per_group",
    """SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey""",
)
def first_row_per_group(spark, folder):
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    return profile.first_row_per_group(rows, "o_custkey", "o_orderkey")


@query(
    "categorical_report",
    """WITH u AS (UNPIVOT (SELECT o_orderstatus, o_orderpriority FROM orders) ON o_orderstatus, o_orderpriority INTO NAME "column" VALUE value),
    c AS (SELECT "column", value, count(*) AS n FROM u GROUP BY 1, 2)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value)::INT AS place FROM c) WHERE place <= 3""",
)
def categorical_report(spark, folder):
    return profile.categorical_report(table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"], 3)


@query(
    "frequent_words",
    """SELECT item, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS item FROM documents)
    GROUP BY item ORDER BY n DESC, item LIMIT 20""",
)
def frequent_words(spark, folder):
    return profile.frequent_words(table(spark, folder, "documents"), "text", 20)


@query(
    "length_bands",
    f"""WITH {REVIEWS_SQL} SELECT CASE WHEN length(text) < 100 THEN '<100' WHEN length(text) < 1000 THEN '100-999' ELSE '>=1000' END AS length_band,
    count(*) AS n, round(avg(quality), 6) AS mean_value FROM rev GROUP BY 1""",
)
def length_bands(spark, folder):
    rows = profile.length_bands(reviews(spark, folder), "text", "quality", [100, 1000])
    return rows.withColumn("mean_value", near("mean_value"))


@query(
    "value_bands",
    """SELECT band, count(*) AS n FROM (SELECT CASE WHEN value < 10.0 THEN 'low' WHEN value < 50.0 THEN 'middle' ELSE 'high' END AS band FROM events)
    GROUP BY band""",
)
def value_bands(spark, folder):
    band = scalars.value_band("value", [10.0, 50.0], ["low", "middle", "high"])
    return table(spark, folder, "events").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


def _gappy(spark, folder):
    """Events whose value is NaN in every tenth row; the SQL side has NULL there."""
    gap = F.col("event_id") % 10 == 0
    return table(spark, folder, "events").select(
        "event_id", "event_type", F.when(gap, F.lit(float("nan"))).otherwise(F.col("value")).alias("value")
    )


_GAPPY_SQL = """e AS (SELECT event_id, event_type, CASE WHEN event_id % 10 <> 0 THEN value END AS value FROM events),
 q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3, avg(value) AS m, stddev_pop(value) AS s FROM e)"""


@query(
    "nan_quantiles",
    f"""WITH {_GAPPY_SQL} SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
    round(quantile_cont(value, 0.75), 6) AS q3 FROM e GROUP BY event_type""",
)
def nan_quantiles(spark, folder):
    found = exact_quantiles(_gappy(spark, folder), "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["event_type"])
    return found.select("event_type", *[near(c).alias(c) for c in ("q1", "median", "q3")])


@query(
    "nan_outliers",
    f"""WITH {_GAPPY_SQL} SELECT event_id, coalesce(value < q1 - (q3 - q1) * 0.2 OR value > q3 + (q3 - q1) * 0.2, false) AS by_iqr,
    coalesce(value < m - s OR value > m + s, false) AS by_zscore FROM e, q""",
)
def nan_outliers(spark, folder):
    marked = cleaning.flag_outliers(_gappy(spark, folder), "value", "iqr", 0.2, "by_iqr")
    return cleaning.flag_outliers(marked, "value", "zscore", 1.0, "by_zscore").select("event_id", "by_iqr", "by_zscore")


@query(
    "nan_clip",
    f"""WITH {_GAPPY_SQL} SELECT event_id, round(CASE WHEN value IS NOT NULL THEN greatest(least(value, q3 + (q3 - q1) * 0.2), q1 - (q3 - q1) * 0.2) END, 6) AS by_iqr,
    round(CASE WHEN value IS NOT NULL THEN greatest(least(value, m + s), m - s) END, 6) AS by_zscore FROM e, q""",
)
def nan_clip(spark, folder):
    rows = _gappy(spark, folder)
    fences = cleaning.clip_outliers(rows, ["value"], "iqr", 0.2).select("event_id", near("value").alias("by_iqr"))
    spread = cleaning.clip_outliers(rows, ["value"], "zscore", 1.0).select("event_id", near("value").alias("by_zscore"))
    return fences.join(spread, "event_id")


@query(
    "nan_histogram",
    f"""WITH {_GAPPY_SQL}, r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20.0 AS w FROM e)
    SELECT g.bin::INT AS bin, (SELECT count(*) FROM e, r WHERE value IS NOT NULL AND least(floor((value - lo) / w), 19) = g.bin) AS n FROM range(20) g(bin)""",
)
def nan_histogram(spark, folder):
    return profile.histogram(_gappy(spark, folder), "value", 20).select("bin", "n")


@query(
    "nan_profile",
    f"""WITH {_GAPPY_SQL} SELECT 'value' AS "column", count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
    min(value) AS min, max(value) AS max FROM e""",
)
def nan_profile(spark, folder):
    found = profile.numeric_profile(_gappy(spark, folder), ["value"])
    return found.withColumns({"mean": near("mean"), "std": near("std")})


@query(
    "full_duplicates_by_time",
    """WITH g AS (SELECT count(*) AS c FROM (SELECT event_type, TIMESTAMP '2024-01-01' + to_microseconds(event_id % 700) AS ts FROM events) GROUP BY event_type, ts)
    SELECT sum(c)::BIGINT AS n_rows, sum(c - 1)::BIGINT AS n_duplicates FROM g""",
)
def full_duplicates_by_time(spark, folder):
    """Times that differ by microseconds only are different."""
    shifted = F.timestamp_micros(F.lit(1704067200000000) + F.col("event_id") % 700)
    rows = table(spark, folder, "events").select("event_type", shifted.alias("ts"))
    return profile.full_duplicates(rows).select("n_rows", "n_duplicates")


@query(
    "missing_at_random",
    f"""WITH {REVIEWS_SQL}, m AS (SELECT avg(n_chars) AS mean, var_pop(n_chars) AS var FROM rev),
    g AS (SELECT count(*) AS n, avg(n_chars) AS mean FROM rev GROUP BY quality IS NULL),
    s AS (SELECT count(*)::INT AS n_patterns, sum(g.n * (g.mean - m.mean) ** 2 / m.var) AS statistic FROM g, m)
    SELECT n_patterns, round(statistic, 4) AS statistic, 1 AS degrees, statistic <= 3.841458820694124 AS at_random FROM s""",
)
def missing_at_random(spark, folder):
    """Documents with and without labels: where whole rows of figures are missing, only the others' means are compared."""
    found = missingness.missing_at_random(reviews(spark, folder), ["n_chars", "quality", "toxic"])
    return found.select("n_patterns", near("statistic", 4).alias("statistic"), "degrees", "at_random")


_WIDE = 300
_WIDE_SQL = ", ".join(
    f"CASE WHEN (l_orderkey + {i}) % 11 <> 0 THEN ((l_partkey * {i + 1} + l_linenumber) % 101)::DOUBLE END AS c{i}" for i in range(_WIDE)
)


@query(
    "wide_correlation",
    f"""WITH w AS (SELECT {_WIDE_SQL} FROM lineitem), r AS (SELECT {", ".join(f"round(corr(c{i}, c{i + 1}), 6) AS r{i}" for i in range(_WIDE - 1))} FROM w)
    SELECT unnest([{", ".join(f"'c{i}'" for i in range(_WIDE - 1))}]) AS x, unnest([{", ".join(f"'c{i + 1}'" for i in range(_WIDE - 1))}]) AS y,
    unnest([{", ".join(f"r{i}" for i in range(_WIDE - 1))}]) AS r FROM r""",
)
def wide_correlation(spark, folder):
    """Three hundred columns with gaps; all pairs are computed, neighbours are shown."""
    columns = [
        F.when((F.col("l_orderkey") + i) % 11 != 0, ((F.col("l_partkey") * (i + 1) + F.col("l_linenumber")) % 101).cast("double")).alias(f"c{i}")
        for i in range(_WIDE)
    ]
    found = profile.correlation_matrix(table(spark, folder, "lineitem").select(*columns), [f"c{i}" for i in range(_WIDE)])
    return found.where(F.substring("y", 2, 9).cast("int") == F.substring("x", 2, 9).cast("int") + 1).withColumn("r", near("r"))


@query(
    "seasonal_parts",
    """WITH o AS (SELECT o_orderstatus, date_trunc('month', o_orderdate)::DATE AS m, o_totalprice FROM orders
      WHERE (year(o_orderdate) * 12 + month(o_orderdate)) % 5 <> 0),
    t AS (SELECT o_orderstatus, m, sum(o_totalprice) AS total FROM o GROUP BY 1, 2),
    c AS (SELECT o_orderstatus, unnest(generate_series(min(m)::TIMESTAMP, max(m)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS m FROM t GROUP BY 1),
    f AS (SELECT c.o_orderstatus, c.m, coalesce(t.total, 0) AS total FROM c LEFT JOIN t ON c.o_orderstatus = t.o_orderstatus AND c.m = t.m),
    s AS (SELECT *, (sum(total) OVER (PARTITION BY o_orderstatus ORDER BY m ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
      + (lag(total, 6) OVER (PARTITION BY o_orderstatus ORDER BY m) + lead(total, 6) OVER (PARTITION BY o_orderstatus ORDER BY m)) / 2) / 12 AS trend FROM f),
    i AS (SELECT o_orderstatus, month(m) AS of, avg(total - trend) AS raw FROM s GROUP BY 1, 2),
    j AS (SELECT o_orderstatus, avg(raw) AS middle FROM i GROUP BY 1)
    SELECT s.o_orderstatus, s.m AS month, round(total, 2) AS total, round(trend, 2) AS trend, round(raw - middle, 2) AS season,
    round(total - trend - (raw - middle), 2) AS rest FROM s JOIN i ON s.o_orderstatus = i.o_orderstatus AND month(s.m) = i.of JOIN j ON j.o_orderstatus = s.o_orderstatus""",
)
def seasonal_parts(spark, folder):
    """Order values by status and month, with every fifth month empty."""
    orders = table(spark, folder, "orders").where((F.year("o_orderdate") * 12 + F.month("o_orderdate")) % 5 != 0)
    found = profile.seasonal_parts(orders, "o_orderdate", ["o_orderstatus"], "o_totalprice")
    return found.withColumns({c: near(c, 2) for c in ("total", "trend", "season", "rest")})


@query(
    "stored_sketches",
    """SELECT o_orderstatus, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers, TRUE AS count_holds, TRUE AS quantiles_hold
    FROM orders GROUP BY o_orderstatus""",
)
def stored_sketches(spark, folder):
    """Sketches per status and year, stored, then merged per status and held against exact figures and their stated errors."""
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    stored = cut_lineage(sketches.sketch_parts(orders, ["o_orderstatus", "year"], ["o_custkey"], ["o_totalprice"]))
    shares = [0.1, 0.5, 0.9]
    merged = sketches.merged(stored, ["o_orderstatus"], ["o_custkey"], ["o_totalprice"], shares)
    exact = orders.groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("n_customers"))
    held = merged.join(exact, "o_orderstatus")
    below = [
        F.sum((F.col("o_totalprice") <= F.get("q_o_totalprice", i)).cast("bigint")) / F.count(F.lit(1)) for i in range(len(shares))
    ]
    ranks = orders.join(held.select("o_orderstatus", "q_o_totalprice"), "o_orderstatus").groupBy("o_orderstatus").agg(
        F.array(*below).alias("ranks")
    )
    near_ranks = F.lit(True)
    for i, share in enumerate(shares):
        near_ranks = near_ranks & (F.abs(F.get("ranks", i) - share) <= sketches.RANK_ERROR)
    return held.join(ranks, "o_orderstatus").select(
        "o_orderstatus", "n_rows", "n_customers",
        (F.abs(F.col("n_o_custkey") - F.col("n_customers")) <= sketches.DISTINCT_ERROR * F.col("n_customers")).alias("count_holds"),
        near_ranks.alias("quantiles_hold"),
    )


@query(
    "preview_rows",
    """SELECT doc_id, substr(text, 1, 200) AS preview, date_trunc('month', o_orderdate)::DATE AS month
    FROM documents JOIN orders ON doc_id = o_orderkey""",
)
def preview_rows(spark, folder):
    docs = table(spark, folder, "documents").join(table(spark, folder, "orders"), F.col("doc_id") == F.col("o_orderkey"))
    return docs.select("doc_id", tx.preview("text").alias("preview"), scalars.month_of("o_orderdate").alias("month"))


@query(
    "length_summary",
    """WITH l AS (SELECT length(text) AS len FROM documents WHERE text IS NOT NULL), e AS (SELECT min(len) AS lo, (max(len) - min(len)) / 40.0 AS w FROM l)
    SELECT g.bin::INT AS bin, (SELECT count(*) FROM l WHERE least(floor((len - lo) / w), 39) = g.bin) AS n FROM e, range(40) g(bin)""",
)
def length_summary(spark, folder):
    return compare.length_summary(table(spark, folder, "documents"), "text").select("bin", "n")
