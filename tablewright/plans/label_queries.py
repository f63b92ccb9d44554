"""Label maps, annotators, agreement, confidence and review samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import labels as fl
from tablewright.functions import scalars, text as tx
from tablewright.operators import agreement as ag
from tablewright.operators import labeling as lb
from tablewright.plans.registry import SCORED_SQL, labeled, near, query, scored_documents, table

S = f"WITH {SCORED_SQL} "
LABELS = ["liked", "mixed", "not_liked"]

# English word lists standing in for the default ones on this corpus
PLUS = ["the and", "with", "that", "tion", "est la"]
MINUS = ["of the", "und", "shth", "%%%", "not "]
_HITS = " + ".join("(contains(lower(text), '{0}'))::INT".format(w) for w in PLUS)
_MISSES = " + ".join("(contains(lower(text), '{0}'))::INT".format(w) for w in MINUS)
KEYWORD_SQL = (
    f"kw AS (SELECT doc_id, {_HITS} AS plus, {_MISSES} AS minus FROM documents), "
    "kl AS (SELECT doc_id, CASE WHEN plus > minus THEN 'liked' WHEN minus > plus THEN 'not_liked' ELSE 'mixed' END AS label FROM kw)"
)


@query("keyword_label", f"WITH {KEYWORD_SQL} SELECT doc_id, label FROM kl")
def keyword_label(spark, folder):
    return table(spark, folder, "documents").select("doc_id", lb.keyword_label("text", PLUS, MINUS).alias("label"))


@query(
    "keyword_hits",
    f"WITH {KEYWORD_SQL} SELECT plus, minus, count(*) AS n FROM kw GROUP BY plus, minus",
)
def keyword_hits(spark, folder):
    rows = table(spark, folder, "documents").select(
        tx.keyword_hits("text", PLUS).alias("plus"), tx.keyword_hits("text", MINUS).alias("minus")
    )
    return rows.groupBy("plus", "minus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rule_label",
    """WITH s AS (SELECT doc_id, (regexp_matches(lower(text), 'tion[ .,]'))::INT + (regexp_matches(lower(text), '^the'))::INT AS a,
      (regexp_matches(lower(text), '[0-9]{3}'))::INT + (regexp_matches(lower(text), 'un[dt]'))::INT AS b FROM documents)
    SELECT doc_id, CASE WHEN a > b THEN 'x' WHEN b > a THEN 'y' ELSE 'none' END AS label FROM s""",
)
def rule_label(spark, folder):
    rules = [("x", r"tion[ .,]"), ("x", "^the"), ("y", "[0-9]{3}"), ("y", "un[dt]")]
    return table(spark, folder, "documents").select("doc_id", lb.rule_label("text", rules, "none").alias("label"))


@query(
    "label_maps",
    """WITH m AS (SELECT o_orderkey, CASE lower(CASE o_orderstatus WHEN 'O' THEN 'POSITIVE' WHEN 'F' THEN 'Negative' ELSE 'other' END)
      WHEN 'positive' THEN 'liked' WHEN 'neutral' THEN 'mixed' WHEN 'negative' THEN 'not_liked' ELSE 'mixed' END AS label FROM orders)
    SELECT label, CASE label WHEN 'liked' THEN 'positive' WHEN 'mixed' THEN 'neutral' ELSE 'negative' END AS sentiment,
    CASE WHEN label = 'liked' THEN 'liked' ELSE 'not_liked' END AS label_binary, count(*) AS n FROM m GROUP BY 1, 2, 3""",
)
def label_maps(spark, folder):
    status = F.col("o_orderstatus")
    raw = F.when(status == "O", "POSITIVE").when(status == "F", "Negative").otherwise("other")
    rows = table(spark, folder, "orders").select(fl.sentiment_to_label(raw).alias("label"))
    return rows.groupBy(
        "label", fl.label_to_sentiment("label").alias("sentiment"), fl.merge_to_binary("label").alias("label_binary")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("label_distribution", "SELECT quality, count(*) AS count, count(*)::DOUBLE / (SELECT count(*) FROM labels WHERE quality IS NOT NULL)::DOUBLE * 100.0 AS pct FROM labels WHERE quality IS NOT NULL GROUP BY quality")
def label_distribution(spark, folder):
    return lb.label_distribution(table(spark, folder, "labels"), "quality")


@query(
    "quality_summary",
    S + """SELECT count(*) AS total, count(label) AS labeled, round(avg(confidence), 4) AS mean_confidence,
    count(*) FILTER (WHERE confidence < 0.5) AS uncertain_count,
    round(count(*) FILTER (WHERE confidence < 0.5)::DOUBLE / count(*)::DOUBLE * 100.0, 1)::DOUBLE AS uncertain_pct, 3 AS n_labels FROM scored""",
)
def quality_summary(spark, folder):
    return lb.quality_summary(scored_documents(spark, folder)).withColumn(
        "n_labels", F.size("distribution")
    ).drop("distribution")


@query(
    "distribution_checks",
    S + """, d AS (SELECT label, count(*) AS count, count(*)::DOUBLE / (SELECT count(*) FROM scored)::DOUBLE * 100.0 AS pct FROM scored GROUP BY label)
    SELECT *, pct < 30.0 AS rare, pct - CASE label WHEN 'liked' THEN 50.0 WHEN 'mixed' THEN 30.0 ELSE 0.0 END AS difference FROM d""",
)
def distribution_checks(spark, folder):
    return lb.distribution_checks(scored_documents(spark, folder), "label", {"liked": 50.0, "mixed": 30.0}, 30.0)


@query(
    "distribution_entropy",
    S + """, d AS (SELECT count(*)::DOUBLE / (SELECT count(*) FROM scored) AS p FROM scored GROUP BY label)
    SELECT round(sum(-p * ln(p)), 6) AS entropy, count(*) AS n_labels, round(sum(-p * ln(p)) / ln(count(*)), 6) AS evenness FROM d""",
)
def distribution_entropy(spark, folder):
    rows = lb.distribution_entropy(scored_documents(spark, folder), "label")
    return rows.withColumns({"entropy": near("entropy"), "evenness": near("evenness")})


@query(
    "confidence_stats",
    S + """SELECT label, count(*) AS n, round(avg(confidence), 6) AS mean, round(stddev_samp(confidence), 6) AS std,
    count(*) FILTER (WHERE confidence < 0.5)::DOUBLE / count(*)::DOUBLE * 100.0 AS pct_low,
    count(*) FILTER (WHERE confidence > 0.9)::DOUBLE / count(*)::DOUBLE * 100.0 AS pct_high,
    round(quantile_cont(confidence, 0.5), 6) AS median FROM scored GROUP BY label""",
)
def confidence_stats(spark, folder):
    rows = lb.confidence_stats(scored_documents(spark, folder))
    return rows.withColumns({c: near(c) for c in ("mean", "std", "median")})


@query(
    "confidence_subsets",
    S + """SELECT 'uncertain' AS mode, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM scored WHERE confidence < 0.5
    UNION ALL SELECT 'confident', count(*), sum(doc_id)::BIGINT FROM scored WHERE confidence > 0.9
    UNION ALL SELECT 'all', count(*), sum(doc_id)::BIGINT FROM scored
    UNION ALL SELECT 'border', count(*), sum(doc_id)::BIGINT FROM scored WHERE confidence BETWEEN 0.3 AND 0.6""",
)
def confidence_subsets(spark, folder):
    rows = scored_documents(spark, folder)
    sets = {m: lb.export_subset(rows, m) for m in ("uncertain", "confident", "all")}
    sets["border"] = lb.border_rows(rows)
    parts = [
        df.agg(F.lit(m).alias("mode"), F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))
        for m, df in sets.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "confidence_status",
    S + "SELECT CASE WHEN confidence < 0.5 THEN 'uncertain' ELSE 'certain' END AS status, count(*) AS n FROM scored GROUP BY 1",
)
def confidence_status(spark, folder):
    rows = lb.with_label_record(scored_documents(spark, folder), "keywords")
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


TOP_SQL = S + """, t AS (SELECT doc_id, label, confidence, row_number() OVER (PARTITION BY label ORDER BY confidence DESC, doc_id)::INT AS place FROM scored)"""


@query("top_confident", TOP_SQL + " SELECT * FROM t WHERE place <= 2")
def top_confident(spark, folder):
    return lb.top_confident(scored_documents(spark, folder), "doc_id", 2).select("doc_id", "label", "confidence", "place")


@query("least_confident", S + "SELECT doc_id, confidence FROM scored ORDER BY confidence, doc_id LIMIT 10")
def least_confident(spark, folder):
    return lb.least_confident(scored_documents(spark, folder), "doc_id", 10).select("doc_id", "confidence")


EXAMPLES_SQL = TOP_SQL + """, ex AS (SELECT doc_id, label, 'example' AS kind FROM t WHERE place <= 3
  UNION ALL (SELECT doc_id, label, 'border' FROM scored ORDER BY confidence, doc_id LIMIT 5))"""


@query("guideline_examples", EXAMPLES_SQL + " SELECT * FROM ex")
def guideline_examples(spark, folder):
    return lb.guideline_examples(scored_documents(spark, folder), "doc_id").select("doc_id", "label", "kind")


@query(
    "guideline_summary",
    EXAMPLES_SQL + """ SELECT label, count(*) FILTER (WHERE kind = 'example') AS n_examples, count(*) FILTER (WHERE kind = 'border') AS n_border
    FROM ex GROUP BY label""",
)
def guideline_summary(spark, folder):
    examples = lb.guideline_examples(scored_documents(spark, folder), "doc_id")
    return lb.guideline_summary(examples).drop("created")


@query(
    "ambiguous_rows",
    S + """SELECT doc_id, round(abs(2 * confidence - 1), 6) AS margin FROM scored WHERE round(abs(2 * confidence - 1), 9) < 0.1""",
)
def ambiguous_rows(spark, folder):
    p = F.col("confidence")
    rows = scored_documents(spark, folder).withColumn("p", F.array(p, F.round(F.lit(1.0) - p, 9)))
    return lb.ambiguous_rows(rows, "p", 0.1).select("doc_id", near("margin").alias("margin"))


@query(
    "probability_scores",
    S + """SELECT doc_id, round(CASE WHEN confidence IN (0, 1) THEN 0 ELSE -confidence * ln(confidence) - (1 - confidence) * ln(1 - confidence) END, 6) AS entropy,
    round(abs(2 * confidence - 1), 6) AS margin FROM scored""",
)
def probability_scores(spark, folder):
    p = F.col("confidence")
    rows = scored_documents(spark, folder).select("doc_id", F.array(p, F.lit(1.0) - p).alias("p"))
    return rows.select("doc_id", near(scalars.entropy("p")).alias("entropy"), near(scalars.margin("p")).alias("margin"))


@query(
    "review_sample",
    S + """, e AS (SELECT label, 50.0::DOUBLE * count(*) / (SELECT count(*) FROM scored) AS x FROM scored GROUP BY label),
    r AS (SELECT label, floor(x)::BIGINT AS f, row_number() OVER (ORDER BY x - floor(x) DESC, label) AS place FROM e)
    SELECT label, f + (place <= 50 - (SELECT sum(f) FROM r))::BIGINT AS expected, true AS has_lowest, true AS each_once FROM r""",
)
def review_sample(spark, folder):
    """Sizes are checked against the quotas; which rows are drawn depends on the hash."""
    rows = scored_documents(spark, folder)
    sample = lb.review_sample(rows, "doc_id", "label", "second", "confidence", size=50, low=0, per_pair=0)
    whole = lb.review_sample(rows, "doc_id", "label", "second", "confidence").select("doc_id")
    lowest = lb.least_confident(rows, "doc_id", 10).select("doc_id")
    covered = lowest.join(whole, "doc_id", "left_anti").agg(F.count(F.lit(1)) == 0).scalar()
    once = whole.agg(F.count("doc_id") == F.count_distinct("doc_id")).scalar()
    return sample.groupBy("label").agg(F.count(F.lit(1)).alias("expected")).select(
        "label", "expected", covered.alias("has_lowest"), once.alias("each_once")
    )


PAIR = "FROM scored GROUP BY label, second"


@query(
    "confusion_matrix",
    S + """SELECT a.l AS a, b.l AS b, (SELECT count(*) FROM scored WHERE label = a.l AND second = b.l) AS n
    FROM (VALUES ('liked'), ('mixed'), ('not_liked'), ('other')) a(l), (VALUES ('liked'), ('mixed'), ('not_liked'), ('other')) b(l)""",
)
def confusion_matrix(spark, folder):
    return ag.confusion_matrix(scored_documents(spark, folder), "label", "second", [*LABELS, "other"])


@query(
    "confusion_matrix_wide",
    S + """SELECT label AS a, count(*) FILTER (WHERE second = 'liked') AS liked, count(*) FILTER (WHERE second = 'mixed') AS mixed,
    count(*) FILTER (WHERE second = 'not_liked') AS not_liked FROM scored GROUP BY label""",
)
def confusion_matrix_wide(spark, folder):
    return ag.confusion_matrix(scored_documents(spark, folder), "label", "second", LABELS, wide=True)


_KAPPA_SQL = """, g AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE {a} = {b})::DOUBLE AS o FROM {t}),
 e AS (SELECT sum(x.c * y.c)::DOUBLE AS e FROM (SELECT {a} AS l, count(*)::DOUBLE AS c FROM {t} GROUP BY 1) x
   JOIN (SELECT {b} AS l, count(*)::DOUBLE AS c FROM {t} GROUP BY 1) y ON x.l = y.l),
 k AS (SELECT n::BIGINT AS n, o::BIGINT AS agreed, (n - o)::BIGINT AS disagreed, o / n * 100.0 AS agreement_pct,
   1.0 - (n - o) / (n - e / n) AS kappa FROM g, e)
 SELECT *, CASE WHEN kappa < 0 THEN 'Poor (worse than chance)' WHEN kappa < 0.2 THEN 'Slight' WHEN kappa < 0.4 THEN 'Fair'
   WHEN kappa < 0.6 THEN 'Moderate' WHEN kappa < 0.8 THEN 'Substantial' ELSE 'Almost perfect' END AS band {more} FROM k"""


@query("agreement", S + _KAPPA_SQL.format(a="label", b="second", t="scored", more=""))
def agreement(spark, folder):
    return ag.agreement(scored_documents(spark, folder), "label", "second")


@query(
    "binary_agreement",
    S + ", bin AS (SELECT CASE WHEN label = 'liked' THEN 1 ELSE 0 END AS p, CASE WHEN second = 'liked' THEN 1 ELSE 0 END AS q FROM scored)"
    + _KAPPA_SQL.format(a="p", b="q", t="bin", more=""),
)
def binary_agreement(spark, folder):
    return ag.binary_agreement(scored_documents(spark, folder), "label", "second", "liked")


@query(
    "keyword_agreement_gate",
    f"WITH {KEYWORD_SQL}, x AS (SELECT CASE quality WHEN 1 THEN 'liked' ELSE 'not_liked' END AS label, kl.label AS kw FROM labels JOIN kl ON labels.doc_id = kl.doc_id)"
    + _KAPPA_SQL.format(a="label", b="kw", t="x", more=", kappa >= 0.6 AS fit"),
)
def keyword_agreement_gate(spark, folder):
    rows = labeled(spark, folder).select(
        F.when(F.col("quality") == 1, "liked").otherwise("not_liked").alias("label"),
        lb.keyword_label("text", PLUS, MINUS).alias("kw"),
    )
    return ag.fit_for_training(ag.agreement(rows, "label", "kw"))


@query(
    "labeling_report",
    S + """, k AS (SELECT count(*) AS n, (count(*) FILTER (WHERE label = second))::DOUBLE AS g FROM scored),
    e AS (SELECT sum(a.c * b.c)::DOUBLE AS c FROM (SELECT label, count(*) AS c FROM scored GROUP BY 1) a JOIN (SELECT second, count(*) AS c FROM scored GROUP BY 1) b ON a.label = b.second),
    x AS (SELECT n, 1.0 - (n - g) / (n - c / n) AS kappa, g / n * 100.0 AS pct FROM k, e),
    d AS (SELECT label || '>' || second AS worst, count(*) AS n FROM scored WHERE label <> second GROUP BY label, second ORDER BY n DESC, label, second LIMIT 1)
    SELECT 'both' AS form, n AS total, round(kappa, 9) AS kappa, round(pct, 9) AS pct, kappa >= 0.6 AS fit, (SELECT worst FROM d) AS worst, 3 AS n_labels,
      (SELECT count(*) FILTER (WHERE confidence < 0.5) FROM scored) AS uncertain FROM x
    UNION ALL SELECT 'confidence', n, NULL, NULL, (SELECT avg(confidence) FROM scored) >= 0.6, NULL, 3,
      (SELECT count(*) FILTER (WHERE confidence < 0.5) FROM scored) FROM x""",
)
def labeling_report(spark, folder):
    """The whole report with a reference labeling, and its form from confidence alone."""
    rows = scored_documents(spark, folder)
    worst = F.get("disagreements", 0)
    both = ag.labeling_report(rows, second="second").select(
        F.lit("both").alias("form"), F.col("summary.total").alias("total"), near("agreement.kappa", 9).alias("kappa"),
        near("agreement.agreement_pct", 9).alias("pct"), "fit", F.concat_ws(">", worst["a"], worst["b"]).alias("worst"),
        F.size("summary.distribution").alias("n_labels"), F.col("summary.uncertain_count").alias("uncertain"),
    )
    alone = ag.labeling_report(rows).select(
        F.lit("confidence").alias("form"), F.col("summary.total").alias("total"), F.col("agreement.kappa").alias("kappa"),
        F.lit(None).cast("double").alias("pct"), "fit", F.get("disagreements", 0)["a"].alias("worst"),
        F.size("summary.distribution").alias("n_labels"), F.col("summary.uncertain_count").alias("uncertain"),
    )
    return both.unionByName(alone)


@query(
    "confusion_pairs",
    S + f"SELECT label AS a, second AS b, count(*) AS n {PAIR} HAVING label <> second ORDER BY n DESC, a, b LIMIT 10",
)
def confusion_pairs(spark, folder):
    return ag.confusion_pairs(scored_documents(spark, folder), "label", "second")


@query("disagreements", S + "SELECT doc_id, label, second FROM scored WHERE label <> second")
def disagreements(spark, folder):
    return ag.disagreements(scored_documents(spark, folder), "label", "second").select("doc_id", "label", "second")


_REPORT_SQL = S + """, t AS (SELECT l AS label, (SELECT count(*) FROM scored WHERE label = l AND second = l)::DOUBLE AS tp,
  (SELECT count(*) FROM scored WHERE second = l)::DOUBLE AS pr, (SELECT count(*) FROM scored WHERE label = l)::DOUBLE AS su
  FROM (VALUES ('liked'), ('mixed'), ('not_liked')) v(l)),
 r AS (SELECT label, tp / pr AS precision, tp / su AS recall, tp * 2.0 / (pr + su) AS f1, su AS support, tp FROM t) """


@query("class_report", _REPORT_SQL + "SELECT label, precision, recall, f1, support::BIGINT AS support FROM r")
def class_report(spark, folder):
    return ag.class_report(scored_documents(spark, folder), "label", "second").drop("n_both")


@query(
    "report_summary",
    _REPORT_SQL + """SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
    round(avg(f1), 6) AS f1_macro, round(sum(precision * support) / sum(support), 6) AS precision_weighted,
    round(sum(recall * support) / sum(support), 6) AS recall_weighted, round(sum(f1 * support) / sum(support), 6) AS f1_weighted,
    sum(support)::BIGINT AS support FROM r""",
)
def report_summary(spark, folder):
    rows = ag.report_summary(ag.class_report(scored_documents(spark, folder), "label", "second"))
    return rows.select("support", *[near(c).alias(c) for c in rows.columns if c != "support"])


@query("evaluate", _REPORT_SQL + "SELECT round(sum(tp) / sum(support), 4) AS accuracy, round(avg(f1), 4) AS f1 FROM r")
def evaluate(spark, folder):
    return ag.evaluate(scored_documents(spark, folder), "label", "second")


@query(
    "label_shares_side_by_side",
    S + """SELECT l AS label, (SELECT count(*) FROM scored WHERE label = l) AS n_first, (SELECT count(*) FROM scored WHERE second = l) AS n_second
    FROM (VALUES ('liked'), ('mixed'), ('not_liked')) v(l)""",
)
def label_shares_side_by_side(spark, folder):
    return ag.label_shares_side_by_side(scored_documents(spark, folder), "label", "second")


@query(
    "inspect_paths",
    """WITH p AS (SELECT 'x/' || page_id || CASE page_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.FLAC' WHEN 2 THEN '.webp' ELSE '.bin' END AS path FROM pages)
    SELECT CASE WHEN path LIKE '%.csv' THEN 'text' WHEN path LIKE '%.FLAC' THEN 'audio' WHEN path LIKE '%.webp' THEN 'image' ELSE 'unknown' END AS modality,
    count(*) AS n FROM p GROUP BY 1""",
)
def inspect_paths(spark, folder):
    kind = F.element_at(F.array(*[F.lit(x) for x in (".csv", ".FLAC", ".webp", ".bin")]), (F.col("page_id") % 4 + 1).cast("int"))
    rows = table(spark, folder, "pages").select(F.concat(F.lit("x/"), F.col("page_id"), kind).alias("path"))
    return lb.inspect_paths(rows, "path")


@query(
    "pilot_rows",
    "SELECT least(100, count(*)) AS n_pilot, least(100, count(DISTINCT doc_id)) AS n_ids, least(100, count(doc_id)) AS n_known, count(*) AS n_all FROM documents",
)
def pilot_rows(spark, folder):
    """A pilot has different rows of the table, the same ones on each run, and its size alone decides how many."""
    docs = table(spark, folder, "documents")
    pilot = lb.pilot_rows(docs, "doc_id", 100)
    again = lb.pilot_rows(docs.orderBy(F.desc("doc_id")), "doc_id", 100).select("doc_id")
    n_all = docs.agg(F.count(F.lit(1))).scalar()
    both = pilot.join(again.withColumn("_known", F.lit(True)), "doc_id", "left")
    return both.agg(
        F.count(F.lit(1)).alias("n_pilot"), F.count_distinct("doc_id").alias("n_ids"), F.count("_known").alias("n_known")
    ).withColumn("n_all", n_all)



def length_classifier():
    """A stand-in model: the label follows the text length."""
    def run(texts):
        found = []
        for t in texts:
            n = len(t)
            name = "POSITIVE" if n % 7 < 3 else "neutral" if n % 7 < 5 else "Negative"
            found.append({"label": name, "score": (n % 1000) / 1000.0})
        return found

    return run


@query(
    "auto_label",
    """SELECT doc_id, CASE WHEN length(text) % 7 < 3 THEN 'positive' WHEN length(text) % 7 < 5 THEN 'neutral' ELSE 'negative' END AS sentiment_raw,
    CASE WHEN length(text) % 7 < 3 THEN 'liked' WHEN length(text) % 7 < 5 THEN 'mixed' ELSE 'not_liked' END AS label,
    ((length(text) % 1000) / 1000.0)::DOUBLE AS confidence FROM documents""",
)
def auto_label(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lb.auto_label(docs, length_classifier, "text").drop("text")
