"""Annotation tasks and their validation."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tablewright.operators import tasks
from tablewright.plans.registry import SCORED_SQL, query, scored_documents, table
from tablewright.session import scratch_path

S = f"WITH {SCORED_SQL} "


def _part_rows(spark, folder):
    """Text tasks of all documents, flattened to compare their fields."""
    docs = scored_documents(spark, folder).withColumn("brand", F.col("source"))
    return tasks.text_tasks(docs, "doc_id", "text")


@query(
    "text_tasks",
    S + """SELECT row_number() OVER (ORDER BY doc_id) AS id, md5(text) AS text_hash, source AS brand, '' AS rating, label AS choice,
    confidence AS score, 'rubert-tiny2-sentiment-v1' AS model_version, 'label|text|choices' AS names FROM scored""",
)
def text_tasks(spark, folder):
    first = F.col("predictions")[0]
    result = first["result"][0]
    return _part_rows(spark, folder).select(
        "id", F.md5("data.text").alias("text_hash"), F.col("data.brand").alias("brand"), F.col("data.rating").alias("rating"),
        result["value"]["choices"][0].alias("choice"), first["score"].alias("score"),
        first["model_version"].alias("model_version"),
        F.concat_ws("|", result["from_name"], result["to_name"], result["type"]).alias("names"),
    )


@query(
    "task_json",
    S + """SELECT row_number() OVER (ORDER BY doc_id) AS task_id, label AS choice, md5(text) AS text_hash, confidence AS score FROM scored""",
)
def task_json(spark, folder):
    rows = tasks.to_json_rows(_part_rows(spark, folder), "id")
    score = F.get_json_object("json", "$.predictions[0].score").cast("double")
    return rows.select(
        "task_id", F.get_json_object("json", "$.predictions[0].result[0].value.choices[0]").alias("choice"),
        F.md5(F.get_json_object("json", "$.data.text")).alias("text_hash"), score.alias("score"),
    )


@query(
    "span_tasks",
    S + """, w AS (SELECT doc_id, label, confidence, CASE WHEN strpos(text, ' ') = 0 THEN 0 ELSE doc_id % strpos(text, ' ') END AS first, text FROM scored)
    SELECT doc_id, first::INT AS start, length(text)::INT AS "end", substr(text, first + 1) AS span, label, confidence AS score FROM w""",
)
def span_tasks(spark, folder):
    """A span of every document, from somewhere in its first word to its end."""
    blank = F.instr("text", " ")
    start = F.when(blank == 0, F.lit(0)).otherwise(F.col("doc_id") % blank).cast("int")
    span = F.struct(start.alias("start"), F.length("text").alias("end"), F.col("label").alias("label"))
    docs = scored_documents(spark, folder).withColumn("spans", F.array(span))
    made = tasks.annotation_tasks(
        docs, "text", "ner", {"content": "text", "spans": "spans", "confidence": "confidence"}, keep=["doc_id"]
    )
    first = F.col("predictions")[0]
    value = first["result"][0]["value"]
    return made.select(
        "doc_id", value["start"].alias("start"), value["end"].alias("end"), value["text"].alias("span"),
        value["labels"][0].alias("label"), first["score"].alias("score"),
    )


@query(
    "box_tasks",
    """SELECT p_partkey, p_size * 100.0 / 640.0 AS x, p_size * 2 * 100.0 / 480.0 AS y, 64 * 100.0 / 640.0 AS width, (p_partkey % 480) * 100.0 / 480.0 AS height,
    p_brand AS label, 640 AS original_width FROM part""",
)
def box_tasks(spark, folder):
    box = F.struct(
        F.col("p_size").alias("x"), (F.col("p_size") * 2).alias("y"), F.lit(64).alias("width"),
        (F.col("p_partkey") % 480).alias("height"), F.lit(640).alias("image_width"), F.lit(480).alias("image_height"),
        F.col("p_brand").alias("label"),
    )
    parts = table(spark, folder, "part").select(
        "p_partkey", F.col("p_name").alias("image"), F.array(box).alias("boxes"), F.lit(0.5).alias("confidence")
    )
    made = tasks.annotation_tasks(
        parts, "image", "detection", {"content": "image", "boxes": "boxes", "confidence": "confidence"}, keep=["p_partkey"]
    )
    result = F.col("predictions")[0]["result"][0]
    value = result["value"]
    return made.select(
        "p_partkey", *[value[c].alias(c) for c in ("x", "y", "width", "height")],
        value["rectanglelabels"][0].alias("label"), result["original_width"].alias("original_width"),
    )


def _choices(spark, folder):
    docs = scored_documents(spark, folder)
    return tasks.annotation_tasks(
        docs, "text", "classification", {"content": "text", "label": "label", "confidence": "confidence"}, keep=["doc_id"]
    )


@query(
    "validate_sound_tasks",
    S + "SELECT label, count(*) AS n_tasks, 0::BIGINT AS n_errors FROM scored GROUP BY label",
)
def validate_sound_tasks(spark, folder):
    """Tasks of every label, and the rules that those of this label break."""
    rows = tasks.to_json_rows(_choices(spark, folder), "doc_id")
    broken = tasks.validate_tasks(rows, ["liked", "mixed", "not_liked"]).groupBy(F.col("task_id").alias("doc_id")).agg(
        F.count(F.lit(1)).alias("errors")
    )
    docs = scored_documents(spark, folder).select("doc_id", "label").join(broken, "doc_id", "left")
    return docs.groupBy("label").agg(F.count(F.lit(1)).alias("n_tasks"), F.coalesce(F.sum("errors"), F.lit(0)).alias("n_errors"))


@query(
    "task_batches",
    S + "SELECT label, count(*) AS n_tasks, count(DISTINCT doc_id) AS n_ids, true AS small, true AS in_order FROM scored GROUP BY label",
)
def task_batches(spark, folder):
    """Tasks written in id order, at most a hundred a file, and read back with their places."""
    path = scratch_path(spark, "tasks")
    made = _choices(spark, folder).select(F.col("doc_id").alias("id"), "data", "predictions")
    tasks.write_task_batches(made, path, "id", 100)
    label = F.col("predictions")[0]["result"][0]["value"]["choices"][0]
    back = spark.read.schema(made.schema).json(path).select(
        "id", label.alias("label"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line")
    )
    files = back.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    after = F.lag("hi").over(Window.orderBy("lo"))
    facts = files.withColumn("apart", F.coalesce(F.col("lo") > after, F.lit(True))).agg(
        F.struct((F.max("n") <= 100).alias("small"), F.bool_and("apart").alias("in_order")).alias("f")
    ).scalar()
    return back.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_tasks"), F.count_distinct("id").alias("n_ids")
    ).select("label", "n_tasks", "n_ids", facts["small"].alias("small"), facts["in_order"].alias("in_order"))


@query(
    "validate_tasks",
    S + """, d AS (SELECT doc_id, label, n_chars % 11 AS k, text FROM scored)
    SELECT doc_id AS task_id, 'invalid_json' AS rule FROM d WHERE k = 0
    UNION ALL SELECT doc_id, 'no_data' FROM d WHERE k = 1
    UNION ALL SELECT doc_id, 'result_not_array' FROM d WHERE k = 2
    UNION ALL SELECT doc_id, 'inconsistent_names' FROM d WHERE k = 3
    UNION ALL SELECT doc_id, 'span_text_differs' FROM d WHERE k = 4
    UNION ALL SELECT doc_id, 'box_outside_image' FROM d WHERE k = 5
    UNION ALL SELECT doc_id, 'unknown_label' FROM d WHERE k NOT IN (0, 2, 4, 5) AND label = 'mixed'""",
)
def validate_tasks(spark, folder):
    """Tasks of all documents, broken in a way that depends on the document."""
    rows = tasks.to_json_rows(_choices(spark, folder), "doc_id").join(
        table(spark, folder, "documents").select(F.col("doc_id").alias("task_id"), (F.col("n_chars") % 11).alias("k")), "task_id"
    )
    span = ('{"data":{"text":"abcdef"},"predictions":[{"result":[{"from_name":"label","to_name":"text","type":"labels",'
            '"value":{"start":1,"end":3,"text":"xx","labels":["liked"]}}],"score":0.5}]}')
    box = ('{"data":{"image":"a.jpg"},"predictions":[{"result":[{"from_name":"label","to_name":"text","type":"rectanglelabels",'
           '"value":{"x":90.0,"y":1.0,"width":20.0,"height":5.0,"rectanglelabels":["liked"]}}],"score":0.5}]}')
    k, j = F.col("k"), F.col("json")
    broken = (
        F.when(k == 0, F.concat(F.lit("{"), j))
        .when(k == 1, F.replace(j, F.lit('"data":'), F.lit('"date":')))
        .when(k == 2, F.lit('{"data":{"text":"a"},"predictions":[{"result":{"a":1},"score":0.5}]}'))
        .when(k == 3, F.replace(j, F.lit('"from_name":"label"'), F.lit('"from_name":"lable"')))
        .when(k == 4, F.lit(span))
        .when(k == 5, F.lit(box))
        .otherwise(j)
    )
    return tasks.validate_tasks(rows.select("task_id", broken.alias("json")), ["liked", "not_liked"])
