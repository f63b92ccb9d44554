"""Annotation tasks in the nested JSON layout of Label Studio."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.operators.ordered import number_rows

MODEL_VERSION = "rubert-tiny2-sentiment-v1"

# Extra fields of a text task.
CONTEXT_FIELDS = ["perfume_name", "brand", "rating", "top_notes", "middle_notes", "base_notes"]


def _field(df: DataFrame, name: str) -> Column:
    """A column as text; absent columns and missing values give an empty string."""
    if name not in df.columns:
        return F.lit("").alias(name)
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def _result(to_name: str, kind: str, value: Column, from_name: str = "label") -> Column:
    return F.struct(
        F.lit(from_name).alias("from_name"),
        F.lit(to_name).alias("to_name"),
        F.lit(kind).alias("type"),
        value.alias("value"),
    )


def _task(data: Column, results: Column, score: Column, version: str) -> list[Column]:
    prediction = F.struct(
        results.alias("result"), score.cast("double").alias("score"), F.lit(version).alias("model_version")
    )
    return [data.alias("data"), F.array(prediction).alias("predictions")]


def text_tasks(
    df: DataFrame, row_id: str, text: str, label: str = "label", confidence: str = "confidence",
    fields: Sequence[str] = CONTEXT_FIELDS, version: str = MODEL_VERSION,
) -> DataFrame:
    """Classification tasks ``(id, data, predictions)``, numbered from 1 by ``row_id``."""
    data = F.struct(F.col(text).alias("text"), *[_field(df, f) for f in fields])
    choice = F.struct(F.array(F.col(label).cast("string")).alias("choices"))
    results = F.array(_result("text", "choices", choice))
    numbered = number_rows(df, row_id, "_task_id")
    return numbered.select(
        F.col("_task_id").alias("id"), *_task(data, results, F.col(confidence), version)
    )


def choice_tasks(
    df: DataFrame, modality: str, content: str, label: str, confidence: str,
    version: str = "auto-label-v1", keep: Sequence[str] = (),
) -> DataFrame:
    """Classification tasks over a text, image or audio column."""
    data = F.struct(F.col(content).alias(modality))
    choice = F.struct(F.array(F.col(label).cast("string")).alias("choices"))
    results = F.array(_result(modality, "choices", choice))
    return df.select(*keep, *_task(data, results, F.col(confidence), version))


def span_tasks(
    df: DataFrame, text: str, spans: str, confidence: str, version: str = "auto-label-v1",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Entity tasks; ``spans`` is an array of structs ``(start, end, label)``."""
    results = F.transform(
        spans,
        lambda s: _result(
            "text", "labels",
            F.struct(
                s["start"].alias("start"), s["end"].alias("end"),
                F.substring(F.col(text), s["start"] + 1, s["end"] - s["start"]).alias("text"),
                F.array(s["label"]).alias("labels"),
            ),
        ),
    )
    data = F.struct(F.col(text).alias("text"))
    return df.select(*keep, *_task(data, results, F.col(confidence), version))


def box_percent(box: Column) -> Column:
    """Pixel box ``(x, y, width, height, image_width, image_height, label)`` in percent of the image."""
    def share(part: str, whole: str) -> Column:
        return F.try_divide(box[part].cast("double") * 100.0, box[whole].cast("double"))

    return F.struct(
        share("x", "image_width").alias("x"),
        share("y", "image_height").alias("y"),
        share("width", "image_width").alias("width"),
        share("height", "image_height").alias("height"),
    )


def box_tasks(
    df: DataFrame, image: str, boxes: str, confidence: str, version: str = "auto-label-v1",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Detection tasks; ``boxes`` is an array of pixel boxes."""
    def one(box: Column) -> Column:
        p = box_percent(box)
        value = F.struct(
            p["x"].alias("x"), p["y"].alias("y"), p["width"].alias("width"), p["height"].alias("height"),
            F.lit(0).alias("rotation"), F.array(box["label"]).alias("rectanglelabels"),
        )
        return F.struct(
            F.lit("label").alias("from_name"),
            F.lit("image").alias("to_name"),
            F.lit("rectanglelabels").alias("type"),
            value.alias("value"),
            box["image_width"].alias("original_width"),
            box["image_height"].alias("original_height"),
        )

    data = F.struct(F.col(image).alias("image"))
    return df.select(*keep, *_task(data, F.transform(boxes, one), F.col(confidence), version))


def annotation_tasks(
    df: DataFrame, modality: str, task: str, columns: Mapping[str, str],
    version: str = "auto-label-v1", keep: Sequence[str] = (),
) -> DataFrame:
    """Tasks for ``classification``, ``ner`` or ``detection``; ``columns`` names the inputs."""
    if task == "classification":
        return choice_tasks(
            df, modality, columns["content"], columns["label"], columns["confidence"], version, keep
        )
    if task == "ner":
        return span_tasks(df, columns["content"], columns["spans"], columns["confidence"], version, keep)
    if task == "detection":
        return box_tasks(df, columns["content"], columns["boxes"], columns["confidence"], version, keep)
    raise ValueError(f"unknown task {task!r}")


def to_json_rows(tasks: DataFrame, task_id: str) -> DataFrame:
    """Tasks as ``(task_id, json)``, one JSON object per row."""
    body = [c for c in tasks.columns if c != task_id or task_id == "id"]
    return tasks.select(F.col(task_id).alias("task_id"), F.to_json(F.struct(*body)).alias("json"))


_VALUE = (
    "struct<choices:array<string>,labels:array<string>,rectanglelabels:array<string>,"
    "start:int,end:int,text:string,x:double,y:double,width:double,height:double>"
)
_RESULT = f"struct<from_name:string,to_name:string,type:string,value:{_VALUE}>"


def _parsed(rows: DataFrame) -> DataFrame:
    """Results of every prediction as typed structs, with the raw parts needed by the rules."""
    json = F.col("json")
    results = F.from_json(
        F.get_json_object(json, "$.predictions"),
        f"array<struct<result:array<{_RESULT}>,score:double>>",
    )
    raw = F.from_json(F.get_json_object(json, "$.predictions"), "array<struct<result:string>>")
    return rows.select(
        "task_id",
        F.try_parse_json(json).isNotNull().alias("valid"),
        F.get_json_object(json, "$.data").alias("data"),
        F.get_json_object(json, "$.data.text").alias("text"),
        raw.alias("raw"),
        results.alias("predictions"),
    )


def validate_tasks(rows: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Broken rules per task: rows ``(task_id, rule)``; ``rows`` has ``task_id`` and ``json``.

    Names are consistent when every result uses the pair of names that most
    results use.
    """
    parsed = _parsed(rows)
    flat = F.flatten(F.transform(F.coalesce("predictions", F.array()), lambda p: F.coalesce(p["result"], F.array())))
    checked = parsed.withColumn("results", flat)
    names = checked.select(F.explode("results").alias("r")).groupBy(
        F.concat_ws("|", "r.from_name", "r.to_name").alias("names")
    ).agg(F.count(F.lit(1)).alias("n"))
    usual = names.agg(F.min(F.struct((-F.col("n")).alias("n"), "names")).alias("b")).select("b.names").scalar()
    allowed = F.array(*[F.lit(c) for c in classes])

    def inside(value: Column) -> Column:
        ends = [value["x"], value["y"], value["width"], value["height"],
                value["x"] + value["width"], value["y"] + value["height"]]
        ok = F.lit(True)
        for e in ends:
            ok = ok & F.coalesce(e.between(0.0, 100.0), F.lit(False))
        return ok

    def labels(value: Column) -> Column:
        empty = F.array().cast("array<string>")
        return F.concat(*[F.coalesce(value[k], empty) for k in ("choices", "labels", "rectanglelabels")])

    named = checked.withColumn("usual", usual)
    span_bad = F.exists(
        "results",
        lambda r: r["value"]["start"].isNotNull() & ~F.coalesce(
            F.substring(F.col("text"), r["value"]["start"] + 1, r["value"]["end"] - r["value"]["start"])
            == r["value"]["text"],
            F.lit(False),
        ),
    )
    rules = [
        ("invalid_json", ~F.col("valid")),
        ("no_data", F.col("valid") & F.col("data").isNull()),
        ("result_not_array", F.exists(
            F.coalesce("raw", F.array()), lambda p: ~F.coalesce(p["result"].startswith("["), F.lit(False)))),
        ("inconsistent_names", F.exists(
            "results", lambda r: F.concat_ws("|", r["from_name"], r["to_name"]) != F.col("usual"))),
        ("span_text_differs", span_bad),
        ("box_outside_image", F.exists(
            "results", lambda r: (r["type"] == "rectanglelabels") & ~inside(r["value"]))),
        ("unknown_label", F.exists(
            "results", lambda r: F.size(F.array_except(labels(r["value"]), allowed)) > 0)),
    ]
    broken = F.array_compact(F.array(*[F.when(test, F.lit(rule)) for rule, test in rules]))
    return named.select("task_id", F.explode(broken).alias("rule"))


def write_task_batches(tasks: DataFrame, path: str, order: str = "id", batch: int = 10_000) -> None:
    """JSON lines in id order, at most ``batch`` tasks per file."""
    tasks.repartitionByRange(order).sortWithinPartitions(order).write.option(
        "maxRecordsPerFile", batch
    ).mode("errorifexists").json(path)
