"""Registered queries over the given tables, with an equivalent ANSI SQL text where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels where they have any."""
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


def labeled(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")


REVIEWS_SQL = (
    "rev AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)

# roles of the document table
ROLES = {"text": "text", "key": "source", "group": "lang", "target": "quality"}


def near(value: Column | str, digits: int = 6) -> Column:
    """Rounded figure, for sums whose last bits depend on the order of addition."""
    return F.round(F.col(value) if isinstance(value, str) else value, digits)


# confidence and labels derived from the documents, for operators that need labeled rows
CONFIDENCE_SQL = "((n_chars % 1000) / 1000.0)::DOUBLE"
BAND_SQL = (
    "CASE WHEN n_chars % 7 < 3 THEN 'liked' WHEN n_chars % 7 < 5 THEN 'mixed' ELSE 'not_liked' END"
)
SCORED_SQL = (
    f"scored AS (SELECT doc_id, text, lang, source, n_chars, {BAND_SQL} AS label, "
    f"{CONFIDENCE_SQL} AS confidence, "
    "CASE WHEN n_chars % 5 < 2 THEN 'liked' WHEN n_chars % 5 < 4 THEN 'mixed' ELSE 'not_liked' END "
    "AS second FROM documents)"
)


def scored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with two labelings and a confidence derived from their length."""
    n = F.col("n_chars")
    first, other = n % 7, n % 5
    return table(spark, folder, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars",
        F.when(first < 3, "liked").when(first < 5, "mixed").otherwise("not_liked").alias("label"),
        ((n % 1000) / 1000.0).alias("confidence"),
        F.when(other < 2, "liked").when(other < 4, "mixed").otherwise("not_liked").alias("second"),
    )
