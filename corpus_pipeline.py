"""A cleaning pipeline over the document table: five stages, each one operator of ``tablewright.llm``.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps;
its result is written as Parquet and read again as the next one's input. All
stages but the last return the columns of documents. Columns beyond those, of
whatever names, are carried along; tables without rows give none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm import linedup, mixing, simhash, toxicity, winnowing
from tablewright.llm.bitmaps import on_map_of, text_key, without
from tablewright.llm.naming import unused
from tablewright.session import cut_lineage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores 0.5 or higher go.

    The labels of documents that are no longer there teach nothing. NULL and
    empty texts have the score of the bias; repeated rows stay or go together.
    """
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    score = unused(docs.columns, "_score")
    return toxicity.score(docs, model, out=score).where(F.col(score) < 0.5).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go; so do documents left without a word by that.

    ``n_chars`` follows the text where lines have gone. NULL, empty and blank
    texts lose nothing and stay; repeated rows are one document and lose
    nothing to each other.
    """
    deleted = unused(docs.columns, "_deleted")
    cut = linedup.without_repeated_lines(docs, deleted=deleted)
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    rest = cut.where((F.col(deleted) == 0) | ~blank)
    length = F.when(F.col(deleted) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rest.withColumn("n_chars", F.coalesce(length, "n_chars")).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates (three words, two bits) one document stays.

    The one that stays has the least id, and under one id the least text key;
    rows without id come last. Rows are told apart by id and text, so a row
    never goes for another one under its id. Rows that agree in both are one
    document: one of them stays. NULL, empty and blank texts are one group.
    """
    judged = cut_lineage(simhash.representatives(docs, words=3, distance=2))
    gone = judged.where("NOT stays").select("_id", "_key").distinct()
    rest = without(docs, gone, {"_id": F.col("doc_id"), "_key": text_key("text")})
    repeated = judged.where("stays").groupBy("_id", "_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    listed = on_map_of(repeated.select(F.xxhash64("_id", "_key").alias("h")))(F.xxhash64("doc_id", text_key("text")))
    once = rest.where(listed).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("id"), text_key("text").alias("key"),
    ).dropDuplicates(["id", "key"])
    return rest.where(~listed).unionByName(once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go.

    Rows are judged by id and text, so repeated rows go together and rows that
    share only an id don't. NULL and empty texts hold no passage and stay.
    """
    key = unused(docs.columns, "_key")
    keyed = docs.withColumn(key, text_key("text"))
    hits = winnowing.benchmark_hits(keyed, _table(spark, sf_dir, "benchmark"), keep=[key])
    gone = cut_lineage(hits.where("n_hit > 0").select("doc_id", key).distinct())
    return without(docs, gone, {"doc_id": F.col("doc_id"), key: text_key("text")})


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the number of words to take of each, repeats counted.

    NULL, empty and blank texts have no words and are not in it; repeated rows
    count each for itself. Only ids, sources, sizes and figures are returned.
    """
    return mixing.mix(docs).documents.where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# hashing, patience diff and the classifier can't be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next one reads it."""
    docs = _table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
