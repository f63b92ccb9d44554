"""Reports and nested records as JSON."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tablewright.functions.text import join_list

DEFAULT_REPORT = "data/reports/quality_report"


def write_report(report: DataFrame, path: str = DEFAULT_REPORT, mode: str = "overwrite") -> str:
    """One nested row as one JSON file in a new folder; a report is one row by construction."""
    report.coalesce(1).write.mode(mode).json(path)
    return path


def read_report(
    spark: SparkSession, path: str = DEFAULT_REPORT, schema: T.StructType | str | None = None
) -> DataFrame:
    """A JSON object per file, spread over lines or not."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def report_metrics(report: DataFrame, prefix: str = "") -> DataFrame:
    """A one-row report in long form: ``(metric, value)`` with JSON-encoded values."""
    cells = [
        F.struct(F.lit(prefix + c).alias("metric"),
                 F.get_json_object(F.to_json(F.struct(F.col(c).alias("v"))), "$.v").alias("value"))
        for c in report.columns
    ]
    return report.select(F.inline(F.array(*cells)))


def merge_reports(old: DataFrame, new: DataFrame) -> DataFrame:
    """Metrics of both long-form reports; a new value replaces the old one."""
    a = old.withColumnRenamed("value", "old_value")
    b = new.withColumnRenamed("value", "new_value")
    return a.join(b, "metric", "full").select(
        "metric", F.coalesce("new_value", "old_value").alias("value")
    )


def merged_objects(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """The nested object ``old`` with the fields of ``new`` put in: objects merge, all else is replaced if it is there."""
    if not (isinstance(old_type, T.StructType) and isinstance(new_type, T.StructType)):
        simple = isinstance(old_type, T.AtomicType) and isinstance(new_type, T.AtomicType)
        return F.coalesce(new, old if old_type == new_type else old.try_cast(new_type)) if simple or old_type == new_type else new
    was, comes = ({f.name: f.dataType for f in kind} for kind in (old_type, new_type))
    fields = []
    for name in [*was, *[n for n in comes if n not in was]]:
        if name not in comes:
            value = old.getField(name)
        elif name not in was:
            value = new.getField(name)
        else:
            value = merged_objects(old.getField(name), new.getField(name), was[name], comes[name])
        fields.append(value.alias(name))
    return F.struct(*fields)


VERSION = "version="


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of a report's published versions."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n[len(VERSION):]) for n in names if n.startswith(VERSION))


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder unless the target is there; the file system decides between writers."""
    fs = spark._jvm.org.apache.hadoop.fs
    folder = fs.Path(target)
    context = fs.FileContext.getFileContext(folder.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    none = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(fs.Path(source), folder, none)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def current_report(spark: SparkSession, path: str) -> DataFrame | None:
    """The last published version of a report that ``update_report`` keeps, or None before the first."""
    numbers = _versions(spark, path)
    return read_report(spark, f"{path}/{VERSION}{numbers[-1]:06d}") if numbers else None


def update_report(spark: SparkSession, path: str, new: DataFrame, attempts: int = 10) -> int:
    """Merge a one-row report into the one at ``path`` and publish the result; returns the number of its version.

    Objects merge field by field, other values replace those before them, and
    what the new report doesn't name stays. The result is written aside and
    published by one rename, so a reader always finds a whole version and a
    writer that dies leaves the last one. A writer that finds its number taken
    merges again into the version that took it; among several writers at the
    same moment that needs a file system that renames atomically, which a local
    disk does not for folders.
    """
    for _ in range(attempts):
        numbers = _versions(spark, path)
        if not numbers:
            merged = new
        else:
            old = read_report(spark, f"{path}/{VERSION}{numbers[-1]:06d}")
            was = old.agg(F.first(F.struct(*[F.col(f"`{c}`") for c in old.columns]))).scalar()
            comes = F.struct(*[F.col(f"`{c}`") for c in new.columns])
            merged = new.select(merged_objects(was, comes, old.schema, new.schema).alias("r")).select("r.*")
        aside, number = f"{path}/_{uuid.uuid4().hex}", numbers[-1] + 1 if numbers else 1
        write_report(merged, aside)
        if _renamed(spark, aside, f"{path}/{VERSION}{number:06d}"):
            return number
    raise RuntimeError(f"other writers kept publishing versions of {path}")


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found = []
    for f in schema:
        here = (*path, f.name)
        if isinstance(f.dataType, T.StructType):
            found += _leaves(f.dataType, here)
        else:
            found.append(here)
    return found


def flatten_records(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as columns named by their path; arrays stay arrays."""
    def column(path: Sequence[str]) -> Column:
        return F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path))

    return df.select(*[column(p) for p in _leaves(df.schema)])


def explode_records(df: DataFrame, array: str) -> DataFrame:
    """One row per element of an array column; rows without elements stay."""
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.explode_outer(array).alias(array))


def read_records(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    return spark.read.option("multiLine", multi_line).schema(schema).json(path)


def flat_lists(df: DataFrame, separator: str = ", ") -> DataFrame:
    """Array-of-text columns joined to text; an empty or missing array gives an empty string."""
    joined = {
        f.name: join_list(F.col(f"`{f.name}`"), separator)
        for f in df.schema
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType)
    }
    return df.withColumns(joined) if joined else df


def write_records(df: DataFrame, json_path: str, csv_path: str) -> None:
    """Nested JSON lines, and the same rows flattened for delimited text."""
    from tablewright.sources.delimited import write_delimited

    df.write.mode("errorifexists").json(json_path)
    write_delimited(flat_lists(df), csv_path)
