"""Delimited text: typed and untyped scans, bad lines, missing-value tokens, sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tablewright.sources.records import read_records

# Cell texts that mean a missing value.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_RAW = "_raw_line"
_OVER = "_overflow"


def _as_schema(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _options(sep: str) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"'}


def _reader(spark: SparkSession, sep: str, header: bool = True):
    return (
        spark.read.options(**_options(sep)).option("header", header).option("encoding", "UTF-8").option("enforceSchema", True)
    )


def _ddl(names: Sequence[str]) -> str:
    quoted = [name.replace("`", "``") for name in names]
    return ", ".join(f"`{name}` string" for name in quoted)


def _record_cells(
    spark: SparkSession, path: str | Sequence[str], sep: str, names: Sequence[str], header: bool = True
) -> DataFrame:
    """``_raw_line`` and the text cells of every record but the headers and blank ones."""
    found = read_records(spark, path, sep).where(F.col("number") > int(header)).where(F.trim("record") != "")
    options = {**_options(sep), "multiLine": "true"}
    return found.select(F.col("record").alias(_RAW), F.from_csv("record", _ddl(names), options).alias("_cells")).select(
        _RAW, *[F.col("_cells").getField(n).alias(n) for n in names]
    )


def _separators(line: str, sep: str) -> Column:
    """How many separators stand outside quotes; a doubled quote is the border of two quoted pieces."""
    bare = F.regexp_replace(line, r'"[^"]*+"', "")
    return F.call_function("div", F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))), F.lit(len(sep)))


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    sep: str = ",",
    multi_line: bool = False,
    skip_long_lines: bool = False,
    missing_tokens: Sequence[str] = MISSING_TOKENS,
    header: bool = True,
) -> DataFrame:
    """Scan with a known schema and, unless told otherwise, a header; a byte-order mark is ignored.

    Missing-value tokens and unreadable numbers become NULL, short lines are
    padded with NULL. With ``skip_long_lines`` a line with more fields than
    columns is dropped, even if the extra field is empty. ``multi_line`` allows
    line breaks inside quotes; it costs a further pass over the files and a
    shuffle of the lines that have them, and files are still read in many tasks.
    """
    schema = _as_schema(schema)
    names = schema.fieldNames()
    text = _strings(schema)
    if multi_line:
        rows = _record_cells(spark, path, sep, names, header)
        rows = (rows.where(_separators(_RAW, sep) < len(names)) if skip_long_lines else rows).select(*[F.col(f"`{n}`") for n in names])
    elif skip_long_lines:
        wide = T.StructType(
            [*text.fields, T.StructField(_OVER, T.StringType()), T.StructField(_RAW, T.StringType())]
        )
        rows = (
            _reader(spark, sep, header).option("columnNameOfCorruptRecord", _RAW)
            .option("columnPruning", False).schema(wide).csv(path)
        )
        # a line that fills every column and the extra one is not reported as odd, so it has
        # no raw text; of the others, those with too many separators outside quotes are long
        fits = F.col(_RAW).isNotNull() & (_separators(_RAW, sep) < len(names))
        rows = rows.where(fits & F.col(_OVER).isNull()).select(*names)
    else:
        rows = _reader(spark, sep, header).schema(text).csv(path)
    cells = []
    for f in schema:
        value = F.when(~F.col(f.name).isin(*missing_tokens), F.col(f.name))
        cells.append((value if isinstance(f.dataType, T.StringType) else value.try_cast(f.dataType)).alias(f.name))
    return rows.select(*cells)


def read_inferred(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", multi_line: bool = False,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Scan with types inferred from the data; costs a pass, so prefer a schema."""
    if multi_line:
        probed = probe_folder(spark, path, sep, n_first=0)
        # one row per column of the files; where they differ the wider type counts
        rows = probed.groupBy("position").agg(
            F.min_by("column", "file").alias("column"), F.collect_set("type").alias("types")
        ).orderBy("position").collect()
        guessed = T.StructType([T.StructField(r["column"], T.StructType.fromDDL(f"x {_widest(r['types'])}")[0].dataType) for r in rows])
    else:
        guessed = (
            _reader(spark, sep).option("inferSchema", True).option("nullValue", "NA")
            .option("samplingRatio", sampling_ratio).csv(path).schema
        )
    return read_delimited(spark, path, guessed, sep, multi_line)


def _widest(types: Sequence[str]) -> str:
    """The type that holds values of all ``types``; text where they don't go together."""
    numbers = ["int", "bigint", "double"]
    if all(t in numbers for t in types):
        return max(types, key=numbers.index)
    return "timestamp" if set(types) == {"date", "timestamp"} else types[0] if len(types) == 1 else "string"


def read_untyped(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """Every value as text, blank cells as empty strings."""
    if multi_line:
        rows = _record_cells(spark, path, sep, columns).select(*[F.col(f"`{c}`") for c in columns])
    else:
        rows = _reader(spark, sep).schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(path)
    return rows.na.fill("")


_CUT = "\uffff"  # not a character


def _cells_of(record: Column, sep: str) -> Column:
    """Fields of a record; separators inside quotes don't count.

    Between quotes every second piece is outside, and only there separators cut.
    """
    pieces = F.transform(
        F.split(record, '"', -1), lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(sep), F.lit(_CUT))).otherwise(p)
    )
    cells = F.split(F.array_join(pieces, '"'), _CUT, -1)

    def bare(cell: Column) -> Column:
        quoted = F.startswith(cell, F.lit('"')) & F.endswith(cell, F.lit('"')) & (F.length(cell) > 1)
        return F.replace(F.when(quoted, F.substring(cell, F.lit(2), F.length(cell) - 2)).otherwise(cell), F.lit('""'), F.lit('"'))

    return F.transform(F.transform(cells, lambda c: F.trim(c)), bare)


def probe_folder(
    spark: SparkSession, paths: str | Sequence[str], sep: str = ",", n_first: int = 3,
    missing_tokens: Sequence[str] = MISSING_TOKENS,
) -> DataFrame:
    """One row per file and column: position, name, type of all its values, rows, and the first values.

    All files are read by one plan, whatever their columns; line breaks inside
    quotes belong to their cell. Files have a header; blank lines are no rows.
    Types are int, bigint, double, date, timestamp, boolean or string.
    """
    found = read_records(spark, paths, sep).where((F.col("number") == 1) | (F.trim("record") != ""))
    heads = found.groupBy("file").agg(
        F.max(F.when(F.col("number") == 1, F.col("record"))).alias("_head"), (F.count(F.lit(1)) - 1).alias("n_rows"),
        # blank lines have no place among the first rows
        F.array_sort(F.collect_set(F.when(F.col("number").between(2, n_first + 1), F.col("number")))).alias("_early"),
    ).select("file", "n_rows", "_early", _cells_of(F.col("_head"), sep).alias("_names"))
    cells = found.join(heads, "file").select(
        "file", "n_rows", F.col("number").alias("_at"), "_early", "_names", F.posexplode(
            # the header itself only names the columns
            F.when(F.col("number") == 1, F.transform("_names", lambda _: F.lit(None).cast("string")))
            .otherwise(_cells_of(F.col("record"), sep))
        ).alias("position", "_cell"),
    ).where(F.col("position") < F.size("_names"))
    value = F.when(~F.col("_cell").isin(*missing_tokens), F.col("_cell"))

    kinds = [
        ("int", r"^\s*[+-]?\d+\s*$"), ("bigint", r"^\s*[+-]?\d+\s*$"), ("double", r"\d|^(NaN|[+-]?Infinity)$"),
        ("date", r"^\d{4}-\d{2}-\d{2}$"), ("timestamp", r"^\d{4}-\d{2}-\d{2}[ T]\d"), ("boolean", r"(?i)^(true|false)$"),
    ]
    kind = F.lit("string")
    for name, shape in reversed(kinds):
        # a missing value says nothing about the type
        test = F.coalesce(F.bool_and(F.when(value.isNotNull(), value.try_cast(name).isNotNull() & value.rlike(shape))), F.lit(False))
        kind = F.when(test, name).otherwise(kind)
    early = F.array_contains("_early", F.col("_at"))
    return cells.groupBy("file", "position").agg(
        F.max(F.get("_names", F.col("position"))).alias("column"), kind.alias("type"), F.max("n_rows").alias("n_rows"),
        # at most ``n_first`` values
        F.transform(
            F.array_sort(F.collect_list(F.when(early, F.struct("_at", "_cell")))), lambda x: x["_cell"]
        ).alias("first_values"),
    )


def clean_column_names(df: DataFrame) -> DataFrame:
    """snake_case names; a name used twice gets a number."""
    taken: dict[str, int] = {}
    names = []
    for raw in df.columns:
        spaced = re.sub(r"([a-zа-яё0-9])([A-ZА-ЯЁ])", r"\1_\2", raw.strip())
        base = re.sub(r"\W+", "_", spaced).strip("_").lower() or "column"
        taken[base] = taken.get(base, 0) + 1
        names.append(base if taken[base] == 1 else f"{base}_{taken[base]}")
    return df.toDF(*names)


BYTE_ORDER_MARK = "\ufeff"


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists", bom: bool = False
) -> None:
    """Files with a header; an existing path is never overwritten unless asked.

    With ``bom`` each file starts with a byte-order mark, which spreadsheets expect.
    """
    if bom:
        df = df.toDF(BYTE_ORDER_MARK + df.columns[0], *df.columns[1:])
    (
        df.write.mode(mode).option("header", True).option("sep", sep).option("quote", '"')
        .option("escape", '"').option("emptyValue", "").option("encoding", "UTF-8").csv(path)
    )


def write_labeled(df: DataFrame, path: str, sep: str = ",") -> None:
    """Labeled rows with a header; an input without columns is an error."""
    if not df.columns:
        raise ValueError("no columns to write")
    write_delimited(df, path, sep)


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path and size of every file below a folder; file contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(folder).select("path", "length")
    )
