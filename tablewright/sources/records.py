"""Records of delimited files with line breaks inside quotes, read in many tasks.

Whether a line begins inside quotes depends on all lines before it. Each task
therefore follows its split twice at once, as if it began outside and as if it
began inside quotes, and tells how it ends in either case. That makes one row
per split; a running composition over them finds how each split really begins
and how many records begin before it. With that every line knows its record.
A record of one line passes straight through; only lines of longer ones are
shuffled to be joined.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

QUOTE = '"'
MARK = "\ufeff"

_LINES = (
    "file string, block bigint, at bigint, line string, "
    "n0 bigint, n1 bigint, begins0 boolean, begins1 boolean, open0 boolean, open1 boolean"
)


def open_after(line: str, inside: bool, sep: str) -> bool:
    """Does ``line`` end inside quotes, given how it begins?

    A quote opens at the start of a field only and closes unless it is doubled;
    in an unquoted field it is a character like any other.
    """
    at = 0
    while True:
        if inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line.startswith(QUOTE, at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        elif line.startswith(QUOTE, at):
            inside, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _followed(lines: DataFrame, sep: str) -> DataFrame:
    """Lines (file, block, line) with their place in the split and, for both beginnings of the split, the number of
    records begun so far, whether one begins here and whether the line ends inside quotes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, at, state, count = None, 0, [False, True], [0, 0]
        for batch in batches:
            out = [[] for _ in range(7)]
            quoted = pc.match_substring(batch.column(2), QUOTE).to_pylist()
            files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, key in enumerate(zip(files, blocks)):
                if key != split:
                    split, at, state, count = key, 0, [False, True], [0, 0]
                begins = [not state[0], not state[1]]
                if quoted[i]:
                    line = batch.column(2)[i].as_py()
                    same = state[0] == state[1]
                    state[0] = open_after(line, state[0], sep)
                    state[1] = state[0] if same else open_after(line, state[1], sep)
                count[0] += begins[0]
                count[1] += begins[1]
                for column, value in zip(out, (at, *count, *begins, *state)):
                    column.append(value)
                at += 1
            kinds = [pa.int64()] * 3 + [pa.bool_()] * 4
            made = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), made[0], batch.column(2), *made[1:]],
                ["file", "block", "at", "line", "n0", "n1", "begins0", "begins1", "open0", "open1"],
            )

    return lines.mapInArrow(work, _LINES)


def split_starts(splits: DataFrame) -> DataFrame:
    """How each split begins: ``inside`` quotes or not, and the number of records begun ``before`` it.

    ``splits`` has file, block, and what the split does to both beginnings
    (n0, n1, open0, open1). A split either keeps or swaps the state, or sets it
    whatever it was; the state before a split is that of the last one that set
    it, swapped as often as splits in between do.
    """
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy("file").orderBy("block")
    sets = F.col("open0") == F.col("open1")
    swaps = (~sets & F.col("open0")).cast("int")
    turned = splits.withColumn("_turn", F.sum(swaps).over(order)).withColumn(
        "_set", F.when(sets, F.struct(F.col("open0").cast("int").alias("to"), F.col("_turn").alias("turn")))
    )
    last = F.last("_set", ignorenulls=True).over(upto)
    begun = turned.withColumn("_last", last).withColumn("_turned", F.coalesce(F.lag("_turn").over(order), F.lit(0)))
    state = F.coalesce(F.col("_last.to"), F.lit(0)) + F.col("_turned") - F.coalesce(F.col("_last.turn"), F.lit(0))
    known = begun.withColumn("inside", F.pmod(state, F.lit(2)) == 1)
    own = F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0"))
    return known.withColumn("_own", own).select(
        "file", "block", "inside", F.coalesce(F.sum("_own").over(upto), F.lit(0)).alias("before")
    )


def read_records(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> DataFrame:
    """``(file, number, record)``: the records of each file, numbered from one.

    Lines end with a line feed, with or without a carriage return before it; a
    byte-order mark at the start of a file is left out. Blank lines outside
    quotes count as records. A quote that is never closed makes one record of
    the rest of its file, as the format has it.
    """
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.when(
            (F.col("_metadata.file_block_start") == 0) & F.startswith("value", F.lit(MARK)), F.substring("value", 2, 2**31 - 1)
        ).otherwise(F.col("value")).alias("line"),
    )
    followed = _followed(lines, sep)
    # the last line of a split has its totals
    totals = F.max_by(F.struct("n0", "n1", "open0", "open1"), "at")
    splits = followed.groupBy("file", "block").agg(totals.alias("t")).select("file", "block", "t.*")
    placed = followed.join(split_starts(splits), ["file", "block"])

    def own(name: str):
        return F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    numbered = placed.select(
        "file", "block", "at", "line", (F.col("before") + own("n")).alias("number"),
        (own("begins") & ~own("open")).alias("whole"),
    )
    joined = numbered.where("NOT whole").groupBy("file", "number").agg(
        # the lines of one record
        F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("parts")
    ).select("file", "number", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record"))
    both = numbered.where("whole").select("file", "number", F.col("line").alias("record")).unionByName(joined)
    return both.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
