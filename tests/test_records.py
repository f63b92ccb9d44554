"""Records with line breaks inside quotes, read over many splits."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tablewright.sources import delimited as dl
from tablewright.sources import records as rc

CELLS = ["", "plain", "two words", "a,b", 'say "hi"', "line\nbreak", '"\n"', "\n\n", ',"\n,"', "é­\U0001F600", 'x""y', "crlf\r\nin", " lead"]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "200b", "spark.sql.files.openCostInBytes": "10b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(path, rows, end="\n", mark=""):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    path.write_bytes((mark + out.getvalue()).encode())


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_records_over_many_splits(spark, tmp_path, small_splits, seed, end):
    pick = random.Random(seed)
    files = {}
    for name in ("a.csv", "b.csv", "c.csv"):
        rows = [["id", "text", "other"]] + [
            [str(i), pick.choice(CELLS) * pick.randrange(1, 4), pick.choice(CELLS)] for i in range(pick.randrange(1, 120))
        ]
        files[name] = rows
        written(tmp_path / name, rows, end, "﻿" if name == "b.csv" else "")
    found = rc.read_records(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    got = {}
    for r in found.collect():
        got.setdefault(r.file.rsplit("/", 1)[1], {})[r.number] = next(csv.reader(io.StringIO(r.record, newline="")))
    assert got == {n: {i + 1: row for i, row in enumerate(rows)} for n, rows in files.items()}
    back = dl.read_untyped(spark, str(tmp_path), ["id", "text", "other"], multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(tuple(r) for rows in files.values() for r in rows[1:])


def test_same_as_one_task_per_file(spark, tmp_path, small_splits):
    """Quotes in unquoted fields, doubled quotes, short and long lines."""
    text = (
        'no;product;text\n1;5" pipe;"hi; ""x""\ny"\n2;B;z;extra\n3;C\n4;D;\n5;E;z;\n\n6;F;"a\n;b";;\n7;G;"a;b\n\nc;d"\n'
        '8;it is 6" long;"""q""\n"\n9;H;""\n10;I;"' + "long\n" * 300 + '"\n11;"J ""\n""";k\n'
    )
    (tmp_path / "t.csv").write_text(text, encoding="utf-8")
    schema = "no long, product string, text string"
    plain = spark.read.schema(schema).options(header=True, sep=";", quote='"', escape='"', multiLine=True).csv(str(tmp_path))
    want = sorted(tuple(None if x == "" else x for x in r) for r in plain.collect())
    got = sorted(map(tuple, dl.read_delimited(spark, str(tmp_path), schema, sep=";", multi_line=True).collect()))
    assert got == want and len(got) == 11
    fit = dl.read_delimited(spark, str(tmp_path), schema, sep=";", multi_line=True, skip_long_lines=True).collect()
    assert sorted(r.no for r in fit) == [1, 3, 4, 7, 8, 9, 10, 11]


def test_open_after():
    for line, closed, open_ in (
        ("a,b", False, True), ('a,"b', True, False), ('"a"', False, False), ('"a""', True, False), ('x",y', False, False),
        ('5" a,"b', True, True), ('","', False, True), ("", False, True), ('""', False, True), ('"', True, False),
    ):
        assert (rc.open_after(line, False, ","), rc.open_after(line, True, ",")) == (closed, open_), line
    assert rc.open_after('a||"b', False, "||") and not rc.open_after('a|"b', False, "||")


def test_split_starts(spark):
    """All runs of splits that keep, swap or set the state, next to a walk over them."""
    pick = random.Random(4)
    rows, want = [], []
    for f in range(30):
        inside, before = False, 0
        for block in range(pick.randrange(1, 12)):
            ends, counts = (pick.random() < 0.5, pick.random() < 0.5), (pick.randrange(5), pick.randrange(5))
            rows.append((f"f{f}", block * 100, *counts, *ends))
            want.append((f"f{f}", block * 100, inside, before))
            before += counts[inside]
            inside = ends[inside]
    pick.shuffle(rows)
    splits = spark.createDataFrame(rows, "file string, block bigint, n0 bigint, n1 bigint, open0 boolean, open1 boolean")
    assert sorted(map(tuple, rc.split_starts(splits).collect())) == sorted(want)


def test_long_cells_and_many_quotes(spark, tmp_path):
    """Cells of a megabyte and lines of very many quotes end no executor."""
    big = 'x"' * 500_000
    rows = [["a", "b"], ["1", big], ["2", ""], ["3", "y" * 1_000_000]]
    written(tmp_path / "big.csv", rows)
    for lines in (False, True):
        got = dl.read_delimited(spark, str(tmp_path), "a int, b string", multi_line=lines, skip_long_lines=True)
        assert sorted((r.a, r.b) for r in got.collect()) == [(1, big), (2, None), (3, "y" * 1_000_000)]
    probed = {r.column: (r.type, r.n_rows) for r in dl.probe_folder(spark, str(tmp_path)).collect()}
    assert probed == {"a": ("int", 3), "b": ("string", 3)}


def test_probe_with_line_breaks(spark, tmp_path):
    written(tmp_path / "t.csv", [["id", "text", "n"], ["1", "a\nb", "2.5"], ["2", "c", "NA"], ["3", 'd "e"\n', "3"]])
    found = {r.column: r for r in dl.probe_folder(spark, str(tmp_path)).collect()}
    assert {c: (r.type, r.n_rows) for c, r in found.items()} == {"id": ("int", 3), "text": ("string", 3), "n": ("double", 3)}
    assert found["text"].first_values == ["a\nb", "c", 'd "e"\n']
    back = dl.read_inferred(spark, str(tmp_path), multi_line=True)
    assert back.dtypes == [("id", "int"), ("text", "string"), ("n", "double")]
    assert sorted(map(tuple, back.collect())) == [(1, "a\nb", 2.5), (2, "c", None), (3, 'd "e"\n', 3.0)]


def test_only_long_records_are_shuffled(spark, tmp_path, small_splits):
    written(tmp_path / "t.csv", [["id", "text"]] + [[str(i), "one line " * 5] for i in range(300)] + [["x", "two\nlines"]])
    df = rc.read_records(spark, str(tmp_path)).agg(F.count(F.lit(1)).alias("n"), F.max("number").alias("last"))
    assert tuple(df.first()) == (302, 302)
    assert rc.read_records(spark, str(tmp_path)).where("number = 302").first().record == 'x,"two\nlines"'


def test_files_without_a_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text('1,"a\nb"\n2,c\n', encoding="utf-8")
    for lines, want in ((True, [(1, "a\nb"), (2, "c")]),):
        got = dl.read_delimited(spark, str(tmp_path), "a int, b string", multi_line=lines, header=False)
        assert sorted(map(tuple, got.collect())) == want
    (tmp_path / "t.csv").write_text("1,a\n2,c,d\n", encoding="utf-8")
    for long, want in ((False, [1, 2]), (True, [1])):
        got = dl.read_delimited(spark, str(tmp_path), "a int, b string", skip_long_lines=long, header=False)
        assert sorted(r.a for r in got.collect()) == want
