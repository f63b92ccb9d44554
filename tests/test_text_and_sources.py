import pytest
from pyspark.sql import functions as F

from tablewright.functions import labels, scalars, text as tx
from tablewright.operators import labeling as lb
from tablewright.sources import delimited as dl
from tablewright.sources import reports as rp


def one(spark, value, schema, column):
    return spark.createDataFrame([(value,)], schema).select(column.alias("x")).first()["x"]


def test_bad_lines(spark, tmp_path):
    path = tmp_path / "corpus.csv"
    path.write_text('﻿no;product;text\n1;A b;"hi; ""x""\ny"\n2;B;z;extra\n3;C\n4;D;\n5;E;z;\n6;F;z;;;\n7;G;"a;b;c;d"\n',
                    encoding="utf-8")
    df = dl.read_delimited(spark, str(path), "no long, product string, text string", sep=";", multi_line=True, skip_long_lines=True)
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(1, "A b", 'hi; "x"\ny'), (3, "C", None), (4, "D", None), (7, "G", "a;b;c;d")]
    assert df.select("no").count() == 4 and df.count() == 4


def test_missing_tokens_and_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\nNA,1.5,x\nnan,zz,null\nok,2,\n", encoding="utf-8")
    got = [tuple(r) for r in dl.read_delimited(spark, str(path), "a string, b double, c string").collect()]
    assert got == [(None, 1.5, "x"), (None, None, None), ("ok", 2.0, None)]
    raw = [tuple(r) for r in dl.read_untyped(spark, str(path), ["a", "b", "c"]).collect()]
    assert raw == [("NA", "1.5", "x"), ("nan", "zz", "null"), ("ok", "2", "")]
    assert dict(dl.read_inferred(spark, str(path)).dtypes)["a"] == "string"


def test_writing_never_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b\nc')], "id long, t string")
    path = str(tmp_path / "out")
    dl.write_delimited(df, path)
    assert dl.read_delimited(spark, path, "id long, t string", multi_line=True).first()["t"] == 'a "q", b\nc'
    with pytest.raises(Exception):
        dl.write_delimited(df, path)


def test_empty_table_keeps_its_header(spark, tmp_path):
    path = str(tmp_path / "none")
    dl.write_labeled(spark.createDataFrame([], "id long, label string"), path)
    files = [p for p in (tmp_path / "none").iterdir() if p.suffix == ".csv"]
    assert [p.read_text().strip() for p in files] == ["id,label"]


def test_reports_keep_non_ascii_and_merge(spark, tmp_path):
    report = spark.createDataFrame([(3, "отчёт")], "total long, name string")
    path = rp.write_report(report, str(tmp_path / "r"))
    assert rp.read_report(spark, path, "total long, name string").first()["name"] == "отчёт"
    merged = rp.merge_reports(rp.report_metrics(report), rp.report_metrics(
        spark.createDataFrame([(4, 0.5)], "total long, kappa double")))
    assert {r["metric"]: r["value"] for r in merged.collect()} == {"total": "4", "name": "отчёт", "kappa": "0.5"}


def test_nested_records(spark):
    df = spark.createDataFrame([(1, (["a", "b"], ("n",)))], "id long, o struct<tags:array<string>,p:struct<q:string>>")
    flat = rp.flatten_records(df)
    assert flat.columns == ["id", "o.tags", "o.p.q"]
    assert rp.flat_lists(flat).first()["o.tags"] == "a, b"


def test_dates_and_rounding(spark):
    days = spark.createDataFrame([(x,) for x in ("01.02.2020", "1.2.2020", "31.02.2020", "xx", None)], "s string")
    got = [str(r["d"]) for r in days.select(scalars.parse_day("s").alias("d")).collect()]
    assert got == ["2020-02-01", "2020-02-01", "None", "None", "None"]
    assert one(spark, 2.5, "v double", scalars.half_even("v")) == 2.0
    assert one(spark, 0.125, "v double", scalars.half_even("v", 2)) == 0.12


def test_tokens_and_terms(spark):
    df = spark.createDataFrame([("Он не я, ok I do",)], "t string")
    assert df.select(tx.tokens("t").alias("x")).first()["x"] == ["он", "не", "ok", "do"]
    assert tx.with_terms(df, "t").first()["terms"] == ["он", "не", "ok", "do", "он не", "не ok", "ok do"]
    empty = spark.createDataFrame([("",), ("one",)], "t string")
    assert [r["terms"] for r in tx.with_terms(empty, "t").collect()] == [[], ["one"]]


def test_text_helpers(spark):
    assert one(spark, "😀é", "t string", F.length("t")) == 2
    assert one(spark, " a ,, b , ", "t string", tx.split_list("t")) == ["a", "b"]
    assert one(spark, None, "t string", tx.split_list("t")) == []
    assert one(spark, "a b c", "t string", tx.word_count("t")) == 3
    assert one(spark, "Dolce & Gabbana One", "t string", tx.search_query("t", F.lit("D&G"))) == "Dolce++Gabbana+One+DG"


def test_probability_scores(spark):
    assert one(spark, [0.5, 0.5], "p array<double>", scalars.entropy("p")) == pytest.approx(0.6931, abs=1e-4)
    assert one(spark, [1.0, 0.0], "p array<double>", scalars.entropy("p")) == 0.0
    assert one(spark, [0.2, 0.5, 0.3], "p array<double>", scalars.margin("p")) == pytest.approx(0.2)


@pytest.mark.parametrize("text,label", [
    ("мне не понравился", "mixed"),
    ("шедевр, рекомендую", "liked"),
    ("ужасно воняет", "not_liked"),
    ("стоп", "liked"),
    ("аромат", "mixed"),
    (None, "mixed"),
])
def test_keyword_annotator(spark, text, label):
    assert one(spark, text, "t string", lb.keyword_label("t")) == label


def test_keyword_lists_have_their_sizes():
    assert (len(lb.LIKED_KEYWORDS), len(lb.NOT_LIKED_KEYWORDS)) == (33, 32)


def test_label_maps(spark):
    df = spark.createDataFrame([("POSITIVE",), ("Negative",), ("neutral",), ("weird",)], "s string")
    got = [r["l"] for r in df.select(labels.sentiment_to_label("s").alias("l")).collect()]
    assert got == ["liked", "not_liked", "mixed", "mixed"]
    bands = spark.createDataFrame([(x,) for x in (-0.1, 0.1, 0.2367, 0.4, 0.7, 0.8)], "k double")
    assert [r["b"] for r in bands.select(labels.agreement_band("k").alias("b")).collect()] == [
        "Poor (worse than chance)", "Slight", "Fair", "Moderate", "Substantial", "Almost perfect"]


def test_classifier_is_loaded_once_per_stream(spark):
    def make():
        return lambda texts: [{"label": "POSITIVE" if "good" in t else "NEGATIVE", "score": 0.123456} for t in texts]

    df = spark.createDataFrame([(1, "good"), (2, "bad")], "id long, t string")
    got = sorted(tuple(r) for r in lb.auto_label(df, make, "t", 1).collect())
    assert got == [(1, "good", "positive", "liked", 0.1235), (2, "bad", "negative", "not_liked", 0.1235)]


def test_byte_order_mark_and_file_list(spark, tmp_path):
    path = str(tmp_path / "marked")
    dl.write_delimited(spark.createDataFrame([(1, "x")], "id long, t string").coalesce(1), path, bom=True)
    file = next(p for p in (tmp_path / "marked").iterdir() if p.suffix == ".csv")
    assert file.read_bytes().startswith(b"\xef\xbb\xbfid,t")
    assert dl.read_delimited(spark, path, "id long, t string").collect()[0]["id"] == 1
    found = dl.list_files(spark, path, "*.csv").collect()
    assert len(found) == 1 and found[0]["length"] == file.stat().st_size
    kinds = lb.inspect_paths(dl.list_files(spark, path, "*.csv"), "path").collect()
    assert [(r["modality"], r["n"]) for r in kinds] == [("text", 1)]


def test_probe_reads_files_with_different_columns_by_one_plan(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,price,"long, name",seen\n1,2,"x, ""y""",2024-01-02\n3000000000,NA,z,\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("﻿flag,when\ntrue,2024-01-02 03:04:05\nFALSE,2024-01-02T03:04:05\n", encoding="utf-8")
    found = {(r.file.rsplit("/", 1)[1], r.position): r for r in dl.probe_folder(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()}
    got = {k: (r.column, r.type, r.n_rows) for k, r in found.items()}
    assert got == {
        ("a.csv", 0): ("id", "bigint", 2), ("a.csv", 1): ("price", "int", 2), ("a.csv", 2): ("long, name", "string", 2),
        ("a.csv", 3): ("seen", "date", 2), ("b.csv", 0): ("flag", "boolean", 2), ("b.csv", 1): ("when", "timestamp", 2),
    }
    assert found[("a.csv", 2)].first_values == ['x, "y"', "z"]
