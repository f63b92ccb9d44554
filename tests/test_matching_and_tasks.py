import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import agreement as ag
from tablewright.operators import compare, matching, pages, tasks


def test_prefix_match(spark):
    names = spark.createDataFrame([("Chanel No 5",), ("Chanel No 5 Eau de Parfum",)], "name string")
    fact = spark.createDataFrame([(1, "CHANEL No 5 Eau de Parfum для женщин"), (2, "zzz"), (3, "chanel no 5 x"), (4, None)],
                                 "id long, product string")
    got = {r["id"]: r["matched_name"] for r in matching.longest_prefix_match(fact, names, "product", "name", ["id"]).collect()}
    assert got == {1: "Chanel No 5 Eau de Parfum", 2: None, 3: "Chanel No 5", 4: None}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


@pytest.mark.parametrize("limit", [1, 2])
def test_fuzzy_match_equals_brute_force(spark, limit):
    rng = random.Random(limit)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 6)))
    left, right = {word() for _ in range(60)}, {word() for _ in range(60)}
    a = spark.createDataFrame([(x,) for x in left], "l string")
    b = spark.createDataFrame([(x,) for x in right], "r string")
    got = {r["left_key"]: (r["distance"], r["right_key"]) for r in matching.fuzzy_match(a, b, "l", "r", limit).collect()}
    want = {}
    for x in left - right:
        near = sorted((edits(x, y), y) for y in right if edits(x, y) <= limit)
        if near:
            want[x] = near[0]
    assert got == want


@pytest.mark.parametrize("limit", [1, 2])
def test_fuzzy_match_of_long_keys_equals_brute_force(spark, limit):
    """Keys of all lengths with common beginnings and ends, repeated characters and edits anywhere."""
    rng = random.Random(limit)

    def changed(key):
        for _ in range(rng.randrange(limit + 2)):
            at = rng.randrange(len(key) + 1)
            key = rng.choice([key[:at] + rng.choice("ax9") + key[at:], key[:at] + key[at + 1:], key[:at] + "é" + key[at + 1:]])
        return key

    base = {"https://shop.example/item/" + str(rng.randrange(2000)) + "/view" for _ in range(50)}
    base |= {"Customer#" + f"{rng.randrange(10**6):09d}" for _ in range(40)} | {"aaaaaaaa" + "b" * i for i in range(12)} | {"", "a", "ab"}
    right = {*base, *map(changed, base)}
    left = set(map(changed, base)) | {"zzz", "aa"}
    a = spark.createDataFrame([(x,) for x in left], "l string")
    b = spark.createDataFrame([(x,) for x in right], "r string")
    got = {r["left_key"]: (r["distance"], r["right_key"]) for r in matching.fuzzy_match(a, b, "l", "r", limit).collect()}
    want = {}
    for x in left - right:
        near = sorted((edits(x, y), y) for y in right if abs(len(x) - len(y)) <= limit and edits(x, y) <= limit)
        if near:
            want[x] = near[0]
    assert got == want and len(want) > 20


def test_a_shared_part_brings_no_keys_together(spark):
    """Very many keys with one beginning and one end meet few others."""
    keys = spark.range(20_000).select(
        F.concat(F.lit("https://shop.example/catalogue/item-"), F.substring(F.md5(F.col("id").cast("string")), 1, 12), F.lit(".html?view=full")).alias("k")
    )
    a = keys.select(F.regexp_replace("k", "view=full", "view=ful").alias("left_key"))
    pairs = matching.candidate_pairs(a, keys.withColumnRenamed("k", "right_key"), 1)
    assert 20_000 <= pairs.count() < 80 * 20_000  # of 4 * 10**8


def test_keys_that_differ_in_few_digits_meet_few_others(spark):
    """Numbers between a common beginning and a common end, one character lost and another mistaken."""
    number = F.lpad(F.col("id").cast("string"), 9, "0")
    keys = spark.range(4_000).select(F.concat(F.lit("https://shop.example/customer/Customer#"), number, F.lit("/orders")).alias("k"))
    typed = keys.where("k LIKE '%7/orders' AND k LIKE '%2%'").select(F.regexp_replace("k", "7/orders", "/orders").alias("k"))
    typed = typed.select(F.regexp_replace("k", "2", "z").alias("left_key"))
    pairs = matching.candidate_pairs(typed, keys.withColumnRenamed("k", "right_key"), 2)
    near = typed.crossJoin(keys).where(F.levenshtein("left_key", "k", 2) >= 0)
    n, n_near = pairs.count(), near.count()
    assert pairs.exceptAll(near).count() == n - n_near and n_near > 1_000
    assert n < 3 * n_near


def test_missing_keys_meet_only_when_asked(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v long")
    b = spark.createDataFrame([("x", 10), (None, 20)], "k string, w long")
    assert sorted(r["w"] or 0 for r in matching.enrich(a, b, "k").collect()) == [0, 10]
    assert sorted(r["w"] for r in matching.enrich(a, b, "k", True).collect()) == [10, 20]


def test_sections(spark):
    heads = spark.createDataFrame([(1, 100.0, "Top notes"), (1, 200.0, "Heart"), (1, 300.0, "BASE"), (1, 250.0, "Reviews")],
                                  "page long, pos double, t string")
    spots = [94.0, 95.0, 194.0, 195.0, 350.0]
    labels = spark.createDataFrame([(1, p, f"n{int(p)}") for p in spots] + [(1, 150.0, ""), (1, 151.0, "x" * 61)],
                                   "page long, pos double, t string")
    got = {r["pos"]: r["section"] for r in matching.assign_sections(heads, labels, "page", "pos", "t").collect()}
    assert got == {95.0: "top", 194.0: "top", 195.0: "middle", 350.0: "base"}


def test_page_sections_and_rating(spark):
    html = (
        '<p class="a pyramid-note-label">lost</p><h4>Top Notes</h4><div class="pyramid-note-label"> <b>Lemon</b> </div>'
        '<h4>Other</h4><span class="pyramid-note-label x">Lime</span><h4>Base</h4><div class="pyramid-note-label">Musk</div>'
        '<div class="pyramid-note-label"></div><span itemprop="ratingValue">4.2</span><meta itemprop="ratingCount" content="77">'
    )
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "id long, html string")
    found = pages.extract_sections(df, "id", "html", sections=matching.SECTION_WORDS)
    lists = pages.section_lists(found, "id", {"top": "top_notes", "middle": "middle_notes", "base": "base_notes"})
    kept = pages.keep_all_queries(df.select("id"), lists, "id", ["top_notes", "middle_notes", "base_notes"])
    assert sorted(tuple(r) for r in kept.collect()) == [(1, ["Lemon", "Lime"], [], ["Musk"]), (2, [], [], [])]
    rated = {r["page"]: (r["rating"], r["votes"]) for r in pages.extract_rating(
        df.withColumnRenamed("id", "page"), "page", "html").collect()}
    assert rated == {1: (4.2, 77), 2: (None, None)}


def test_link_scores(spark):
    page = (
        '<a class="x" href="/perfume/Other/Thing-1.html">Thing</a><a href="/perfume/Chanel/No-5-Parfum-2.html"><b>Chanel No 5 Parfum</b></a>'
        '<a href="/news/1.html">Parfum</a><a href="/perfume/Chanel/">Chanel Parfum</a>'
    )
    queries = spark.createDataFrame([(1, "No 5 Parfum", "Chanel", 9), (2, "zzzz", "yyyy", 9), (3, "a", "b", 8)],
                                    "q long, name string, brand string, page long")
    links = pages.extract_links(spark.createDataFrame([(9, page)], "page long, html string"), "page", "html")
    scored = pages.score_links(queries, links, "page", "name", "brand")
    best = {r["q"]: (r["url"], r["score"]) for r in pages.best_links(scored, "q").collect()}
    assert best == {1: ("/perfume/Chanel/No-5-Parfum-2.html", 4), 2: ("/perfume/Other/Thing-1.html", 0)}


def test_kappa_and_f1(spark):
    pairs = [("a", "a")] * 20 + [("a", "b")] * 5 + [("b", "a")] * 10 + [("b", "b")] * 15
    row = ag.agreement(spark.createDataFrame(pairs, "x string, y string"), "x", "y").first()
    assert (row["agreement_pct"], row["kappa"], row["band"]) == (70.0, 0.4, "Moderate")
    always = spark.createDataFrame([("p", "p")] * 93 + [("n", "p")] * 69, "x string, y string")
    assert tuple(ag.evaluate(always, "x", "y").first()) == (0.5741, 0.3647)
    same = spark.createDataFrame([("p", "p")] * 5, "x string, y string")
    assert ag.agreement(same, "x", "y").first()["kappa"] is None


def test_ks(spark):
    a = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "v double")
    b = spark.createDataFrame([(float(x),) for x in (3, 4, 5, 6)], "v double")
    row = compare.ks_two_sample(a, b, F.col("v"), method="exact").first()
    assert row["statistic"] == 0.5 and row["pvalue"] == pytest.approx(0.7714, abs=1e-4)
    limit = compare.ks_two_sample(a, b, F.col("v")).first()
    assert limit["statistic"] == 0.5 and limit["pvalue"] == pytest.approx(compare.ks_p_value(0.5, 4, 4))
    assert compare.ks_p_value(0.0292, 931, 883, "exact") == pytest.approx(0.819, abs=1e-3)
    assert compare.ks_p_value(0.0129, 807, 883, "exact") == pytest.approx(1.0, abs=1e-3)
    assert compare.ks_p_value(0.0327, 931, 807, "exact") == pytest.approx(0.727, abs=1e-3)
    assert compare.ks_p_value(0.02, 20000, 20000) == pytest.approx(0.000671, abs=1e-5)


def test_tasks_and_rules(spark):
    df = spark.createDataFrame([(7, "text b", "liked", 0.9), (3, "text a", "mixed", 0.4)],
                               "id long, t string, label string, confidence double")
    made = tasks.text_tasks(df, "id", "t")
    first = made.orderBy("id").first()
    assert first["id"] == 1 and first["data"]["text"] == "text a" and first["data"]["brand"] == ""
    assert first["predictions"][0]["result"][0]["value"]["choices"] == ["mixed"]
    assert tasks.validate_tasks(tasks.to_json_rows(made, "id"), ["liked"]).collect()[0]["rule"] == "unknown_label"


def test_task_files_are_small(spark, tmp_path):
    df = spark.range(25).select("id", F.lit("x").alias("t"))
    tasks.write_task_batches(df, str(tmp_path / "out"), "id", batch=10)
    sizes = [len(p.read_text().splitlines()) for p in (tmp_path / "out").glob("*.json")]
    assert sum(sizes) == 25 and max(sizes) <= 10
