"""Term counts next to a plain count, with counters that hold everything and counters that run over."""

import math
import random
import re
from collections import Counter

import pytest

from tablewright.functions import text as tx
from tablewright.operators import active, profile, terms


def corpus(n, words, skew, seed):
    pick = random.Random(seed)
    return [" ".join(f"w{int(words * pick.random() ** skew)}" for _ in range(pick.randrange(60))) for _ in range(n)]


def plain(texts, max_n=2):
    tf, df = Counter(), Counter()
    for t in texts:
        found = re.findall(r"\w{2,}", t.lower())
        grams = found + [" ".join(found[i:i + n]) for n in range(2, max_n + 1) for i in range(len(found) - n + 1)]
        tf.update(grams)
        df.update(set(grams))
    return tf, df


def first(texts, k, max_n=2):
    tf, df = plain(texts, max_n)
    return [(t, tf[t], df[t]) for t in sorted(tf, key=lambda t: (-tf[t], t))[:k]]


@pytest.mark.parametrize("counters", [1 << 19, 400, 150, 20, 3])
def test_frequent_terms(spark, counters):
    """Exact with the bound zero, by rivals, and where the bounds prove nothing."""
    texts = corpus(600, 900, 3, 1)
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "t string").repartition(5)
    got = [tuple(r) for r in terms.frequent_terms(df, "t", 12, 2, counters).collect()]
    assert got == first(texts, 12)


def test_bounds_hold(spark):
    texts = corpus(400, 500, 2, 2)
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    tf, _ = plain(texts)
    for counters in (1000, 100, 10):
        counts, lost = terms.bounded_counts(df, "t", 2, counters)
        got = {r.term: r.tf for r in counts.collect()}
        assert len(got) <= 4 * 2 * counters
        assert all(got.get(t, 0) <= n <= got.get(t, 0) + lost for t, n in tf.items())
        assert lost <= 2 * sum(tf.values()) / counters


def test_no_term_stands_out(spark):
    """Terms of one frequency: ties go by name, whatever the counters."""
    texts = [f"aa{i} bb{i}" for i in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    assert [tuple(r) for r in terms.frequent_terms(df, "t", 5, 2, 10).collect()] == first(texts, 5)
    assert terms.frequent_terms(df.limit(0), "t", 5).count() == 0


def test_all_terms(spark, monkeypatch):
    texts = ["Ünïcode ünïcode_x 12 a", "Он не я, ok I do", "², ½x ⅷⅷ é́é", *corpus(50, 40, 1, 3)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    tf, docs = plain(texts, 3)
    for held in (1 << 19, 5):
        monkeypatch.setattr(terms, "HELD", held)
        assert {r.term: (r.tf, r.df) for r in terms.term_counts(df, "t", 3).collect()} == {t: (n, docs[t]) for t, n in tf.items()}
    # the tokens are those of the column expression
    found = Counter(t for r in df.select(tx.tokens("t").alias("x")).collect() for t in r.x)
    assert found == plain(texts, 1)[0]
    assert [(r.item, r.n) for r in profile.frequent_words(df, "t", 4).collect()] == [t[:2] for t in first(texts, 4, 1)]


def test_vectors(spark):
    texts = ["one two two", "two three", "", None, "unknown words"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    features = active.TextFeatures(["one", "three", "two", "two two"], [1.0, 2.0, 3.0, 4.0], "t")
    got = {r.id: (r.features.indices, r.features["values"]) for r in features.transform(df).collect()}
    raw = [1.0, 3.0 * (math.log(2) + 1), 4.0]
    length = math.sqrt(sum(x * x for x in raw))
    assert got[0][0] == [0, 2, 3] and got[0][1] == pytest.approx([x / length for x in raw])
    assert got[1][0] == [1, 2] and got[2] == got[3] == got[4] == ([], [])


def test_word_count(spark):
    odd = ["", " ", "a", " a  b ", "a b c　d\u0085e f", "x​y\u001cz", None, "tab\tnew\nline\r\n end "]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    got = {r.t: (r.n, r.w) for r in df.select("t", tx.word_count("t").alias("n"), tx.words("t").alias("w")).collect()}
    assert all(n == (None if w is None else len(w)) for n, w in got.values())


def test_counts_of_many_texts_are_arrays(spark, monkeypatch):
    """Tokens and pairs are counted as numbers, round by round, with few tokens numbered at a time; all counts hold."""
    monkeypatch.setattr(terms, "TOKENS_AT_ONCE", 50)
    monkeypatch.setattr(terms, "NUMBERED", 20)
    texts = corpus(120, 60, 2, 4)
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    tf, docs = plain(texts)
    assert {r.term: (r.tf, r.df) for r in terms.term_counts(df, "t", 2).collect()} == {t: (n, docs[t]) for t, n in tf.items()}
    assert [tuple(r) for r in terms.frequent_terms(df, "t", 9, 2, 200).collect()] == first(texts, 9)
