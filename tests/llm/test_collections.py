"""Merkle manifest, exact dedup and conversation trie next to brute force."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus  # noqa: E402

from tablewright.llm import exact, merkle, order, trie  # noqa: E402


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def blanks(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


COPIES = [
    (50, "a  b\tc"), (51, "a b c"), (52, "a\n\nb c"), (53, " a b c"), (54, ""), (55, None), (56, "  "), (57, "\t"),
    (None, "a b c"), (None, "without id"), (None, "without id"), (60, "same row"), (60, "same row"), (61, "same row"),
    (62, "é x"), (63, "é x"), (64, "long " * 200_000), (65, "long\n" * 200_000),
]


def copied(spark):
    return corpus.documents(spark, corpus.rows() + [(i, t, None, None, None, *["x"] * 8) for i, t in COPIES])


def test_exact_groups(spark):
    docs = copied(spark)
    got = exact.exact_groups(docs).collect()
    groups = defaultdict(list)
    given = [(r.doc_id, blanks(r.text)) for r in docs.collect()]
    for i, t in given:
        groups[t].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = Counter((i, least[t], len(groups[t]), sha(t)) for i, t in given)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert kept == {sha(t): 1 for t in groups}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_without_copies(spark):
    docs = copied(spark)
    got = exact.without_copies(docs)
    assert got.schema == docs.schema
    rows = got.collect()
    keep = {r.text_sha256: r.keep_id for r in exact.exact_groups(docs).collect()}
    assert {sha(blanks(r.text)): r.doc_id for r in rows} == keep and len(rows) == len(keep)
    whole = {tuple(r) for r in docs.collect()}
    assert all(tuple(r) in whole for r in rows)
    assert exact.exact_groups(docs.limit(0)).count() == 0 and exact.without_copies(docs.limit(0)).count() == 0


def test_bit_field_only_filters(spark, monkeypatch):
    """With a field of 16 positions everything may be repeated, and the result stays."""
    docs = copied(spark)
    want = sorted(map(tuple, exact.exact_groups(docs).collect()), key=repr)
    monkeypatch.setattr(exact, "field_bits", lambda rows: 4)
    assert sorted(map(tuple, exact.exact_groups(docs).collect()), key=repr) == want
    rows = spark.range(20_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    twice = rows.unionByName(rows.limit(500))
    marked = exact.possibly_repeated(twice, exact.taken_twice(twice, 18), 18, "maybe")
    n, known = marked.agg(F.count_if("maybe"), F.count_if(F.col("maybe"))).first()
    assert 1000 <= n == known < 2500


def test_exact_dedup_is_native(spark):
    plans = []
    for df in (exact.exact_groups(copied(spark)), exact.without_copies(copied(spark))):
        df.count()
        plans.append(df._jdf.queryExecution().toString())
    assert not any(re.search("Python|Arrow|Pandas|ExternalRDD|MapElements", p) for p in plans)


def tree_levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(levels, at):
    path = []
    for nodes in levels[:-1]:
        first = at - at % 3
        path.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + 3])))
        at //= 3
    return path


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, row.text)))


def by_hand(rows):
    """Leaf, subroot, root and proof of all rows."""
    sources = defaultdict(list)
    for r in rows:
        sources[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf_of(r), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda x: x[:3])
        trees[s] = tree_levels([x[2] for x in sources[s]])
    top = tree_levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (_, _, leaf, r) in enumerate(sources[s]):
            out.append((r.doc_id, leaf, trees[s][-1][0], top[-1][0], tuple(siblings(trees[s], at) + siblings(top, k))))
    return out


def many_sources():
    pick = random.Random(3)
    rows = [(i, f"text {i}\n", "en", f"s{min(pick.randrange(9), 4)}", i, *["x"] * 8) for i in range(100, 260)]
    rows += [(1000 + i, "é" * i, None, s, None, *["x"] * 8) for i, s in enumerate(["", "ß", "z", "\U0001F600", "�", "one", None])]
    return corpus.rows() + rows


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(spark, levels):
    docs = corpus.documents(spark, many_sources())
    got = merkle.manifest(docs, carry={"pos": F.col("n_chars"), "proof_of": F.upper("lang")}, levels=levels).withColumn(
        "folded", merkle.fold(F.col("leaf"), F.col("proof"))
    ).withColumn("digest", merkle.proof_digest(F.col("proof"))).collect()
    want = by_hand(docs.collect())
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.proof))) for r in got) == Counter(want)
    assert all(r.folded == r.root for r in got)
    assert all(r.digest == sha("".join(a + b for a, b in r.proof)) for r in got)
    carried = Counter((r.doc_id, r.n_chars, r.lang and r.lang.upper()) for r in docs.collect())
    assert Counter((r.doc_id, r.pos, r.proof_of) for r in got) == carried


def test_manifest_small(spark):
    docs = corpus.documents(spark, [corpus.rows()[0]])
    row = merkle.manifest(docs).first()
    assert row.leaf == row.subroot == row.root and row.proof == []
    assert merkle.manifest(docs.limit(0)).count() == 0
    only = corpus.documents(spark, [(i, str(i), None, None, 1, *["x"] * 8) for i in range(4)])
    assert {len(r.proof) for r in merkle.manifest(only).collect()} == {2}


def test_manifest_shows_changes(spark):
    docs = corpus.documents(spark, many_sources())
    claimed = merkle.leaf_digest([F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in merkle.FIELDS])
    got = merkle.manifest(docs, carry={"claimed": claimed}).withColumn(
        "same", merkle.fold(F.col("claimed"), F.col("proof")) == F.col("root")
    )
    changed = Counter(r.doc_id for r in docs.collect() if "\n" in (r.text or ""))
    assert Counter(r.doc_id for r in got.where("NOT same").collect()) == changed


def test_verify(spark, tmp_path):
    docs = corpus.documents(spark, many_sources())
    merkle.manifest(docs).write.parquet(str(tmp_path / "manifest"))
    known = spark.read.parquet(str(tmp_path / "manifest"))
    same = merkle.verify(docs.repartition(7), known)
    assert same.where("expected <> present OR verified <> present").count() == 0
    assert same.agg(F.sum("verified")).first()[0] == docs.count()
    changed = docs.where("doc_id IS NULL OR doc_id <> 101").withColumn(
        "n_chars", F.when(F.col("doc_id") == 102, -1).otherwise(F.col("n_chars"))
    ).unionByName(docs.where("doc_id IN (103, 104)")).withColumn("doc_id", F.when(F.col("doc_id") == 104, 9999).otherwise(F.col("doc_id")))
    got = {r.doc_id: (r.expected, r.present, r.verified) for r in merkle.verify(changed, known).where(
        "expected <> present OR verified <> present").collect()}
    assert got == {101: (1, 0, 0), 102: (1, 1, 0), 103: (1, 2, 1), 104: (1, 0, 0), 9999: (0, 2, 0)}
    forged = known.withColumn("root", F.when(F.col("doc_id") == 105, "0").otherwise(F.col("root")))
    assert [r.doc_id for r in merkle.verify(docs, forged).where("verified < present").collect()] == [105]


def test_sweep():
    for n in (1, 2, 3, 4, 9, 10, 27, 28):
        leaves = [sha(str(i)) for i in range(n)]
        levels = merkle.sweep(leaves, 3)
        whole = tree_levels(leaves)
        end = merkle.alone_at(levels) if n <= 27 else 3
        assert levels[:end + 1] == whole[:end + 1]
        if n <= 27:
            assert [p for p in merkle.proofs(levels[:end + 1], [])] == [siblings(whole, i) for i in range(n)]


CHATS = [
    (0, 1, "user", "hello there"), (0, 2, "bot", "one two three"), (0, 3, "user", "bye"),
    (1, 1, "user", "hello there"), (1, 2, "bot", "one two three"), (1, 3, "user", "bye"), (1, 4, "bot", ""),
    (2, 1, "user", "hello there"), (2, 2, "bot", "other"), (2, None, None, None), (3, 5, None, None), (3, 5, "", None),
    (4, 1, "user", "hello there"), (4, 2, "bot", "one two three"), (45, 1, "x", "y z"), (46, 1, "x", "y z"), (47, 9, "u", "v"),
    (-5, 1, "user", "hello there"), (-5, 2, "bot", "w " * 5000), (None, 1, "user", "nobody"), (60, 1, "a", "bc"), (61, 1, "ab", "c"),
] + [(100 + i, t, "user" if t % 2 else "bot", f"turn {min(t, 3 + i // 7)} of {i % 3 if t > 4 else 0}") for i in range(40) for t in range(i % 11)]


def chats(spark, given):
    kind = T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("depth", T.StringType()), T.StructField("a", T.StringType()),
        T.StructField("conv", T.StringType()), T.StructField("_slice", T.StringType()),
    ])
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in given], kind).repartition(3)


def crc(i):
    return zlib.crc32(str(i).encode())


def trie_by_hand(given, h=lambda c: crc(c) % 4):
    own = defaultdict(list)
    for c, turn, role, text in given:
        if c is not None:
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    base = lambda c: c - (abs(c) % 20 * (1 if c >= 0 else -1))
    made = {c: turns.get(base(c), [])[:h(c)] + t[h(c):] for c, t in turns.items()}
    nodes = defaultdict(list)
    for c, s in made.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    out = []
    for p, ids in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        leaf = lambda q: not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in nodes)
        out.append((
            min(ids), len(p), min(nodes[p[:-1]]) if p else None, len(ids),
            sum(len(q) == len(p) + 1 for q in below), sum(leaf(q) for q in below),
            sum((len(nodes[q]) - 1) * words(q) for q in below), sha(",".join(map(str, sorted(c for c in ids if len(made[c]) == len(p))))),
        ))
    return sorted(out, key=repr)


def rebuilt(spark, given):
    placed = trie.in_order(trie.turns(chats(spark, given)))
    return trie.with_openings(placed, 20, 3, F.crc32(F.col("conv").cast("string")) % 4)


@pytest.mark.parametrize("seed", [None, 1, 2])
def test_prefix_trie(spark, seed):
    given = CHATS
    if seed:
        pick = random.Random(seed)
        given = [(c, t, "u", f"w{pick.randrange(2)} " * pick.randrange(3)) for c in range(60) for t in range(pick.randrange(6))]
    got = trie.prefix_trie(*rebuilt(spark, given))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == trie_by_hand(given)


def test_last_turns(spark):
    convs, rows = rebuilt(spark, CHATS)
    got = trie.with_last_turns(trie.prefix_trie(convs, rows), rows, chats(spark, CHATS)).collect()
    turns = {(r.conv, r.depth): bytes(r.digest) for r in rows.collect()}
    assert len(got) == len(trie_by_hand(CHATS))
    for r in got:
        if r.depth == 0:
            assert r.role is None and r.text is None
        else:
            assert hashlib.sha256(f"{len(r.role.encode())}:{r.role}{r.text}".encode()).digest() == turns[(r.conv_id, r.depth)]


def test_prefix_trie_of_few(spark):
    assert trie.prefix_trie(*rebuilt(spark, [])).count() == 0
    assert trie.prefix_trie(*rebuilt(spark, [(None, 1, "a", "b")])).count() == 0
    # a conversation whose turns all give way to one that isn't there ends at the root
    lone = next(c for c in range(21, 400) if c % 20 and crc(c) % 4 == 3)
    got = [tuple(r) for r in trie.prefix_trie(*rebuilt(spark, [(lone, 1, "a", "b"), (lone, 2, "a", "b")])).collect()]
    assert got == [(lone, 0, None, 1, 0, 1, 0, sha(str(lone)))]


def test_one_conversation_over_all_slices(spark):
    given = [(0, t, "u", f"turn {t}") for t in range(3000)] + [(7, t, "u", f"turn {t}") for t in range(2500)]
    got = {(r.conv_id, r.depth): r for r in trie.prefix_trie(*rebuilt(spark, given)).collect()}
    assert len(got) == 3001 and all(got[(0, d)].n_convs == (2 if d <= 2500 else 1) for d in range(3001))
    assert got[(0, 0)].saved_tokens == 5000 and got[(0, 2500)].saved_tokens == 2 and got[(0, 2501)].saved_tokens == 0
    assert got[(0, 2500)].ends_sha256 == sha("7") and got[(0, 3000)].ends_sha256 == sha("0")


def test_running_over_slices(spark):
    pick = random.Random(5)
    rows = [("hot" if pick.random() < 0.6 else f"k{pick.randrange(9)}", i, pick.randrange(100)) for i in range(900)]
    pick.shuffle(rows)
    sliced = order.in_slices(spark.createDataFrame(rows, "k string, i int, v bigint"), ["k"], ["i"])
    got = order.running(sliced, ["k"], ["i"], {"total": ("sum", F.col("v")), "mark": ("xor", F.col("v"))}).collect()
    totals, marks, want = Counter(), Counter(), []
    for k, i, v in sorted(rows):
        totals[k] += v
        marks[k] ^= v
        want.append((k, i, v, totals[k], marks[k]))
    assert sorted(map(tuple, got)) == want
