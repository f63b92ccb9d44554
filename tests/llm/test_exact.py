"""Operators with an exact answer, next to brute force."""

import hashlib
import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus  # noqa: E402

from tablewright.llm import components, ledger, linedup, lzparse, mixing, simhash, winnowing  # noqa: E402


def sha(words):
    return hashlib.sha256(b" ".join(words)).hexdigest()


def split(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def fingerprint(text):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in split(text)]
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark):
    given = [r for r in corpus.rows() if len(r[1] or "") < 50_000]
    got = sorted(
        ((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(corpus.documents(spark, given)).collect()),
        key=repr,
    )
    fps = [fingerprint(r[1]) for r in given]
    group = list(range(len(given)))
    for _ in given:
        for a in range(len(given)):
            for b in range(len(given)):
                if (fps[a] ^ fps[b]).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    least = defaultdict(list)
    for r, g in zip(given, group):
        if r[0] is not None:
            least[g].append(r[0])
    want = sorted(((r[0], f"{f:016x}", min(least[g], default=None)) for r, f, g in zip(given, fps, group)), key=repr)
    assert got == want


def test_representatives(spark):
    given = [r for r in corpus.rows() if len(r[1] or "") < 50_000] + [(9, None, None, None, None, *["x"] * 8)]
    docs = corpus.documents(spark, given)
    key = lambda t: hashlib.sha256((t or "").encode()).digest()[:16]
    fps = {(r[0], key(r[1])): fingerprint(r[1]) for r in given}
    group = {d: d for d in fps}
    order = lambda d: (d[0] is None, d[0] or 0, d[1])
    for _ in fps:
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b], key=order)
    want = Counter((r[0], key(r[1]), group[(r[0], key(r[1]))] == (r[0], key(r[1]))) for r in given)
    got = Counter((r._id, bytes(r._key), r.stays) for r in simhash.representatives(docs).collect())
    assert got == want and simhash.representatives(docs.limit(0)).count() == 0


def test_links_within_large_postings(spark):
    """Chains, bits in one or two bytes, and many fingerprints with six equal bytes."""
    values = {0, 1, 3, 1 << 63, (1 << 63) | 1, 0xFF00, 0x0101 << 40}
    values |= {0xABCD << 32 | v for v in range(0, 600, 3)} | {0x77 << 56 | 1 << b for b in range(64)}
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    for distance in (1, 2):
        edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), distance)
        root = {r.node: r.root for r in components.components(edges).collect()}
        group = {v: v for v in signed}
        for _ in range(40):
            for a in signed:
                for b in signed:
                    if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance:
                        group[a] = group[b] = min(group[a], group[b])
        assert {v: root.get(v, v) for v in signed} == group


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7), (200, 150), (300, 150), (150, 149)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "src bigint, dst bigint")).collect()}
    want = {i: 0 for i in range(1, 51)} | {101: 100, 150: 149, 200: 149, 300: 149}
    assert got == want
    assert components.components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_ledger(spark):
    got = Counter(
        tuple(r) for r in ledger.measure(corpus.documents(spark)).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
        ).collect()
    )
    want = Counter()
    for row in corpus.rows():
        text = row[1] or ""
        w = split(text)
        grams = Counter(zip(w, w[1:], w[2:]))
        cover = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if split(x)]
        want[(
            row[0], len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(cover),
        )] += 1
    assert got == want


def test_policies_and_ablations(spark):
    junk = [(1, "good words only here " * 30), (2, "### $$$ " * 60), (3, "SHOUT! " * 70), (4, "too short"), (5, None)]
    docs = spark.createDataFrame(
        [(i, " ".join(f"{w}{k}" if i in (1, 2, 3) else w for k, w in enumerate((t or "").split())) or None) for i, t in junk],
        "doc_id bigint, text string",
    )
    book = ledger.ledger(docs)
    kept = {r.doc_id: r.kept for r in ledger.verdicts(book).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False}
    rows = {(r.policy, r.without): r.kept for r in ledger.ablations(book).collect()}
    for policy in ledger.POLICIES:
        for without in (None, *policy.strict, *policy.lenient):
            bits = ledger.mask([without]) if without else 0
            assert rows[(policy.version, without)] == book.where(ledger.kept_by(policy, without=bits)).count()
    assert ledger.ablations(ledger.ledger(docs.limit(0))).agg(F.sum("kept")).first()[0] == 0


ITEMS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from all of it"),
    (2, "Only Four Words Here"), (3, None), (4, "..."), (5, "one"),
    (6, "the quick brown fox jumps over the lazy dog and then it stops for good"), (None, "a b c d e f g h i j k"),
    (2, "Only Four Words Here"),
]
MARKED = [
    (1, "xx THE QUICK brown-fox jumps over the lazy dog and runs; away from"), (2, "only four words here only four"),
    (3, "nothing at all"), (4, None), (5, ""), (6, "the one and only four words here"), (None, "a b c d e f g h i j k l"),
    (7, "the quick brown fox jumps over the lazy dog and"), (7, "the quick brown fox"), (8, "one " * 3000),
]


def test_benchmark_hits(spark):
    pattern = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: pattern.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
    windows = defaultdict(set)
    for i, t in ITEMS:
        w = lower(t)
        for j in range(len(w) - min(10, len(w)) + 1):
            if w:
                windows[tuple(w[j:j + min(10, len(w))])].add(i)
    want = Counter()
    given = MARKED + [(r[0], r[1]) for r in corpus.rows()]
    for i, t in given:
        w, cover, items = lower(t), set(), set()
        for size in {len(k) for k in windows}:
            for j in range(len(w) - size + 1):
                if tuple(w[j:j + size]) in windows:
                    cover |= set(range(j, j + size))
                    items |= windows[tuple(w[j:j + size])]
        want[(i, len(w), len(cover), tuple(sorted(str(x) for x in items if x is not None)))] += 1
    docs = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in winnowing.benchmark_hits(docs, items).collect())
    assert got == want
    none = winnowing.benchmark_hits(docs, items.limit(0)).agg(F.sum("n_hit"), F.count("*")).first()
    assert tuple(none) == (0, len(given))
    assert winnowing.benchmark_hits(docs.limit(0), items).count() == 0


def test_repeated_passages(spark):
    given = corpus.rows()
    counts, cut = Counter(), [split(r[1]) for r in given]
    for w in cut:
        counts.update(tuple(w[j:j + 35]) for j in range(len(w) - 34))
    want = Counter()
    for row, w in zip(given, cut):
        cover = {j + k for j in range(len(w) - 34) if counts[tuple(w[j:j + 35])] > 1 for k in range(35)}
        want[(row[0], len(w), len(cover), sha([x for i, x in enumerate(w) if i not in cover]))] += 1
    found = lzparse.repeated_passages(corpus.documents(spark)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == want
    words_of = {(row[0], len(w)): w for row, w in zip(given, cut)}
    by_row = {r.row: words_of[(r.doc_id, r.n_words)] for r in found}
    assert len(by_row) == len(given)
    for r in found:
        # the factors tell the removed words, and the kept text is what its digest says
        assert len({w for f in r.factors for w in range(f.start, f.start + f.words)}) == r.n_removed
        assert not r.factors or hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        for f in r.factors:
            # each is a piece of its block, and not the same place
            assert f.words >= 35 and by_row[r.row][f.start:f.start + f.words] == by_row[f.block][f["at"]:f["at"] + f.words]
            assert (f.block, f["at"]) != (r.row, f.start)
    assert sum(len(r.factors) for r in found) > 10
    assert lzparse.repeated_passages(corpus.documents(spark, [])).count() == 0


def test_factors_check_the_next_run_at_each_boundary():
    import numpy as np

    starts, blocks = np.array([0, 1, 2, 3, 9, 10]), np.array([7, 7, 8, 8, 8, 8])
    at = np.array([4, 5, 20, 21, 30, 40])
    # a factor ends with its block, where that goes on elsewhere, and where a run stands nowhere else
    assert lzparse.factors(starts, blocks, at, 5) == [(0, 6, 7, 4), (2, 6, 8, 20), (9, 5, 8, 30), (10, 5, 8, 40)]
    assert lzparse.factors(starts[:0], blocks[:0], at[:0], 5) == []


def test_places_tell_text_and_word():
    import numpy as np

    sizes = [0, 1, 34, 35, 0, 63, 64, 2**15 - 1, 2**15, 2**20, 3, 2**30, 64]
    seen = {}
    for task in (0, 1, 2**22 - 1):
        places = lzparse.Places(task)
        for given in (sizes, sizes[::-1], []):
            n = np.array(given, dtype=np.int64)
            for row, words in zip(places.of(n).tolist(), given):
                # the places of a text's words and the one after them are its own
                for word in {0, words // 2, max(0, words - 1), words}:
                    place = np.array([row + word], dtype=np.int64)
                    if word < max(1, words):
                        assert lzparse.word_of(place)[0] == word
                        assert seen.setdefault(row + word, (task, row, word)) == (task, row, word)
                    else:
                        assert row + word not in seen
    assert len({k for k in seen.values()}) == len(seen)
    assert len({(task, row) for task, row, _ in seen.values()}) == 3 * 2 * len(sizes)
    with pytest.raises(ValueError):
        lzparse.Places(2**22)
    with pytest.raises(ValueError):
        lzparse.Places(0).of(np.full(200, 2**30))


def heap_quotas(votes, seats):
    import heapq

    quota, heap = dict.fromkeys(votes, 0), [(-v, k) for k, v in votes.items() if v > 0]
    heapq.heapify(heap)
    for _ in range(seats):
        _, k = heapq.heappop(heap)
        quota[k] += 1
        heapq.heappush(heap, (-votes[k] / (2 * quota[k] + 1), k))
    return quota


def test_mix(spark):
    given = corpus.rows()
    docs = corpus.documents(spark, given)
    for block, shard in ((4, 64), (32, 4096), (1, 100_000)):
        mix = mixing.mix(docs, block=block, shard=shard)
        sources = {r.source: r for r in mix.sources.collect()}
        sizes = Counter()
        for r in given:
            sizes[r[3]] += len(split(r[1]))
        order = sorted((s for s in sizes if s is not None)) + [None]
        weight = {s: 1 + i % 3 for i, s in enumerate(order)}
        target, rest, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
        while rest > 1e-9:
            share, rest = rest / sum(weight[s] for s in open_), 0.0
            for s in list(open_):
                target[s] += share * weight[s]
                if target[s] > 3 * sizes[s]:
                    rest += target[s] - 3 * sizes[s]
                    target[s] = 3.0 * sizes[s]
                    open_.discard(s)
        assert {s: r.target for s, r in sources.items()} == pytest.approx(target)
        votes = {r["rank"]: r.votes for r in sources.values()}
        assert {r["rank"]: r.quota for r in sources.values()} == heap_quotas(votes, round(sum(votes.values())))
        per_shard = Counter()
        for r in mix.shards.collect():
            per_shard[r["rank"]] += r.quota
        assert all(per_shard[r["rank"]] == r.quota for r in sources.values())
        found = mix.documents.collect()
        assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], len(split(r[1]))) for r in given)
        taken = Counter()
        for r in found:
            assert 0 <= r.taken <= 3 * r["size"]
            taken[r.source] += r.taken
        for s in order:
            assert abs(taken[s] - target[s]) <= 1.5 * block + 3
        again = mixing.mix(docs.repartition(5), block=block, shard=shard).documents.collect()
        assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    assert mixing.mix(corpus.documents(spark, [])).documents.count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(blank).documents.collect()] == [(0, 0.0, 0)] * 2


def test_mix_stays_in_the_jvm(spark):
    plan = mixing.mix(corpus.documents(spark)).documents._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_patience():
    assert linedup.patience("abcd", "abcd") == [(i, i) for i in range(4)]
    assert linedup.patience("xaby", "pabq") == [(1, 1), (2, 2)]
    assert linedup.patience("", "a") == [] == linedup.patience("a", "b")
    # items that occur twice don't anchor, but match next to what does
    assert linedup.patience("zazb", "yazb") == [(1, 1), (2, 2), (3, 3)]
    assert len(linedup.patience("abcdef", "defabc")) == 3
    assert linedup.common_blocks([(0, 0), (1, 1), (3, 2)]) == [(0, 0, 2), (3, 2, 1)]


def common_runs(early, late, least=linedup.MIN_WORDS):
    """Lines of ``late`` in runs that ``early`` holds as well, by all pairs of places."""
    gone = set()
    for i in range(len(late)):
        for j in range(len(early)):
            if late[i] == early[j] and (i == 0 or j == 0 or late[i - 1] != early[j - 1]):
                n = 0
                while i + n < len(late) and j + n < len(early) and late[i + n] == early[j + n]:
                    n += 1
                if sum(len(split(x)) for x in late[i:i + n]) >= least:
                    gone |= set(range(i, i + n))
    return gone


def lines_by_hand(given):
    """Lines that each row loses to any earlier document."""
    key = lambda t: hashlib.sha256((t or "").encode()).digest()[:16]
    documents = {(r[0], key(r[1])): (r[1] or "").split("\n") for r in given}
    out = []
    for row in given:
        own, gone = (row[0], key(row[1])), set()
        for other, lines in documents.items():
            if other[0] is not None and (own[0] is None or other < own):
                gone |= common_runs(lines, documents[own])
        out.append(gone)
    return out


def test_line_dedup(spark):
    given = corpus.rows()
    got = Counter(
        (r.doc_id, r.text, r.n_deleted, r.row) for r in linedup.without_repeated_lines(corpus.documents(spark)).collect()
    )
    want = Counter()
    for row, gone in zip(given, lines_by_hand(given)):
        rest = "\n".join(x for n, x in enumerate((row[1] or "").split("\n")) if n not in gone) if gone else row[1]
        want[(row[0], rest, len(gone), row[5])] += 1
    assert got == want
    assert sum(n for (_, _, lost, _), n in want.items() if lost) >= 5
    assert linedup.without_repeated_lines(corpus.documents(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_over_all_earlier_documents(spark, seed):
    """Short lines, blank ones, crossing order and repeats, next to all pairs of documents; alignments stay within."""
    pick = random.Random(seed)
    lines = ["", " ", "a", "b b", "c c c", "d d d d", "one two three four five six", "e1 e2 e3 e4 e5 e6 e7", "f f f f f"]
    given = [(i, "\n".join(pick.choice(lines) for _ in range(pick.randrange(1, 12)))) for i in range(60)]
    given += [(5, "\n".join(lines)), (None, "\n".join(lines[3:])), given[7], (61, None), (62, "")]
    docs = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    got = Counter((r.doc_id, r.text, r.n_deleted) for r in linedup.without_repeated_lines(docs).collect())
    want = Counter()
    for (i, text), gone in zip(given, lines_by_hand(given)):
        rest = "\n".join(x for n, x in enumerate((text or "").split("\n")) if n not in gone) if gone else text
        want[(i, rest, len(gone))] += 1
    assert got == want
    for (_, a), (_, b) in [(x, y) for x in given[:25] for y in given[25:50]]:
        early, late = a.split("\n"), b.split("\n")
        for _, j, n in linedup.common_blocks(linedup.patience(early, late)):
            if sum(len(split(x)) for x in late[j:j + n]) >= linedup.MIN_WORDS:
                assert set(range(j, j + n)) <= common_runs(early, late)


def test_meeting_runs():
    assert [tuple(map(int, r)) for r in zip(*linedup.meeting_runs([2, 0, 3, 7, 1, 4, 1, 2], 6))] == [
        (0, 4), (1, 4), (2, 4), (3, 4), (3, 5), (3, 6), (4, 7), (5, 8)
    ]
    assert [len(x) for x in linedup.meeting_runs([], 6)] == [0, 0] and [len(x) for x in linedup.meeting_runs([5], 6)] == [0, 0]
    pick = random.Random(1)
    for _ in range(300):
        sizes = [pick.randrange(8) for _ in range(pick.randrange(12))]
        runs = set(zip(*(x.tolist() for x in linedup.meeting_runs(sizes, 6))))
        assert all(sum(sizes[a:b]) >= 6 for a, b in runs) and len(runs) <= 2 * len(sizes)
        for a in range(len(sizes)):
            for b in range(a + 1, len(sizes) + 1):
                if sum(sizes[a:b]) >= 6:
                    inside = [r for r in runs if a <= r[0] and r[1] <= b]
                    assert {x for r in inside for x in range(*r)} == set(range(a, b))


def test_a_line_of_very_many_documents_gives_few_pairs(spark):
    """A line that thousands repeat, in places that no alignment reaches: pairs stay in proportion."""
    hot = "the very same line of more than six words"
    rows = [(i, f"{hot}\nown {i}\n{hot}\n{hot if i % 2 else 'x'}\ntail {i % 50}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    keyed = docs.select(F.col("doc_id").alias("_id"), F.md5("text").alias("_key"), "text")
    found = linedup._line_lists(keyed, ["_id", "_key"], "text", 6).withColumn("row", F.monotonically_increasing_id())
    held = linedup.held_before(found)
    assert held.select("row", "first_row").distinct().count() <= 2 * len(rows)
    assert held.count() <= 9 * len(rows)
    out = linedup.without_repeated_lines(docs)
    assert out.where(F.col("doc_id") > 0).where(F.contains("text", F.lit(hot))).count() == 0


def lost_lines(spark, given):
    docs = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    return {r.doc_id: r.n_deleted for r in linedup.without_repeated_lines(docs).collect()}


def test_line_dedup_of_short_lines(spark):
    """Documents of lines under six words meet on runs of lines, not on single ones."""
    verse = "roses are red\n\nviolets are blue\nsugar is sweet"
    assert lost_lines(spark, [
        (1, verse), (2, verse), (3, "a title\n" + verse + "\nits end"), (4, "sugar is sweet\nroses are red\nwell"),
    ]) == {1: 0, 2: 4, 3: 4, 4: 0}


def test_line_dedup_tries_further_holders(spark):
    """Lines that the first holder doesn't align, for crossing order or repeats, go by another one."""
    one, two, many = (" ".join(corpus.words(8, f"further{i}")) for i in range(3))
    others = [(10 + i, f"own {i}\n{many}\nend {i}") for i in range(20)]
    assert lost_lines(spark, [
        (1, f"{one}\n{two}"), (2, f"start\n{one}\nend"), (3, f"a\n{two}\nb\n{one}\nc"),
        (4, f"x\n{many}\ny"), *others, (90, f"one\n{many}\ntwo\n{many}\nend 7"),
    ]) == {1: 0, 2: 1, 3: 2, 4: 0, **{i: 1 for i, _ in others}, 90: 3}


def test_line_dedup_takes_short_lines_next_to_others(spark):
    """A short line goes with the long one that it follows in an earlier document, whichever came first of all."""
    long = " ".join(corpus.words(7, "long"))
    rows = [(1, long), (2, f"{long}\nshort tail"), (3, f"x\n{long}\nshort tail\ny")]
    assert lost_lines(spark, rows) == {1: 0, 2: 1, 3: 2}
    assert lost_lines(spark, rows[1:]) == {2: 0, 3: 2}
