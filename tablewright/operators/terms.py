"""Terms of texts: exact counts of all, the most frequent ones in bounded space, and vectors over them.

The most frequent terms are found with counters that merge. Each task keeps a
bounded number of them; when they run over, the same amount is taken off all
and those at zero go, so a count is too low by at most what was taken off in
total. The sum of that over the tasks bounds every count. Where no task took
anything off, the counts are exact. Else the terms whose bounds reach the last
place are counted again exactly; no other term can be among the first. Where
the bounds are too wide to prove that, all terms are counted.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.session import cut_lineage

TOKEN = re.compile(r"\w{2,}")  # letters, digits and underscores, as in functions.text
COUNTS = "term string, tf bigint, df bigint"
COUNTERS = 1 << 19  # terms a task keeps
HELD = 1 << 20  # terms a task holds before it hands on exact counts; shapes the plan only


def terms_of(text: str, max_n: int) -> list[str]:
    """Tokens of a lower-case text and their n-grams up to ``max_n``."""
    tokens = TOKEN.findall(text)
    grams = [map(" ".join, zip(*(tokens[i:] for i in range(n)))) for n in range(2, max_n + 1)]
    return list(chain(tokens, *grams))


class _Numbers(dict):
    """A number for every token, given when it is first asked for."""

    def __missing__(self, token: str) -> int:
        n = self[token] = len(self)
        return n


GRAM_BITS, TEXT_BITS = 31, 19  # of the second token in a key, and of a text beside a rank
NUMBERED = 1 << 20  # tokens whose numbers a task holds; shapes the plan only
TEXTS_AT_ONCE = 256  # texts a task turns into vectors at once; shapes the plan only
TOKENS_AT_ONCE = 1 << 17  # tokens a task sorts at once; shapes the plan only


def _grouped(keys: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys, ascending, with the sums of what belongs to each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), dtype=bool), keys[1:] != keys[:-1]]))
    return keys[first], *[np.add.reduceat(x[order], first) if len(first) else x for x in sums]


class _PairCounts:
    """Counts of tokens and of pairs of neighbours, as sorted arrays of token numbers.

    A key is ``first * 2**GRAM_BITS + second + 1``; a single token has no second.
    """

    def __init__(self, max_n: int):
        self.max_n = max_n
        self.numbers, self.waiting, self.size = _Numbers(), [], 0
        self.keys, self.tf, self.docs = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, text: str) -> None:
        tokens = TOKEN.findall(text)
        self.waiting.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens)))
        self.size += len(tokens)

    def full(self) -> bool:
        return self.size >= TOKENS_AT_ONCE or len(self.waiting) >= 1 << TEXT_BITS

    def crowded(self) -> bool:
        """Are more tokens numbered than a task should hold?"""
        return len(self.numbers) > NUMBERED

    def __len__(self) -> int:
        return len(self.keys)

    def settle(self) -> None:
        """Count what waits and add it to what is held."""
        if self.size:
            ids = np.concatenate(self.waiting)
            text = np.repeat(np.arange(len(self.waiting)), [len(x) for x in self.waiting])
            keys = [ids << GRAM_BITS]
            texts = [text]
            if self.max_n > 1:
                near = np.flatnonzero(text[1:] == text[:-1])
                keys.append((ids[near] << GRAM_BITS) + ids[near + 1] + 1)
                texts.append(text[near])
            keys, text = np.concatenate(keys), np.concatenate(texts)
            # numbers of the different keys, so that key and text fit one number that sorts fast
            different = np.unique(keys)
            both = np.searchsorted(different, keys) << TEXT_BITS | text
            both.sort()
            own = both >> TEXT_BITS
            tf = np.bincount(own, minlength=len(different))
            docs = np.bincount(own[np.concatenate([[True], both[1:] != both[:-1]])], minlength=len(different))
            self.keys, self.tf, self.docs = _grouped(
                np.concatenate([self.keys, different]), np.concatenate([self.tf, tf]), np.concatenate([self.docs, docs])
            )
        self.waiting, self.size = [], 0

    def keep(self, kept: np.ndarray) -> None:
        self.keys, self.tf, self.docs = self.keys[kept], self.tf[kept], self.docs[kept]

    def take_off(self, counters: int) -> int:
        """Take as much off all that ``counters`` at most are left, and tell how much."""
        cut = 0
        if len(self) > 2 * counters:
            at = len(self) - counters - 1
            cut = int(np.partition(self.tf, at)[at])
            self.tf = self.tf - cut
            self.keep(self.tf > 0)
        self.renumber()
        return cut

    def renumber(self) -> None:
        """Forget tokens that no held term has."""
        if not len(self.keys):
            self.numbers = _Numbers()
            return
        first, second = self.keys >> GRAM_BITS, self.keys & ((1 << GRAM_BITS) - 1)
        used = np.unique(np.concatenate([first, second[second > 0] - 1]))
        names = list(self.numbers)
        self.numbers = _Numbers((names[i], n) for n, i in enumerate(used.tolist()))
        again = np.searchsorted(used, first) << GRAM_BITS
        paired = second > 0
        again[paired] += np.searchsorted(used, second[paired] - 1) + 1
        order = np.argsort(again)
        self.keys, self.tf, self.docs = again[order], self.tf[order], self.docs[order]

    def rows(self) -> Iterator[pa.RecordBatch]:
        names = pa.array(list(self.numbers), pa.string())
        for at in range(0, max(1, len(self.keys)), 1 << 16):
            keys, part = self.keys[at:at + (1 << 16)], slice(at, at + (1 << 16))
            first, second = names.take(pa.array(keys >> GRAM_BITS)), (keys & ((1 << GRAM_BITS) - 1)) - 1
            alone = pa.array(second < 0)
            paired = pc.binary_join_element_wise(first, names.take(pa.array(np.maximum(second, 0))), " ")
            yield pa.RecordBatch.from_arrays(
                [pc.if_else(alone, first, paired), pa.array(self.tf[part], pa.int64()), pa.array(self.docs[part], pa.int64())],
                ["term", "tf", "df"],
            )

    def clear(self) -> None:
        self.keep(np.zeros(0, dtype=np.int64))
        self.numbers = _Numbers()


class _TermCounts:
    """The same for n-grams of any length, or for ``only`` some terms, as counters of strings."""

    def __init__(self, max_n: int, only: frozenset | None):
        self.max_n, self.only, self.tf, self.docs = max_n, only, Counter(), Counter()

    def __len__(self) -> int:
        return len(self.tf)

    def add(self, text: str) -> None:
        found = terms_of(text, self.max_n)
        if self.only is not None:
            found = [t for t in found if t in self.only]
        self.tf.update(found)
        self.docs.update(set(found))

    def full(self) -> bool:
        return True

    def crowded(self) -> bool:
        return False

    def settle(self) -> None:
        pass

    def take_off(self, counters: int) -> int:
        values = np.fromiter(self.tf.values(), dtype=np.int64, count=len(self))
        at = len(values) - counters - 1
        cut = int(np.partition(values, at)[at])
        for term, n in list(self.tf.items()):
            if n > cut:
                self.tf[term] = n - cut
            else:
                del self.tf[term], self.docs[term]
        return cut

    def rows(self) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([
            pa.array(list(self.tf), pa.string()), pa.array(list(self.tf.values()), pa.int64()),
            pa.array([self.docs.get(t, 0) for t in self.tf], pa.int64()),
        ], ["term", "tf", "df"])

    def clear(self) -> None:
        self.tf.clear()
        self.docs.clear()


class _HandedOn:
    """What to do with counters that run over: hand on exact counts and start anew."""

    def __init__(self, held: int):
        self.most = held

    def over(self, counts: _PairCounts | _TermCounts) -> Iterator[pa.RecordBatch]:
        yield from counts.rows()
        counts.clear()

    def last(self) -> Iterator[pa.RecordBatch]:
        yield from ()


class _TakenOff:
    """What to do with counters that run over: take the same off all, and tell how much in a row without a term."""

    def __init__(self, counters: int):
        self.counters, self.most, self.lost = counters, 2 * counters, 0

    def over(self, counts: _PairCounts | _TermCounts) -> Iterator[pa.RecordBatch]:
        self.lost += counts.take_off(self.counters)
        yield from ()

    def last(self) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.string()), pa.array([self.lost], pa.int64()), pa.array([0], pa.int64())], ["term", "tf", "df"]
        )


def _counted(df: DataFrame, text: str, max_n: int, keeper: Callable, only: frozenset | None = None) -> DataFrame:
    """Counts of every task, summed by term; ``keeper`` makes what deals with counters that run over."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = keeper()
        counts = _PairCounts(max_n) if only is None and max_n <= 2 else _TermCounts(max_n, only)
        for batch in batches:
            for body in batch.column(0):
                counts.add(body.as_py())
                if counts.full():
                    counts.settle()
                    if len(counts) > kept.most or counts.crowded():
                        yield from kept.over(counts)
        counts.settle()
        if len(counts) > kept.most:
            yield from kept.over(counts)
        yield from counts.rows()
        yield from kept.last()

    lowered = df.where(F.col(text).isNotNull()).select(F.lower(text))
    return lowered.mapInArrow(work, COUNTS).groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def term_counts(df: DataFrame, text: str, max_n: int = 2, only: Sequence[str] | None = None) -> DataFrame:
    """Frequency (``tf``) and number of texts (``df``) of every term, or of ``only`` some; combined before the shuffle."""
    return _counted(df, text, max_n, partial(_HandedOn, HELD), None if only is None else frozenset(only))


def bounded_counts(df: DataFrame, text: str, max_n: int = 2, counters: int = COUNTERS) -> tuple[DataFrame, int]:
    """Counts that are too low by at most the returned bound, of at most twice ``counters`` terms a task.

    A term that is missing has a frequency of at most the bound. With a bound
    of zero both counts are exact and no term is missing.
    """
    merged = cut_lineage(_counted(df, text, max_n, partial(_TakenOff, counters)))
    lost = merged.where("term IS NULL").agg(F.coalesce(F.sum("tf"), F.lit(0))).first()[0]
    return merged.where("term IS NOT NULL"), lost


def frequent_terms(
    df: DataFrame, text: str, k: int, max_n: int = 2, counters: int = COUNTERS
) -> DataFrame:
    """The ``k`` most frequent terms with both counts, exact; ties go to the first by name.

    Rows come in that order. Missing texts have no terms.
    """
    def first(counts: DataFrame) -> DataFrame:
        return counts.orderBy(F.desc("tf"), "term").limit(k)

    counts, lost = bounded_counts(df, text, max_n, counters)
    if lost == 0:
        return first(counts)
    least, found = first(counts).agg(F.min("tf"), F.count(F.lit(1))).first()
    if found == k and least > lost:
        # their number is bounded: each has more than least - lost of all occurrences
        rivals = counts.where(F.col("tf") + lost >= least).limit(counters + 1).select("term").collect()
        if len(rivals) <= counters:
            return first(term_counts(df, text, max_n, only=[r["term"] for r in rivals]))
    return first(term_counts(df, text, max_n))


def weighted_vectors(text: str, terms: Sequence[str], idf: Sequence[float], max_n: int = 2) -> Column:
    """Unit-length sparse vectors ``(indices, values)`` of sublinear frequency times ``idf``; a missing text has none."""
    place = {t: i for i, t in enumerate(terms)}
    weights = np.array(idf, dtype=float)
    # a term of one or two tokens is a pair of token numbers, 0 for none; tokens of no term have no number
    parts = [t.split(" ") for t in terms]
    known = {t: n for n, t in enumerate(sorted({t for p in parts for t in p}), 1)}
    coded = sorted((known[p[0]] << GRAM_BITS | (known[p[1]] if len(p) > 1 else 0), i) for i, p in enumerate(parts) if len(p) < 3)
    codes, order = (np.array([c[k] for c in coded], dtype=np.int64) for k in (0, 1))

    def placed(bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Text and place of every occurrence of a term."""
        if max_n > 2:
            found = [np.array([place[t] for t in terms_of(b, max_n) if t in place], dtype=np.int64) for b in bodies]
            return np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate(found)
        ids = []
        for body in bodies:
            tokens = TOKEN.findall(body)
            ids.append(np.fromiter(map(known.get, tokens, repeat(0)), np.int64, len(tokens)))
        of, ids = np.repeat(np.arange(len(ids)), [len(x) for x in ids]), np.concatenate(ids)
        near = np.flatnonzero((of[1:] == of[:-1]) & (ids[1:] > 0) & (ids[:-1] > 0)) if max_n > 1 else np.zeros(0, dtype=np.int64)
        own = np.concatenate([ids << GRAM_BITS, (ids[near] << GRAM_BITS) | ids[near + 1]])
        of = np.concatenate([of, of[near]])
        at = np.minimum(np.searchsorted(codes, own), max(0, len(codes) - 1))
        hit = np.flatnonzero(codes[at] == own) if len(codes) else np.zeros(0, dtype=np.int64)
        return of[hit], order[at[hit]]

    @F.arrow_udf("struct<indices:array<int>,values:array<double>>")
    def vectors(texts: pa.Array) -> pa.Array:
        lengths, indices, values = [], [np.zeros(0, dtype=np.int32)], [np.zeros(0)]
        for first in range(0, len(texts), TEXTS_AT_ONCE):
            bodies = [b or "" for b in texts[first:first + TEXTS_AT_ONCE].to_pylist()]
            of, at = placed(bodies)
            keys, n = np.unique(of * max(1, len(weights)) + at, return_counts=True)
            of, at = np.divmod(keys, max(1, len(weights)))
            own = (np.log(n) + 1.0) * weights[at]
            size = np.sqrt(np.bincount(of, own * own, len(bodies)))[of]
            indices.append(at.astype(np.int32))
            values.append(np.divide(own, size, out=own.copy(), where=size > 0))
            lengths.append(np.bincount(of, minlength=len(bodies)))
        ends = pa.array(np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, dtype=np.int64), *lengths]))]).astype(np.int32))
        return pa.StructArray.from_arrays([
            pa.ListArray.from_arrays(ends, pa.array(np.concatenate(indices))), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values))),
        ], ["indices", "values"])

    return vectors(F.lower(text))
