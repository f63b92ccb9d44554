"""Quality rules as a bitmask ledger.

One pass measures every text and evaluates every rule; the ledger holds the
measurements and one bit per failed rule. Policies are versioned masks over
those bits, so judging a corpus under another policy, or asking what a policy
would keep without one of its rules, reads the ledger and no text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm import words as W
from tablewright.session import cut_lineage

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[0x41:0x5B] = True
LETTER = UPPER.copy()
LETTER[0x61:0x7B] = True
LETTER[0x80:] = True
EXCLAIM = np.zeros(256, dtype=bool)
EXCLAIM[0x21] = True
# the first byte of every character of a word
CHARACTER = W.NOT_BLANK.copy()
CHARACTER[0x80:0xC0] = False
# the first byte of every letter, taking all characters beyond ASCII for letters
LETTER_FIRST = LETTER & CHARACTER

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_upper", "n_letters", "n_exclaim",
]


def _repeat_words(hashes: np.ndarray, of: np.ndarray, size: int = 3) -> np.ndarray:
    """Words per text that lie in a run of ``size`` words found twice or more in that text."""
    whole = W.whole_runs(of, size)
    at = np.flatnonzero(whole)
    text = np.searchsorted(of, at, side="right").astype(np.uint64)
    keys = W.mix(W.run_hashes(hashes, size)[at] + text * np.uint64(W.SECOND))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marks = np.zeros(int(of[-1]), dtype=bool)
    marks[at[twice]] = True
    return W.sums(W.spread(marks, size, len(marks)), of)


def _lines(raw: bytes) -> tuple[int, int]:
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def measure(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Measurements of every text, one row each; NULL has no words, lines or characters."""
    keep = list(keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.slices(batch.column(len(keep))):
                data, bounds = piece.data, piece.bounds
                found = W.find_words(data, bounds, W.NOT_BLANK)
                hashes = W.word_hashes(data, found)
                raw = data.tobytes()
                lines = np.array([_lines(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], dtype=np.int64)
                values = {
                    "n_words": np.diff(found.of), "word_chars": W.sums(CHARACTER[data], bounds),
                    "n_symbols": W.sums(SYMBOLS[data], bounds), "n_dup_lines": lines[:, 1],
                    "n_repeat_words": _repeat_words(hashes, found.of), "n_lines": lines[:, 0],
                    "n_upper": W.sums(UPPER[data], bounds), "n_letters": W.sums(LETTER_FIRST[data], bounds),
                    "n_exclaim": W.sums(EXCLAIM[data], bounds),
                }
                own = batch.slice(piece.first, piece.last - piece.first)
                yield pa.RecordBatch.from_arrays(
                    [own.column(i) for i in range(len(keep))]
                    + [pa.array(values[m].astype(np.int64)) for m in MEASURES], [*keep, *MEASURES],
                )

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return docs.select(*[F.col(c) for c in keep], F.col(text)).mapInArrow(
        work, ", ".join([*fields, *[f"{m} bigint" for m in MEASURES]])
    )


class Rule(NamedTuple):
    """A rule's name and the condition under which a text fails it; its place in the list is its bit."""

    name: str
    fails: str


# whole numbers on both sides, so that every engine decides alike
RULES = [
    Rule("short", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("shouting", "10 * n_upper > 3 * n_letters"),
    Rule("exclaiming", "5 * n_exclaim > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("few_letters", "2 * n_letters < word_chars"),
]


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    known = {r.name: 1 << i for i, r in enumerate(rules)}
    return sum(known[n] for n in names)


class Policy(NamedTuple):
    """Rules that reject at once, and rules of which more than ``allowed`` failures reject."""

    version: str
    strict: tuple[str, ...]
    lenient: tuple[str, ...] = ()
    allowed: int = 0


POLICIES = [
    Policy("base", ("short", "repeated_words")),
    Policy("lenient", ("short", "repeated_words"), tuple(r.name for r in RULES[2:]), 1),
    Policy("production", tuple(r.name for r in RULES)),
]


def ledger(
    docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Stored table of measurements and failure bits, one row per row of ``docs``.

    A NULL or empty text measures zero everywhere and fails the rules that zero
    fails. Repeated rows and NULL ids each have their row.
    """
    bits = F.lit(0).cast("bigint")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    return cut_lineage(measure(docs, text, keep).withColumn("failed", bits))


def kept_by(policy: Policy, rules: Sequence[Rule] = RULES, without: int = 0, failed: str = "failed") -> Column:
    """Does a row of the ledger pass ``policy``, the rules of the bit mask ``without`` left out?"""
    strict = F.lit(mask(policy.strict, rules) & ~without).cast("bigint")
    lenient = F.lit(mask(policy.lenient, rules) & ~without).cast("bigint")
    return (F.col(failed).bitwiseAND(strict) == 0) & (
        F.bit_count(F.col(failed).bitwiseAND(lenient)) <= policy.allowed
    )


def ablations(book: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows kept by every policy, as it is (``without`` NULL) and without each of its rules.

    The ledger is counted by its bit patterns first, at most one row per set of rules.
    """
    patterns = book.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        (p.version, name, kept_by(p, rules, mask([name], rules) if name else 0))
        for p in policies for name in (None, *p.strict, *p.lenient)
    ]
    sums = patterns.agg(*[F.coalesce(F.sum(F.when(k, F.col("n"))), F.lit(0)).alias(f"k{i}") for i, (_, _, k) in enumerate(cases)])
    rows = F.array(*[
        F.struct(F.lit(v).alias("policy"), F.lit(name).cast("string").alias("without"), F.col(f"k{i}").alias("kept"))
        for i, (v, name, _) in enumerate(cases)
    ])
    return sums.select(F.inline(rows))


def verdicts(book: DataFrame, policy: Policy = POLICIES[-1], rules: Sequence[Rule] = RULES) -> DataFrame:
    return book.withColumn("kept", kept_by(policy, rules))
