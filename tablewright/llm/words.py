"""Words, word hashes and hashes of word runs for whole Arrow batches of texts.

A batch is worked off in slices of a quarter of a megabyte of text, so the
arrays a task holds follow the slice (or one text, where that is longer), not
the batch.
All functions work on UTF-8 bytes; every byte of a character beyond ASCII
belongs to the class its caller gives to bytes from 0x80 on.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

# words are what stands between the six ASCII blanks
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False

# words of digits, letters and everything beyond ASCII
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

FIRST = 0x9E3779B97F4A7C15
SECOND = 0xD6E8FEB86659FD93
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


class Slice(NamedTuple):
    """Neighbouring texts of a batch: rows ``first`` to ``last``, their bytes and where each begins."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices of about ``limit`` bytes; NULL counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield Slice(first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


class Words(NamedTuple):
    """Words of a slice: byte ranges, and ``of[d]`` to ``of[d + 1]`` as the words of text ``d``."""

    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray


def find_words(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of bytes of the class ``inside``, never across two texts."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, np.zeros(len(bounds), dtype=np.int64))
    keep = inside[data]
    opens = keep.copy()
    opens[1:] &= ~keep[:-1]
    begin = bounds[:-1][bounds[:-1] < n]
    opens[begin] = keep[begin]
    closes = keep.copy()
    closes[:-1] &= ~keep[1:]
    end = bounds[1:][bounds[1:] > 0] - 1
    closes[end] = keep[end]
    starts = np.flatnonzero(opens)
    return Words(starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, bounds))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least ``n`` of each."""
    have = _TABLES.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)

        def grow(x: int) -> np.ndarray:
            out = np.full(size, x, dtype=np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        made = grow(base), grow(_inverse(base))
        if n > 4 * SLICE_BYTES:  # one very long text: not worth keeping
            return made
        have = _TABLES[base] = made
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for every range, from prefix sums."""
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def word_hashes(data: np.ndarray, words: Words, base: int = FIRST) -> np.ndarray:
    lengths = (words.ends - words.starts).astype(np.uint64)
    return mix(_range_hashes(data.astype(np.uint64), words.starts, words.ends, base) + lengths)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = SECOND) -> np.ndarray:
    """Hash of ``values[start:end]`` for every pair of bounds, whatever their distance."""
    return mix(_range_hashes(values, starts, ends, base) + (ends - starts).astype(np.uint64))


def run_hashes(hashes: np.ndarray, size: int, base: int = FIRST) -> np.ndarray:
    """Hash of the ``size`` words from each word on; runs across texts are the caller's to ignore."""
    n = max(0, len(hashes) - size + 1)
    at = np.arange(n)
    return mix(_range_hashes(hashes, at, at + size, base) + np.uint64(size))


def whole_runs(of: np.ndarray, size: int) -> np.ndarray:
    """For each run of ``size`` words of a slice: does it stay within one text?"""
    total = int(of[-1])
    n = max(0, total - size + 1)
    good = np.ones(n, dtype=bool)
    change = np.zeros(total + 1, dtype=np.int32)
    for edge in of[1:-1]:  # runs that start fewer than size words before an edge cross it
        change[max(0, edge - size + 1)] += 1
        change[edge] -= 1
    good &= np.cumsum(change)[:n] == 0
    return good


def slide(best, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (np.minimum, np.maximum, np.logical_or) of every ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    out, span = values, 1
    while span * 2 <= width:
        out = best(out[:-span], out[span:])
        span *= 2
    if span < width:
        out = best(out[:len(out) - (width - span)], out[width - span:])
    return out


def spread(marks: np.ndarray, width: int, size: int) -> np.ndarray:
    """Positions below ``size`` covered by runs of ``width`` that start at a mark."""
    change = np.zeros(size + width, dtype=np.int32)
    at = np.flatnonzero(marks)
    change[at] += 1
    change[at + width] -= 1
    return np.cumsum(change)[:size] > 0


def winnow(grams: np.ndarray, windows: np.ndarray, width: int) -> np.ndarray:
    """Mark grams that are the least of some good window of ``width`` neighbouring grams.

    All grams that tie for the least are marked, so what a window marks depends
    on its own words alone: equal windows anywhere mark equal grams.
    """
    marked = np.zeros(len(grams), dtype=bool)
    least = slide(np.minimum, grams, width)
    if len(least) == 0:
        return marked
    # a gram is marked if the largest of the minima of its windows is its own value
    padded = np.zeros(len(grams) + width - 1, dtype=np.uint64)
    padded[width - 1:width - 1 + len(least)] = np.where(windows[:len(least)], least, np.uint64(0))
    good = np.zeros(len(grams) + width - 1, dtype=bool)
    good[width - 1:width - 1 + len(least)] = windows[:len(least)]
    return (slide(np.maximum, padded, width) == grams) & slide(np.logical_or, good, width)


def sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between neighbouring bounds."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def lists(values: np.ndarray, marks_per_row: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column whose rows take the given numbers of values in turn."""
    offsets = np.zeros(len(marks_per_row) + 1, dtype=np.int32)
    np.cumsum(marks_per_row, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
