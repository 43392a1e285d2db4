"""Words of a batch of texts and their 64-bit hashes, computed on the Arrow buffers at once.

A word is a longest run of bytes other than space and the bytes 9 to 13; A to Z count as a to z.
Separators are single bytes in UTF-8, so bytes and characters agree on where words end.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about this many bytes, so memory does not follow the batch.
SLICE_BYTES = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers that depend on the seed alone."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * _ODD) | np.uint64(1)


_BYTES = constants(256, 1)
_BYTES[65:91] = _BYTES[97:123]
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[32, *range(9, 14)]] = True
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_BASE = int(constants(1, 2)[0])
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 … base ** (n - 1) modulo 2 ** 64, kept for the next call."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 2 * SLICE_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            known = _POWERS[base] = np.cumprod(steps)
    return known[:n]


class Words(NamedTuple):
    """Words of some texts in order: their text's number, first and last byte, and hash."""

    texts: int
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each text, and one past the last: the number of its first word


def raw(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts one after the other, and the len + 1 places where they begin."""
    values = values.cast(pa.large_binary())
    if values.null_count:
        values = values.fill_null(b"")
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    if values.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(values.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together; a longer text stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, to
        at = to


def _trimmed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without ASCII punctuation at either end; words of nothing else disappear."""
    start, end = start.copy(), end.copy()
    rows = np.arange(len(start))
    while len(rows):
        rows = rows[(start[rows] < end[rows]) & _PUNCTUATION[data[np.minimum(start[rows], len(data) - 1)]]]
        start[rows] += 1
    rows = np.arange(len(start))
    while len(rows):
        rows = rows[(start[rows] < end[rows]) & _PUNCTUATION[data[end[rows] - 1]]]
        end[rows] -= 1
    some = start < end
    return start[some], end[some]


def words(data: np.ndarray, offsets: np.ndarray, trim: bool = False) -> Words:
    """The words of texts given as by ``raw``; ``trim`` drops punctuation around them."""
    n, count = len(data), len(offsets) - 1
    inside = ~_SEPARATOR[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[heads[1:] - 1] = inside[heads[1:] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if trim:
        start, end = _trimmed(data, start, end)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * powers(_BASE, n), out=sums[1:])
        inverse = powers(pow(_BASE, -1, 1 << 64), n + 1)
        hashes = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * _ODD)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(count), np.diff(first))
    return Words(count, doc, start, end, hashes, first)


def each(values: pa.Array, trim: bool = False) -> Iterator[tuple[int, np.ndarray, Words]]:
    """Number of the first text, bytes and words of slice after slice of a column of texts."""
    data, offsets = raw(values)
    for lo, hi in slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        yield lo, part, words(part, offsets[lo : hi + 1] - offsets[lo], trim)


def windows(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of every ``size`` words in a row."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=np.uint64)
        for i, factor in enumerate(constants(size, seed)):
            total += hashes[i : i + n] * factor
        return mix(total)
