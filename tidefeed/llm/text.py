"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A text column is worked on where Arrow holds it: one buffer of UTF-8 bytes with offsets. A word is a
run of bytes of one class, so both word definitions in use (letters and digits with everything outside
ASCII; everything but ASCII blanks) are exact on bytes. A-Z and a-z hash alike. Equal words have equal
hashes everywhere; different words differ but for a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Texts are hashed in groups of about so many bytes, which bounds the memory of a task.
GROUP_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of each value over the whole of it (the finaliser of splitmix64)."""
    x = values.astype(np.uint64)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def salt(number: int) -> np.uint64:
    """A constant of its own for each number, to tell hashes of different kinds apart."""
    return _U(number * 0xD1342543DE82EF95 % (1 << 64))


def _byte_codes(fold: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE)) | _U(1)
    if fold:
        codes[ord("A") : ord("Z") + 1] = codes[ord("a") : ord("z") + 1]
    return codes


def _byte_class(ranges: tuple[tuple[int, int], ...], inside: bool) -> np.ndarray:
    out = np.full(256, not inside)
    for first, last in ranges:
        out[first : last + 1] = inside
    return out


FOLDED, EXACT = _byte_codes(True), _byte_codes(False)
#: Letters, digits and everything outside ASCII.
ALNUM = _byte_class(((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)), inside=True)
#: Letters and everything outside ASCII.
LETTERS = _byte_class(((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)), inside=True)
#: Everything but the ASCII blanks: space, tab, line feed, vertical tab, form feed, carriage return.
NOT_BLANK = _byte_class(((0x20, 0x20), (0x09, 0x0D)), inside=False)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for positions up to n."""
    if len(_powers[0]) <= n:
        size = max(n + 1, GROUP_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


class Words(NamedTuple):
    """Words of a group of texts, in order. Text ``t`` has the words ``first[t]`` up to ``first[t + 1]``."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; NULL counts as the empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def groups(offsets: np.ndarray, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; a longer text is a range of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, codes: np.ndarray = FOLDED) -> Words:
    """The words of the texts that ``offsets`` bounds in ``data``."""
    base = int(offsets[0])
    data, offsets = data[base : int(offsets[-1])], offsets - base
    n = len(data)
    inside = kind[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]  # a word ends where its text ends
    opens[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(span_hash(data, start, end, codes), start, end, np.searchsorted(start, offsets), data)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray = FOLDED) -> np.ndarray:
    """Hash of the bytes of each span; the spans must be in order of their starts."""
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * power[: len(data)], dtype=np.uint64, out=total[1:])
    return mix((total[end] - total[start]) * inverse[start])


def gram_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words, also those that cross from text to text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, size):
        out *= _U(_BASE)
        out += hashes[j : n + j]
    return mix(out)


def whole_grams(first: np.ndarray, size: int) -> np.ndarray:
    """True where a run of ``size`` words lies within one text."""
    total = int(first[-1])
    n = max(0, total - size + 1)
    stop = np.repeat(first[1:], np.diff(first))  # the end of the text of each word
    return np.arange(n) + size <= stop[:n]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
