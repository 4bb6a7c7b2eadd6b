"""Words of whole texts as arrays: byte positions and 64-bit hashes, a block of texts at a time.

A word is a maximal run of bytes other than space and the control characters 0x09-0x0D.
These separators are ASCII, so looking at UTF-8 bytes gives the same words as looking at
characters. Texts are taken in blocks of about ``BLOCK`` bytes (a longer text is a block
of its own), which bounds the memory of a task by that and its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Every ASCII character but letters and digits; parts words into terms.
MARKS = np.ones(256, dtype=bool)
MARKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.random.Generator(np.random.PCG64(20_11)).integers(0, 1 << 64, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    up = _powers(_BASE, 2)
    down = _powers(pow(_BASE, -1, 1 << 64), 2)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, BLOCK + (BLOCK >> 1))
            cls.up = _powers(_BASE, size)
            cls.down = _powers(pow(_BASE, -1, 1 << 64), size)
        return cls.up, cls.down


class Words(NamedTuple):
    """Words of one block of texts, in order."""

    first: int  #: place of the block's first text in the column
    data: np.ndarray  #: bytes of the texts, lower-cased where asked for
    texts: np.ndarray  #: byte offsets of the texts, one more than there are texts
    starts: np.ndarray  #: byte offset of each word
    ends: np.ndarray  #: and of its end
    hashes: np.ndarray  #: 64-bit hash of each word
    offsets: np.ndarray  #: number of words before each text, one more than there are texts


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, byte offsets from 0) of each block of texts; null is empty."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words_of(
    data: np.ndarray,
    texts: np.ndarray,
    first: int = 0,
    lower: bool = False,
    cuts: np.ndarray | None = None,
    space: np.ndarray = _SPACE,
) -> Words:
    """Words of a block of texts given as bytes and offsets; ``cuts`` are further places where one begins.

    ``space`` marks the bytes that part words.
    """
    if lower:
        data = _LOWER[data]
    n = len(data)
    inside = ~space[data]
    begins = np.zeros(n + 1, dtype=bool)
    begins[texts] = True
    if cuts is not None:
        begins[cuts] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | begins[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | begins[1:n]
    starts = np.flatnonzero(start)
    ends = np.flatnonzero(end) + 1
    hashes = span_hashes(data, starts, ends)
    return Words(first, data, texts, starts, ends, hashes, np.searchsorted(starts, texts))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; that of a whole word is the word's."""
    n = len(data)
    up, down = _Powers.of(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * up[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mix(hashes ^ (ends - starts).astype(np.uint64))


def words(
    column: pa.Array, lower: bool = False, size: int = BLOCK, space: np.ndarray = _SPACE
) -> Iterator[Words]:
    """Words of a column of texts, block by block."""
    for first, data, texts in blocks(column, size):
        yield words_of(data, texts, first, lower, space=space)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words of one text (empty where there are fewer)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _SHINGLE_BASE
        out += hashes[j : j + n]
    return mix(out)


def shingles(hashes: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct shingles of one text; fewer than ``k`` words give one, none gives none."""
    if not len(hashes):
        return hashes
    return np.unique(windows(hashes, min(k, len(hashes))))


def joined_words(block: Words, at: np.ndarray, glue: np.ndarray) -> str:
    """The words ``at`` of a block in one text, each followed by ``glue``."""
    lengths = block.ends[at] - block.starts[at]
    sizes = lengths + len(glue)
    before = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(before, sizes)
    own = np.repeat(lengths, sizes)
    inside = place < own
    out = np.empty(len(place), dtype=np.uint8)
    out[inside] = block.data[(np.repeat(block.starts[at], sizes) + place)[inside]]
    out[~inside] = glue[(place - own)[~inside]]
    return out.tobytes().decode("utf-8")
