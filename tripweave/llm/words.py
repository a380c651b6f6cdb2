"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

Nothing is cut: all words of all given texts are found.  Words are known by a
64-bit hash of their bytes, which depends on nothing but these bytes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tripweave.llm.common import mix

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_ORDER = np.uint64(0xD6E8FEB86659FD93 | 1)
_ORDER_INVERSE = np.uint64(pow(int(_ORDER), -1, 1 << 64))


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


@cache
def _is_word(kind: str) -> np.ndarray:
    byte = np.arange(256)
    if kind == "plain":  # everything but ASCII white space
        return ~((byte == 0x20) | ((byte >= 0x09) & (byte <= 0x0D)))
    letters = ((byte >= 0x61) & (byte <= 0x7A)) | ((byte >= 0x41) & (byte <= 0x5A)) | (byte >= 0x80)
    if kind == "letters":
        return letters
    if kind == "alnum":  # after lower-casing: digits, a-z and everything that is not ASCII
        return letters | ((byte >= 0x30) & (byte <= 0x39))
    return byte != 0x0A  # lines


@cache
def _lower() -> np.ndarray:
    byte = np.arange(256, dtype=np.uint8)
    byte[0x41:0x5B] += 0x20
    return byte


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1) modulo 2 ** 64."""
    known = _powers.get(int(base))
    if known is None or len(known) < count:
        made = np.full(max(count, 1 << 16), base, dtype=np.uint64)
        made[0] = 1
        known = _powers[int(base)] = np.cumprod(made)
    return known[:count]


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    bounds: np.ndarray  # byte offsets of the texts, one more than texts
    start: np.ndarray  # byte offsets of the words
    end: np.ndarray
    first: np.ndarray  # index of the first word of each text, one more than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_byte_values()[self.data] * powers(_BASE, len(self.data)), out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * powers(_INVERSE, len(self.data))[self.start])

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode()


def words_of(texts: pa.Array, kind: str = "plain", lower: bool = False) -> Words:
    """Words of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    bounds = (offsets - offsets[0]).astype(np.int64)
    if lower:
        data = _lower()[data]
    inside = _is_word(kind)[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = bounds[:-1][np.diff(bounds) > 0]
    start[edges] |= inside[edges]
    last = edges[1:] - 1
    end[last] |= inside[last]
    begins = np.flatnonzero(start)
    return Words(data, bounds, begins, np.flatnonzero(end) + 1, np.searchsorted(begins, bounds))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` word hashes, across all texts."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(_ORDER, len(words)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(_ORDER_INVERSE, len(words))[: len(words) - size + 1])


def run_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the runs of words from ``start`` up to ``end``; runs of any length."""
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(_ORDER, len(words)), out=sums[1:])
    held = (sums[end] - sums[start]) * powers(_ORDER_INVERSE, len(words) + 1)[start]
    return mix(held + mix((end - start).astype(np.uint64)))
