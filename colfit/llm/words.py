"""Words of many texts at once, as places in their bytes and as 64-bit hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a word that are hashed by table; longer words are few and hashed one by one.
HASHED_BYTES = 48
#: Bytes of text that are taken at once, or one text if it is longer.
BYTES_AT_ONCE = 2_000_000

_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
_TABLE = np.random.default_rng(7).integers(0, 1 << 64, (HASHED_BYTES, 256), np.uint64)


class Words(NamedTuple):
    """Words, runs of anything but ASCII white space, in the joined bytes of some texts."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    before: np.ndarray  # number of words before each text, and of all

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.start[i] + self.length[i]].tobytes()


def split(texts: pa.Array, lower: bool = False) -> Words:
    """The words of an array of strings; a null has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    if not len(texts):
        return Words(np.empty(0, np.uint8), *(np.empty(0, np.int64),) * 2, np.zeros(1, np.int64))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    solid = ~_BLANK[data]
    first, last = solid.copy(), solid.copy()
    if len(data):
        # A word starts after a blank or where a text starts, and so ends.
        joined = solid[1:] & solid[:-1]
        joined[offsets[(offsets > 0) & (offsets < len(data))] - 1] = False
        first[1:] &= ~joined
        last[:-1] &= ~joined
    start = np.flatnonzero(first)
    length = np.flatnonzero(last) + 1 - start
    return Words(data, start, length, np.searchsorted(start, offsets))


def hashes(words: Words) -> np.ndarray:
    """A sum of random numbers by place and byte for each word.

    A million words share a hash with odds of one to thirty million.
    """
    data, start, length, _ = words
    out = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    left, at = np.arange(len(start)), 0
    while at < HASHED_BYTES:
        left = left[length[left] > at]
        if not len(left):
            return out
        out[left] += _TABLE[at][data[start[left] + at]]
        at += 1
    for i in left[length[left] > at].tolist():
        out[i] = int.from_bytes(hashlib.blake2b(words.word(i), digest_size=8).digest(), "big")
    return out


def slices(texts: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """Consecutive parts of an array of strings, of bounded size."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + (size or BYTES_AT_ONCE), "right")))
        yield texts.slice(at, to - at)
        at = to
