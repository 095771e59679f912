"""Partitioned Elias-Fano sequences in arrays that can be memory-mapped.

A strictly or weakly increasing sequence is cut into blocks of 64 values.  A block stores
its first value, the low bits of the differences to it, as many for all its values, and
their high bits in unary: with the low bits chosen by the block's range that is at most
three words.  All operations work on whole numpy arrays of queries.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64
HIGH_WORDS = 3
_ONE = np.uint64(1)
#: A word of eight bytes that are all one, and one of their top bits.
_ONES, _TOPS = 0x0101010101010101, 0x8080808080808080
#: Place of the set bit number ``r`` of byte ``x``, at ``8 * x + r``.
_IN_BYTE = np.array([p for x in range(256) for p in [*(i for i in range(8) if x >> i & 1), *[0] * 8][:8]], np.uint8)


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``rank``, from 0, in each word; it must be there."""
    rank = rank.astype(np.uint64)
    sums = words - ((words >> 1) & 0x5555555555555555)
    sums = (sums & 0x3333333333333333) + ((sums >> 2) & 0x3333333333333333)
    sums = ((sums + (sums >> 4)) & 0x0F0F0F0F0F0F0F0F) * _ONES  # byte i: set bits up to it
    # A byte keeps its top bit if the sum up to it is at most the rank.
    shift = np.bitwise_count(((rank * _ONES | _TOPS) - sums) & _TOPS).astype(np.uint64) << 3
    rank -= ((sums << 8) >> shift) & 255
    return (shift + _IN_BYTE[(((words >> shift) & 255) << 3 | rank).view(np.int64)]).view(np.int64)


def _select_in(rows: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of a set bit among a row of three words."""
    ones = np.bitwise_count(rows)
    first = ones[:, 0].astype(np.int64)
    both = first + ones[:, 1]
    second, third = rank >= first, rank >= both
    word = second.astype(np.int64) + third
    left = rank - np.where(third, both, np.where(second, first, 0))
    return word * 64 + _select(rows[np.arange(len(rows)), word], left)


class MonotoneSequence:
    """Values in order; ``find`` for strictly increasing ones, ``access`` for any."""

    NAMES = ("first", "low", "start", "width", "high")

    def __init__(self, length: int, first, low, start, width, high):
        self.length = length
        self.first, self.low, self.start, self.width, self.high = first, low, start, width, high

    @classmethod
    def build(cls, values: np.ndarray) -> MonotoneSequence:
        values = values.astype(np.uint64)
        n = len(values)
        blocks = max(1, -(-n // BLOCK))
        padded = np.concatenate((values, np.full(blocks * BLOCK - n, values[-1] if n else 0, np.uint64)))
        padded = padded.reshape(blocks, BLOCK)
        first = padded[:, 0].copy()
        off = padded - first[:, None]
        span = off[:, -1]
        bits = np.zeros(blocks, np.int64)  # so many low bits that at most 128 high values remain
        while (over := (span >> bits.astype(np.uint64)) >= 2 * BLOCK - 1).any():
            bits += over
        width = bits.astype(np.uint8)
        start = np.concatenate(([0], np.cumsum(bits)))  # 64 values of w bits are w words
        low = np.zeros(int(start[-1]) + 2, np.uint64)  # a value is read with the word after its own
        lows = off & ((_ONE << bits.astype(np.uint64)) - _ONE)[:, None]
        for i in range(BLOCK):
            at = i * bits
            word, shift = start[:-1] + (at >> 6), (at & 63).astype(np.uint64)
            some = bits > 0
            low[word[some]] |= (lows[:, i] << shift)[some]  # blocks share no word
            spill = some & ((at & 63) + bits > 64)
            low[word[spill] + 1] |= (lows[:, i] >> (np.uint64(64) - shift))[spill]
        high = np.zeros((blocks, HIGH_WORDS), np.uint64)
        place = (off >> bits.astype(np.uint64)[:, None]).astype(np.int64) + np.arange(BLOCK)
        for i in range(BLOCK):
            high[np.arange(blocks), place[:, i] >> 6] |= _ONE << (place[:, i] & 63).astype(np.uint64)
        return cls(n, first, low, start, width, high)

    def _lows(self, start: np.ndarray, bits: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Low bits of the values number ``i`` of blocks with these starts and widths."""
        at = i * bits
        word, shift = start + (at >> 6), (at & 63).astype(np.uint64)
        value = self.low[word] >> shift | (self.low[word + 1] << _ONE) << (np.uint64(63) - shift)
        return value & ((_ONE << bits.astype(np.uint64)) - _ONE)

    def access(self, index: np.ndarray) -> np.ndarray:
        """The values at these places."""
        block, i = index >> 6, index & 63
        width = self.width[block]
        high = (_select_in(self.high[block], i) - i).astype(np.uint64) << width.astype(np.uint64)
        return (self.first[block] + high + self._lows(self.start[block], width.astype(np.int64), i)).astype(np.int64)

    def decode(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The values from one place to another."""
        stop = self.length if stop is None else stop
        parts = [self.access(np.arange(a, min(a + (1 << 18), stop))) for a in range(start, stop, 1 << 18)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Places of the values in a strictly increasing sequence, -1 for those not in it."""
        found = np.full(len(values), -1, np.int64)
        if not self.length or not len(values):
            return found
        wanted = values.astype(np.uint64)
        block = np.searchsorted(self.first, wanted, "right") - 1
        some = np.flatnonzero(block >= 0)
        block = block[some]
        off = wanted[some] - self.first[block]
        width = self.width[block].astype(np.uint64)
        high = (off >> width).astype(np.int64)
        inside = np.flatnonzero(high < HIGH_WORDS * 64 - BLOCK)
        if len(inside) < len(some):
            some, block, off, width, high = some[inside], block[inside], off[inside], width[inside], high[inside]
        # Values with these high bits stand between this unset bit and the one before.
        zeros = ~self.high[block]
        end = np.minimum(_select_in(zeros, high) - high, self.length - block * BLOCK)
        at = np.where(high > 0, _select_in(zeros, np.maximum(high - 1, 0)) - high + 1, 0)
        # Among those the low bits increase; the range that may hold them is halved.
        open_ = np.flatnonzero(at < end)
        some, at, end, width = some[open_], at[open_], end[open_], width[open_]
        place, start, bits = block[open_] * BLOCK, self.start[block[open_]], width.astype(np.int64)
        wanted = off[open_] & ((_ONE << width) - _ONE)
        while len(some):
            middle = (at + end) >> 1
            low = self._lows(start, bits, middle)
            equal = low == wanted
            found[some[equal]] = (place + middle)[equal]
            below = low < wanted
            at, end = np.where(below, middle + 1, at), np.where(below, end, middle)
            open_ = np.flatnonzero((at < end) & ~equal)
            some, at, end, wanted = some[open_], at[open_], end[open_], wanted[open_]
            place, start, bits = place[open_], start[open_], bits[open_]
        return found
