"""Elias-Fano code of a non-decreasing sequence of unsigned integers.

Of each value the low ``width`` bits are stored as they are, side by side; the
high parts are stored as a bit vector in which the k-th set bit stands at
(high part of value k) + k.  With width = floor(log2(greatest / count)) this
takes about 2 + log2(greatest / count) bits a value.  Value k is read through
select(k), the place of the k-th set bit: every 64th place is stored as 32 bits;
where 64 set bits span over ``LONG`` bits, all 64 places are stored, so a select
looks at a bounded number of words.  No table has 64-bit entries.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE, LONG = 64, 4096
HEADER = struct.Struct("<QQBxxxIII")                       # count, greatest, width, sizes of three parts


def encode(values: np.ndarray) -> bytes:
    """Code of ``values`` (uint64, non-decreasing)."""
    values = np.asarray(values, np.uint64)
    count, greatest = len(values), int(values[-1]) if len(values) else 0
    width = max(0, (greatest // max(count, 1)).bit_length() - 1)
    low = np.zeros((count * width + 7) // 8 + 8, np.uint8)
    step = 8 * 4096                                         # a whole number of bytes whatever the width
    for first in range(0, count if width else 0, step):
        some = values[first:first + step]
        bits = (some[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        low[first * width // 8:first * width // 8 + len(packed)] = packed
    places = ((values >> np.uint64(width)) + np.arange(count, dtype=np.uint64)).astype(np.int64)
    size = (int(places[-1]) if count else 0) + 1
    if size >= 1 << 32:
        raise ValueError("a sequence of this length needs more than one code")
    high = np.zeros((size + 63) // 64 * 64, np.uint8)
    high[places] = 1
    words = np.packbits(high, bitorder="little")
    starts = places[::SAMPLE].astype("<u4")
    spans = np.diff(np.r_[places[::SAMPLE], size])
    full = np.arange(len(starts)) < count // SAMPLE         # the last block may have fewer bits
    far = np.flatnonzero((spans > LONG) & full)
    apart = places[(far[:, None] * SAMPLE + np.arange(SAMPLE)).ravel()].astype("<u4")
    tail = struct.pack("<I", len(far)) + far.astype("<u4").tobytes() + apart.tobytes()
    head = HEADER.pack(count, greatest, width, len(low), len(words), len(starts))
    return head + low.tobytes() + words.tobytes() + starts.tobytes() + tail


class Sequence:
    """Reads values of a code by their numbers."""

    def __init__(self, raw: bytes):
        self.count, self.greatest, self.width, n_low, n_high, n_starts = HEADER.unpack_from(raw)
        at = HEADER.size
        self.low = np.frombuffer(raw, np.uint8, n_low, at)
        self.words = np.frombuffer(raw, "<u8", n_high // 8, at + n_low)
        self.starts = np.frombuffer(raw, "<u4", n_starts, at + n_low + n_high)
        at += n_low + n_high + 4 * n_starts
        n_far, = struct.unpack_from("<I", raw, at)
        self.far = np.frombuffer(raw, "<u4", n_far, at + 4)
        self.apart = np.frombuffer(raw, "<u4", n_far * SAMPLE, at + 4 + 4 * n_far)

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, numbers) -> np.ndarray:
        """Values of an array of numbers (each from 0 to the count less one)."""
        numbers = np.atleast_1d(np.asarray(numbers, np.int64))
        if len(numbers) and (numbers.min() < 0 or numbers.max() >= self.count):
            raise IndexError("no such value")
        high = (self.select(numbers) - numbers).astype(np.uint64)
        return (high << np.uint64(self.width)) | self._low(numbers)

    def _low(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), np.uint64)
        if not self.width:
            return out
        at = numbers * self.width
        byte, shift = at >> 3, (at & 7).astype(np.uint64)
        for k in range(8):
            out |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        out >>= shift
        if self.width > 57:                                 # may reach into a ninth byte
            ninth = self.low[np.minimum(byte + 8, len(self.low) - 1)].astype(np.uint64)
            out |= np.where(shift > 0, ninth << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return out & np.uint64((1 << self.width) - 1)

    def select(self, numbers: np.ndarray) -> np.ndarray:
        """Places of the set bits with these numbers."""
        block, left = numbers // SAMPLE, numbers % SAMPLE
        start = self.starts[block].astype(np.int64)
        out = np.zeros(len(numbers), np.int64)
        found = np.minimum(np.searchsorted(self.far, block), max(len(self.far) - 1, 0))
        is_far = (self.far[found] == block) if len(self.far) else np.zeros(len(numbers), bool)
        out[is_far] = self.apart[found[is_far] * SAMPLE + left[is_far]]
        todo = np.flatnonzero(~is_far)
        word, rest = start[todo] >> 6, left[todo]
        bits = self.words[word] & (np.uint64(0xFFFFFFFFFFFFFFFF) << (start[todo] & 63).astype(np.uint64))
        while len(todo):
            ones = np.bitwise_count(bits).astype(np.int64)
            here = rest < ones
            out[todo[here]] = (word[here] << 6) + bit_in_word(bits[here], rest[here])
            todo, word, rest = todo[~here], word[~here] + 1, (rest - ones)[~here]
            bits = self.words[word] if len(word) else bits[:0]
        return out


def bit_in_word(bits: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``rest`` of each 64-bit word, by halves."""
    place, rest = np.zeros(len(bits), np.int64), rest.copy()
    for half in (32, 16, 8, 4, 2, 1):
        lower = bits & np.uint64((1 << half) - 1)
        ones = np.bitwise_count(lower).astype(np.int64)
        up = rest >= ones
        rest[up] -= ones[up]
        place[up] += half
        bits = np.where(up, bits >> np.uint64(half), lower)
    return place
