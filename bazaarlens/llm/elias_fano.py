"""Non-decreasing integers in near-minimal space, with direct access.

Of each value the low bits are packed; the high parts are gaps in unary in a bit vector, one set bit per value.
Every 256th set bit's position is kept in 32 bits, so a value is found by counting bits from there on.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
#: Values that are packed together; a multiple of 8, so that their low bits fill whole bytes.
BLOCK = 1 << 16
_HEAD = struct.Struct("<QQI")
# the place of the n-th set bit of a byte, least significant first
_PLACES = [[b for b in range(8) if x >> b & 1] for x in range(256)]


class EliasFano:
    def __init__(self, count: int, top: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.top, self._low, self._high, self._samples = count, top, low, high, samples
        self._bits = self.low_bits(count, top)

    @staticmethod
    def low_bits(count: int, top: int) -> int:
        return max(0, (top // count).bit_length() - 1) if count else 0

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """Of sorted non-negative integers."""
        values = np.asarray(values, np.uint64)
        count, top = len(values), int(values[-1]) if len(values) else 0
        bits = cls.low_bits(count, top)
        size = (top >> bits) + count if count else 0
        if size >= 1 << 32:
            raise ValueError("too many values for one file")
        low, high, samples = [], np.zeros((size + 7) // 8, np.uint8), []
        for first in range(0, count, BLOCK):
            block = values[first : first + BLOCK]
            apart = np.empty(len(block) * bits, np.uint8)
            for b in range(bits):
                apart[b::bits] = (block >> np.uint64(b)).astype(np.uint8) & 1
            low.append(np.packbits(apart, bitorder="little"))
            set_at = (block >> np.uint64(bits)).astype(np.int64) + np.arange(first, first + len(block))
            np.bitwise_or.at(high, set_at >> 3, np.uint8(1) << (set_at & 7).astype(np.uint8))
            samples.append(set_at[::SAMPLE].astype("<u4"))
        return cls(count, top, np.concatenate([np.zeros(0, np.uint8), *low]), high, np.concatenate([np.zeros(0, "<u4"), *samples]))

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, i: int) -> int:
        """One value, by the select structure."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        high = self._select(i) - i
        first = i * self._bits
        low = int.from_bytes(self._low[first >> 3 : (first + self._bits + 7) >> 3].tobytes(), "little") >> (first & 7)
        return high << self._bits | low & (1 << self._bits) - 1

    def _select(self, i: int) -> int:
        """Place of the i-th set bit: from the sample before it on, bits are counted."""
        at, left = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte, word = at >> 3, int(self._high[at >> 3]) & 0xFF << (at & 7) & 0xFF
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = int(self._high[byte])
        return 8 * byte + _PLACES[word][left]

    def values(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The values ``first`` to ``last`` (without it; all by default); memory goes with their number.

        Both ends are found by the select structure, and only the bits between them are unpacked.
        """
        last = self.count if last is None else min(last, self.count)
        if first >= last:
            return np.zeros(0, np.int64)
        begin, end = self._select(first), self._select(last - 1)
        byte = begin >> 3
        set_at = np.flatnonzero(np.unpackbits(self._high[byte : (end >> 3) + 1], bitorder="little")) + 8 * byte
        # the first and last byte may hold neighbours
        set_at = set_at[(set_at >= begin) & (set_at <= end)]
        out = (set_at - np.arange(first, last)).astype(np.int64) << self._bits
        bit = first * self._bits
        low = np.unpackbits(self._low[bit >> 3 : (last * self._bits + 7) >> 3], bitorder="little")[bit & 7 :][: (last - first) * self._bits]
        for b in range(self._bits):
            out |= low[b :: self._bits].astype(np.int64) << b
        return out

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.count, self.top, len(self._high))
        return b"".join([head, self._low.tobytes(), self._high.tobytes(), self._samples.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The structure that starts at ``at``, and where it ends."""
        count, top, size = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        parts = []
        for kind, n in ((np.uint8, (count * cls.low_bits(count, top) + 7) // 8), (np.uint8, size), ("<u4", -(-count // SAMPLE))):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        return cls(count, top, *parts), at
