"""Elias-Fano form of a non-decreasing sequence: about 2 + log2(largest / n) bits per value, with select.

The low bits of every value stand in one packed array, the high bits in unary in a bit vector in which the i-th one is at
high(i) + i. Every SAMPLE-th one's place is kept (32 bits each), so that select scans at most a few bytes.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQBQ")


class EliasFano:
    def __init__(self, n: int, largest: int, bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.largest, self.bits, self.low, self.high, self.samples = n, largest, bits, low, high, samples

    @classmethod
    def of(cls, values) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        if n and (v[1:] < v[:-1]).any():
            raise ValueError("values must not decrease")
        largest = int(v[-1]) if n else 0
        bits = max(0, (largest // n).bit_length() - 1) if n else 0
        shifts = np.arange(bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        at = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        high[at] = 1
        return cls(n, largest, bits, low, np.packbits(high, bitorder="little"), at[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return _HEAD.pack(self.n, self.largest, self.bits, len(self.high)) + self.samples.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, largest, bits, high = _HEAD.unpack_from(raw)
        at = _HEAD.size
        k = -(-n // SAMPLE)
        samples = np.frombuffer(raw, "<u4", k, at)
        at += 4 * k
        size = -(-n * bits // 8)
        low = np.frombuffer(raw, np.uint8, size, at)
        return cls(n, largest, bits, low, np.frombuffer(raw, np.uint8, high, at + size), samples)

    def _low(self, i: int) -> int:
        first, last = i * self.bits, (i + 1) * self.bits
        part = int.from_bytes(self.low[first // 8:-(-last // 8)].tobytes(), "little")
        return part >> first % 8 & (1 << self.bits) - 1

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte, word = at // 8, int(self.high[at // 8]) >> at % 8 << at % 8
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        return (byte * 8 + (word & -word).bit_length() - 1 - i) << self.bits | self._low(i)

    def values(self) -> np.ndarray:
        """All values at once."""
        if not self.n:
            return np.zeros(0, np.uint64)
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        out = (at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            low = np.unpackbits(self.low, bitorder="little", count=self.n * self.bits).reshape(self.n, self.bits)
            out |= low.astype(np.uint64) @ (np.uint64(1) << np.arange(self.bits, dtype=np.uint64))
        return out
