"""Elias-Fano coding of non-decreasing integers, with select.

Of each value the low bits are packed as they are, and the high bits become a bit vector: value
``i`` sets bit ``(value >> low) + i``. Together that is at most two bits and the low bits per value. The
position of every ``STRIDE``-th set bit is kept, so ``select`` reads a bounded stretch of the vector.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

STRIDE = 256
HEADER = struct.Struct("<QQB")


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.empty(0, np.uint8)
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")


@dataclass(frozen=True)
class EliasFano:
    count: int
    width: int  # low bits per value
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray  # position of each STRIDE-th set bit of high

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        low = _pack(values & np.uint64((1 << width) - 1), width)
        return cls(n, width, low, np.packbits(bits, bitorder="little"), places[::STRIDE].astype(np.uint64))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        at = i[:, None] * self.width + np.arange(self.width)
        bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return (bits.astype(np.int64) << np.arange(self.width)).sum(1)

    def select(self, i: int) -> int:
        """Value ``i``."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        block = i // STRIDE
        start = int(self.samples[block])
        end = int(self.samples[block + 1]) if block + 1 < len(self.samples) else len(self.high) * 8 - 1
        first = start >> 3
        bits = np.unpackbits(self.high[first : (end >> 3) + 1], bitorder="little")
        place = np.flatnonzero(bits[start - 8 * first :])[i - block * STRIDE] + start
        return (int(place) - i << self.width) + int(self._low(np.array([i]))[0])

    def all(self) -> np.ndarray:
        """Every value, in order."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        i = np.arange(self.count)
        return (places - i << self.width) + self._low(i)

    def to_bytes(self) -> bytes:
        head = HEADER.pack(self.count, len(self.high), self.width)
        return head + self.high.tobytes() + self.samples.astype("<u8").tobytes() + self.low.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        count, size, width = HEADER.unpack_from(data)
        samples = -(-count // STRIDE)
        at = HEADER.size
        high = np.frombuffer(data, np.uint8, size, at)
        kept = np.frombuffer(data, "<u8", samples, at + size)
        low = np.frombuffer(data, np.uint8, offset=at + size + 8 * samples)
        return cls(count, width, low, high, kept)
