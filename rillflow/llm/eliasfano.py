"""Elias-Fano coding of ascending numbers, with select."""

from __future__ import annotations

import struct

import numpy as np

HEAD = "<QQBQ"
HEAD_BYTES = struct.calcsize(HEAD)
# One sampled position for so many ones of the upper bits.
SAMPLE = 512


def encode(values: np.ndarray) -> bytes:
    """Ascending numbers in about ``2 + log2(max / count)`` bits each."""
    values = np.asarray(values, np.uint64)
    count = len(values)
    top = int(values[-1]) if count else 0
    width = max(0, (top // count).bit_length() - 1) if count else 0
    shifts = np.arange(width, dtype=np.uint64)
    lower = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    places = (values >> np.uint64(width)).astype(np.int64) + np.arange(count)
    upper = np.zeros(int(places[-1]) + 1 if count else 0, np.uint8)
    upper[places] = 1
    samples = places[::SAMPLE].astype("<u4").tobytes()
    low, high = np.packbits(lower.ravel(), bitorder="little"), np.packbits(upper, bitorder="little")
    return struct.pack(HEAD, count, len(high), width, len(low)) + low.tobytes() + samples + high.tobytes()


class Coded:
    """Read access to coded numbers without decoding all of them."""

    def __init__(self, data: bytes):
        self.count, n_high, self.width, n_low = struct.unpack_from(HEAD, data)
        n_samples = -(-self.count // SAMPLE)
        self._low = np.frombuffer(data, np.uint8, n_low, HEAD_BYTES)
        self._samples = np.frombuffer(data, "<u4", n_samples, HEAD_BYTES + n_low)
        self._high = np.frombuffer(data, np.uint8, n_high, HEAD_BYTES + n_low + 4 * n_samples)

    def select(self, i: int) -> int:
        """The i-th number."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        rank, place = i % SAMPLE, int(self._samples[i // SAMPLE])
        byte = place // 8
        # Ones of the first byte before the sampled one do not count.
        rank += int(self._high[byte] & ((1 << (place % 8)) - 1)).bit_count()
        seen, step = 0, 256
        while True:
            ones = np.cumsum(np.bitwise_count(self._high[byte : byte + step]), dtype=np.int64)
            if seen + ones[-1] > rank:
                at = int(np.searchsorted(ones, rank - seen, "right"))
                rank -= seen + (int(ones[at - 1]) if at else 0)
                bits = np.unpackbits(self._high[byte + at : byte + at + 1], bitorder="little")
                high = 8 * (byte + at) + int(np.flatnonzero(bits)[rank]) - i
                break
            seen, byte = seen + int(ones[-1]), byte + step
        begin = i * self.width
        piece = self._low[begin // 8 : (begin + self.width + 7) // 8]
        bits = np.unpackbits(piece, bitorder="little")[begin % 8 : begin % 8 + self.width]
        return (high << self.width) | sum(int(b) << k for k, b in enumerate(bits))

    def all(self) -> np.ndarray:
        """Every number, in order."""
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.count]
        high = (ones - np.arange(self.count)).astype(np.uint64) << np.uint64(self.width)
        bits = np.unpackbits(self._low, bitorder="little")[: self.count * self.width]
        bits = bits.reshape(self.count, self.width).astype(np.uint64)
        low = (bits << np.arange(self.width, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return (high | low).astype(np.int64)
