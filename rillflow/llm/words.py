"""Words of texts as arrays of 64-bit hashes, for code that runs on Arrow batches inside tasks.

A word is a run of bytes without space, tab, newline, vertical tab, form feed or return, which is
what ``bytes.split()`` cuts by. Hashes are the same in every process and on every machine.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLOCK_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(seed: int, count: int) -> np.ndarray:
    """``count`` fixed odd multipliers."""
    steps = np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)
    return mixed(steps * BASE) | np.uint64(1)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes the words of byte strings; keeps the powers it has computed."""

    def __init__(self):
        self._up = _powers(BASE, BLOCK_BYTES)
        self._down = _powers(BASE_INVERSE, BLOCK_BYTES)

    def spans(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' start offsets, end offsets and hashes."""
        if len(data) >= len(self._up):
            self._up = _powers(BASE, 2 * len(data))
            self._down = _powers(BASE_INVERSE, 2 * len(data))
        raw = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = ~SPACE[raw]
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self._up[: len(raw)], out=sums[1:])
        return starts, ends, mixed((sums[ends] - sums[starts]) * self._down[starts])

    def text(self, data: bytes) -> np.ndarray:
        """Hashes of the words of a text of any length."""
        parts = [self.spans(piece)[2] for piece in blocks(data)]
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def long_spans(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The spans of a text of any length."""
        offset, parts = 0, [(np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)]
        for piece in blocks(data):
            starts, ends, hashes = self.spans(piece)
            parts.append((starts + offset, ends + offset, hashes))
            offset += len(piece)
        starts, ends, hashes = (np.concatenate(p) for p in zip(*parts))
        return starts, ends, hashes

    def placed(self, texts: Iterable[bytes]) -> Iterator[tuple]:
        """Groups of whole texts: index of the first, words' hashes, bounds, data and spans.

        The words of text ``first + i`` are ``hashes[bounds[i]:bounds[i + 1]]``; word ``w`` is
        ``data[starts[w]:ends[w]]``.
        """
        first = 0
        for group in grouped(texts):
            data = b"\n".join(group)
            starts, ends, hashes = self.long_spans(data)
            begins = np.cumsum([0] + [len(x) + 1 for x in group])
            yield first, hashes, np.searchsorted(starts, begins), data, starts, ends
            first += len(group)

    def texts(self, texts: Iterable[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Groups of whole texts: index of the first, words' hashes, and bounds.

        The words of text ``first + i`` are ``hashes[bounds[i]:bounds[i + 1]]``.
        """
        for first, hashes, bounds, *_ in self.placed(texts):
            yield first, hashes, bounds


def blocks(data: bytes) -> Iterator[bytes]:
    """A text in blocks of about ``BLOCK_BYTES`` that end at white space."""
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + BLOCK_BYTES)
        while end < len(data) and not SPACE[data[end]]:
            end += 1
        yield data[begin:end]
        begin = end


def grouped(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Whole texts in groups of about ``BLOCK_BYTES``; a longer text is a group of its own."""
    group, size = [], 0
    for data in texts:
        if group and size + len(data) >= BLOCK_BYTES:
            yield group
            group, size = [], 0
        group.append(data)
        size += len(data) + 1
    if group:
        yield group


def windows(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A hash of every run of ``width`` words, in order; empty when there are fewer words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for at, factor in enumerate(numbers(seed, width)):
        out += hashes[at : at + count] * factor
    return mixed(out)


def encoded(values: Iterable[str | None]) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [(x or "").encode("utf-8", "surrogatepass") for x in values]
