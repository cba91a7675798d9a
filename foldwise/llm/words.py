"""Words of many texts as 64-bit hashes, computed in numpy blocks inside tasks.

A word is a run of bytes other than space and the controls 9 to 13, which are
the bytes that ``bytes.split()`` splits at. Texts are UTF-8. Memory per call is
bounded by one block of ``BLOCK`` bytes and the hashes of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BLOCK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of slices of one sequence of numbers, each in constant time."""

    def __init__(self, base: int):
        self.base = np.uint64(base | 1)
        self.inverse = _inverse(self.base)
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, values: np.ndarray) -> Rolling:
        n = len(values) + 1
        if len(self.up) < n:
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(values * self.up[: n - 1], out=self.sums[1:])
        return self

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + length * np.uint64(0xD6E8FEB86659FD93))


_bytes_rolling = Rolling(int(_BASE))


def _hash_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and hashes of the words of a block."""
    data = np.frombuffer(block, np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    return start, _bytes_rolling.load(data.astype(np.uint64) + np.uint64(1)).slices(start, end)


def _cut(text: bytes, at: int) -> int:
    """The first place at or after ``at`` where no word is cut, or the end."""
    view = np.frombuffer(text, np.uint8)
    while at < len(text):
        white = np.flatnonzero(_SPACE[view[at: at + BLOCK]])
        if len(white):
            return at + int(white[0])
        at += BLOCK
    return len(text)


def _hash_long(text: bytes) -> np.ndarray:
    parts, at = [], 0
    while at < len(text):
        end = _cut(text, at + BLOCK)
        parts.append(_hash_block(text[at:end])[1])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def hashed(texts: Sequence[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Word hashes of consecutive texts.

    Yields (index of the first text, bounds, hashes): text ``first + i`` has
    ``hashes[bounds[i]:bounds[i + 1]]``. None has no words.
    """
    first, size, group = 0, 0, []

    def flush():
        block = b"\n".join(group)
        ends = np.cumsum([len(t) + 1 for t in group])
        start, values = _hash_block(block)
        return first, np.concatenate([[0], np.searchsorted(start, ends)]), values

    for i, text in enumerate(texts):
        text = text or b""
        if len(text) > BLOCK:
            if group:
                yield flush()
            values = _hash_long(text)
            yield i, np.array([0, len(values)]), values
            first, size, group = i + 1, 0, []
            continue
        group.append(text)
        size += len(text) + 1
        if size >= BLOCK:
            yield flush()
            first, size, group = i + 1, 0, []
    if group:
        yield flush()
