"""Words, lines and hashes of many texts at once, on the UTF-8 bytes of an Arrow batch.

Everything is numpy over one buffer that holds a few megabytes of texts, so the
cost of a text does not depend on how many words it has, and a long text takes
one block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text makes a block alone.
BLOCK_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (the finish of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, made once a task and lengthened when a text is longer."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 1)
            self.up, self.down = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size - 1, b))))
                                  for b in (_BASE, _BASE_INVERSE))
        return self.up[:n], self.down[:n]

    def __reduce__(self):
        return _Powers, ()  # a task makes its own instead of being sent these


POWERS = _Powers()


class Texts:
    """Texts of an Arrow string array as one byte buffer. Null is the empty text."""

    def __init__(self, column: pa.Array) -> None:
        column = pc.fill_null(column, "").cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
        low, high = (int(offsets[0]), int(offsets[-1])) if len(column) else (0, 0)
        body = column.buffers()[2]
        self.data = np.frombuffer(body, np.uint8)[low:high] if body is not None and high > low else np.empty(0, np.uint8)
        self.bounds = (offsets - low).astype(np.int64) if len(column) else np.zeros(1, np.int64)
        self.start, self.end = self.bounds[:-1], self.bounds[1:]
        self.count = len(column)
        self._sums: np.ndarray | None = None

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many marked bytes each text has."""
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[self.end] - total[self.start]

    def first_bytes(self) -> np.ndarray:
        """Marks the first byte of each code point."""
        return (self.data & 0xC0) != 0x80

    def hash_spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each span of bytes: the same bytes give the same hash wherever they are."""
        up, down = POWERS.to(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[self.data] * up[:-1], dtype=np.uint64)))
        raw = (self._sums[end] - self._sums[start]) * down[start]
        return mix(raw + (end - start).astype(np.uint64) * _STEP)


class Words:
    """The words of texts: byte spans, the text of each and where each text's words begin."""

    def __init__(self, texts: Texts) -> None:
        self.texts = texts
        solid = ~_SPACE[texts.data]
        before, after = np.zeros_like(solid), np.zeros_like(solid)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        full = texts.end > texts.start
        before[texts.start[full]] = False
        after[texts.end[full] - 1] = False
        self.solid = solid
        self.start = np.flatnonzero(solid & ~before)
        self.end = np.flatnonzero(solid & ~after) + 1
        self.bounds = np.searchsorted(self.start, texts.bounds)
        self.per_text = np.diff(self.bounds)
        self.text = np.repeat(np.arange(texts.count), self.per_text)

    def hashes(self) -> np.ndarray:
        return self.texts.hash_spans(self.start, self.end)

    def windows(self, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of n words of one text: a rolling polynomial over word hashes."""
        many = len(hashes) - n + 1
        if many <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        rolled = np.zeros(many, np.uint64)
        for i in range(n):
            rolled = rolled * _STEP + hashes[i: i + many]
        whole = np.flatnonzero(self.text[:many] == self.text[n - 1:])
        return whole, mix(rolled[whole])


def blocks(batch: pa.RecordBatch, column: str | int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most BLOCK_BYTES of text each, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    total = np.cumsum(sizes, dtype=np.int64)
    while at < batch.num_rows:
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + BLOCK_BYTES, side="right")))
        yield batch.slice(at, to - at)
        at = to
