"""Words and word spans of many texts at once, on numpy arrays inside a task.

Words are the maximal runs of bytes other than space and 0x09-0x0D of the UTF-8 text. The
texts of a block are put into one buffer with one space between any two words, so a span
of words is a byte slice and its hash is a difference of two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(n, _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits, so that equal low bits say nothing about the rest."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def blocks(rows: int, sizes: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of about `limit` bytes; a longer row is a run of its own."""
    start, total = 0, 0
    for i in range(rows):
        if i > start and total + sizes[i] > limit:
            yield start, i
            start, total = i, 0
        total += int(sizes[i])
    if rows > start:
        yield start, rows


class Spans:
    """The words of a list of texts: `first[d]:first[d+1]` are the words of text d."""

    def __init__(self, texts: list[bytes]):
        words = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in words], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.data = b" ".join(b" ".join(w) for w in words if w)
        buf = np.frombuffer(self.data, dtype=np.uint8)
        gaps = np.flatnonzero(buf == 32)
        n = int(self.first[-1])
        self.start = np.concatenate(([0], gaps + 1)).astype(np.int64) if n else np.zeros(0, np.int64)
        self.end = np.concatenate((gaps, [len(buf)])).astype(np.int64) if n else np.zeros(0, np.int64)
        table = _power_table(len(buf) + 2)
        self._sums = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * table[: len(buf)], dtype=np.uint64, out=self._sums[1:])
        self._table = table
        self._top = len(buf) + 1

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the words first..last, the same for the same words anywhere."""
        s, e = self.start[first], self.end[last]
        raw = (self._sums[e] - self._sums[s]) * self._table[self._top - s]
        # the power of the buffer's own length is divided out by its inverse
        return mixed(raw * _inverse_power(self._top))

    def slice(self, first: int, last: int) -> bytes:
        return self.data[self.start[first] : self.end[last]]


def _inverse_power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), -n, 1 << 64))


def text_blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch in slices of about BLOCK_BYTES, each with its texts as bytes (null: empty).

    Only the texts of the slice at hand are Python objects.
    """
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for a, b in blocks(batch.num_rows, sizes):
        yield batch.slice(a, b - a), [t or b"" for t in texts.slice(a, b - a).to_pylist()]
