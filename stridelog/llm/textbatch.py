"""Words of a batch of texts as numpy arrays: places, hashes and rolling n-gram hashes.

All arithmetic is on whole batches: a batch is the concatenated UTF-8 bytes of its texts,
as Arrow holds them, and every array has one entry per byte, word or text of the batch.
Words are runs of bytes other than the six ASCII white-space characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; one text longer than this makes a batch of its own.
BATCH_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD1342543DE82EF95)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BYTE_BASE)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown when asked for more."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.inverse = int(base), pow(int(base), -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate(
                [self.down, self.down * np.uint64(pow(self.inverse, size, 1 << 64))])
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def _sums(values: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, ... values."""
    out = np.empty(len(values) + 1, dtype=values.dtype)
    out[0] = 0
    np.cumsum(values, out=out[1:])
    return out


class TextBatch:
    """Texts ``0 .. rows - 1``; ``bounds`` has the byte places at which they begin and end."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray,
                 separators: np.ndarray = _SPACE) -> None:
        self.data, self.bounds, self.rows = data, bounds, len(bounds) - 1
        solid = ~separators[data]
        first, last = solid.copy(), solid.copy()
        if len(data):
            first[1:] &= ~solid[:-1]
            last[:-1] &= ~solid[1:]
            filled = bounds[1:] > bounds[:-1]
            begin, end = bounds[:-1][filled], bounds[1:][filled] - 1
            first[begin], last[end] = solid[begin], solid[end]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.word_bounds = np.searchsorted(self.starts, bounds)
        self._solid, self._byte_sums = solid, None

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.word_bounds))

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes between places."""
        up, down = _BYTE_POWERS.get(len(self.data) + 1)
        if self._byte_sums is None:
            self._byte_sums = _sums(_BYTE_VALUE[self.data] * up[:-1])
        raw = (self._byte_sums[ends] - self._byte_sums[starts]) * down[starts]
        return mix(raw ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))

    def word_hash(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)

    def chars(self) -> np.ndarray:
        """Code points before each byte place."""
        return _sums(((self.data & 0xC0) != 0x80).astype(np.int64))

    def count_in_rows(self, marked: np.ndarray) -> np.ndarray:
        """How many marked bytes each text has."""
        sums = _sums(marked.astype(np.int64))
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def sum_words(self, values: np.ndarray) -> np.ndarray:
        """Sums per text of a value per word."""
        sums = _sums(values.astype(np.int64))
        return sums[self.word_bounds[1:]] - sums[self.word_bounds[:-1]]

    def text(self, row: int) -> bytes:
        return self.data[self.bounds[row]:self.bounds[row + 1]].tobytes()


class NGrams:
    """Rolling hashes of word sequences: any length from one running sum."""

    def __init__(self, words: np.ndarray) -> None:
        up, self._down = _WORD_POWERS.get(len(words) + 1)
        self._sums, self.size = _sums(words * up[:-1]), len(words)

    def all(self, n: int) -> np.ndarray:
        """The hash of the ``n`` words from each place at which there are as many."""
        count = max(self.size - n + 1, 0)
        return mix((self._sums[n:n + count] - self._sums[:count]) * self._down[:count])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])


def batches(column: pa.Array, limit: int = BATCH_BYTES, separators: np.ndarray = _SPACE,
            folded: np.ndarray | None = None) -> Iterator[tuple[int, int, TextBatch]]:
    """Cut a string column into (first row, end row, batch); null is the empty text.

    ``separators`` marks the bytes between words, ``folded`` gives each byte the one it counts as.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        part = raw[offsets[row]:offsets[end]]
        part = part if folded is None else folded[part]
        yield row, end, TextBatch(part, offsets[row:end + 1] - offsets[row], separators)
        row = end
