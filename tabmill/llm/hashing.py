"""Word and shingle hashes of whole Arrow text columns, without a Python object per word.

Words are maximal runs of bytes other than space and 0x09-0x0D of the UTF-8 text. A word's hash is a polynomial over its
bytes modulo 2^64 with a final mix, taken from prefix sums, so its cost does not depend on the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # text handled at once; a longer text is a slice of its own
CHUNK_BYTES = 1 << 20  # bytes hashed at once, extended to the next white space

_BASE = 0x9E3779B97F4A7C15 | 1
_tables: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x.copy()
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


def _setup(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if _tables.get("n", 0) < n:
        space = np.zeros(256, bool)
        space[[0x20, *range(0x09, 0x0E)]] = True
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        letter = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        up, down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        _tables.update(n=n, all=(space, lower, letter, up, down))
    return _tables["all"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `limit` bytes of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.diff(text_bytes(batch.column(batch.schema.get_field_index(text)))[1])
        part = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def release() -> None:
    """Hand memory that is free again back to the system: Spark keeps its workers, with all they hold, for later stages."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()  # numpy's, too


class Words:
    """Hashes (`hash`), byte bounds (`start`, `end`) and row bounds (`first`, of length rows + 1) of all words."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.offsets = text_bytes(column)
        if lower:
            self.data = _setup(CHUNK_BYTES)[1][self.data]
        self.start, self.end = self._bounds()
        self.first = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.first)
        self.hash = self._hashes()

    def _bounds(self) -> tuple[np.ndarray, np.ndarray]:
        space = _setup(CHUNK_BYTES)[0]
        inside = np.zeros(len(self.data) + 1, bool)
        inside[:-1] = ~space[self.data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        edges = self.offsets[1:-1]
        opens[edges] = inside[edges]  # a word never runs over into the next row
        closes = ~inside
        closes[edges] = True
        closes[1:] &= inside[:-1]
        closes[0] = False
        return np.flatnonzero(opens), np.flatnonzero(closes)

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        done = 0
        while done < len(out):
            begin = self.start[done]
            upto = max(done + 1, int(np.searchsorted(self.end, begin + CHUNK_BYTES, "right")))
            stop = self.end[upto - 1]
            _, _, letter, up, down = _setup(max(CHUNK_BYTES, int(stop - begin)) + 1)
            sums = np.zeros(stop - begin + 1, np.uint64)
            np.cumsum(letter[self.data[begin:stop]] * up[: stop - begin], out=sums[1:])
            a, b = self.start[done:upto] - begin, self.end[done:upto] - begin
            out[done:upto] = mix((sums[b] - sums[a]) * down[a])
            done = upto
        return out

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the `size` words from each word on, and the words at which so many are left in the row."""
        total = len(self.hash)
        if total < size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = np.zeros(total - size + 1, np.uint64)
        factor = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(size)) | np.uint64(1)
        for j in range(size):
            out += self.hash[j : j + len(out)] * factor[j]
        left = np.repeat(self.first[1:], self.count) - np.arange(total)
        at = np.flatnonzero(left >= size)
        return mix(out[at]), at

    def word_bytes(self, row: int) -> list[bytes]:
        a, b = self.offsets[row], self.offsets[row + 1]
        return self.data[a:b].tobytes().split()


def planes(values: np.ndarray) -> bytes:
    """Little-endian numbers byte plane by byte plane, so that sorted ones compress."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(kind).ravel()
