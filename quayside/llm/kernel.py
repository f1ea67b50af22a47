"""Vectorised text kernels that run inside tasks, on Arrow batches of bounded size.

Texts are UTF-8 bytes throughout. White space is ASCII only, so words can be
found on bytes: no byte of a multi-byte character is below 0x80.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.Generator(np.random.PCG64(20240601)).integers(1, 1 << 63, (2, 256), dtype=np.int64).astype(np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            np.multiply.accumulate(x, out=x)
            _powers[k] = x
    return _powers["up"][:n], _powers["down"][:n]


class Hashes:
    """Rolling hashes of every span of a byte array, by prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray, which: int = 0):
        up, self.down = _power(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[which][data] * up[:-1], out=self.sums[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal for equal bytes wherever they stand; spans of unequal length differ too."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def texts(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = CHUNK_BYTES):
    """(rows, bytes, offsets) of about ``limit`` bytes each."""
    for batch in batches:
        data, offsets = texts(batch.column(batch.schema.get_field_index(name)))
        n, at = batch.num_rows, 0
        while at < n:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            end = min(end, n)
            yield batch.slice(at, end - at), data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
            at = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words before each row (rows + 1 values)."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~_SPACE[data]
    first = solid[1:-1] & ~solid[:-2]
    last = solid[1:-1] & ~solid[2:]
    inner = offsets[1:-1][offsets[1:-1] < len(data)]
    first[inner] |= solid[1:-1][inner]
    inner = offsets[1:-1][offsets[1:-1] > 0]
    last[inner - 1] |= solid[1:-1][inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z lower-cased, and the number of words before each row."""
    data = LOWER[data]
    starts, ends, at = words(data, offsets)
    return Hashes(data).span(starts, ends), at


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """The distinct hashed word shingles of each row, ascending; with fewer words the whole
    sequence is one shingle, without words there is none."""
    hashes, at = word_hashes(data, offsets)
    roll = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for i in range(size if len(roll) else 0):
        roll = roll * _BASE + hashes[i:len(hashes) - size + 1 + i]
    roll = mix(roll)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(roll[a:b - size + 1]))
        elif b > a:
            x = np.uint64(b - a)
            for h in hashes[a:b]:
                x = mix(np.array([x]) * _BASE + h)[0]
            out.append(np.array([x], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b
