"""Benchmark passages in documents by q-gram lemma filtering and banded alignment.

Texts are compared as canonical bytes: A-Z lower-cased, runs of white space one
space, none at either end. An item of m bytes is *contained* in a document that
has a span within ``k = floor(ERRORS * m)`` edits of the whole item. Items of fewer than ``MIN_ITEM``
bytes have ``k = 0`` and must stand between word borders (``lexicon`` does not hold ``icon``), those of
fewer than ``Q`` must be a document's whole text: as a part they say nothing.
A document that holds part of an item, with more than a tenth of it missing, does not contain it.

* Filter: such a span shares at least ``m + 1 - Q - k Q`` q-grams with the item,
  on diagonals no more than k apart. Shared q-grams are counted in bands of
  2 (k + 1) diagonals that start every k + 1, so that one band holds them all;
  bands that reach the bound are retained. The bound is positive for every item
  of ``Q`` bytes or more; texts of fewer bytes are looked up whole.
* Verification: a banded alignment of the item with the retained region, exact; of a short
  item, a search in that region.

The benchmark is the query set: it is dealt into blocks of about
``BLOCK_BYTES``, each small enough for every task to hold, and all documents are
scanned against each block in turn. A document is scanned whole in its own task;
nothing is shuffled, so no passage that many documents share gathers anywhere.

Defined results: NULL or empty texts and items match nothing; equal items are
reported for every item_id; rows that repeat are reported each; items with a
NULL id are looked for and reported with a NULL id; an empty table on either
side gives no match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.kernel import _SPACE, LOWER, chunks, mix
from quayside.llm.suffix_dedup import _ranges

Q = 8
ERRORS = 0.1
#: The least m whose bound is positive with the budget of edits: m - 7 - 8 floor(m / 10) > 0 for every m
#: from here on. Shorter items are looked for without edits.
MIN_ITEM = 40
#: Bytes of words: ASCII letters and digits, and every byte of another character.
WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
BLOCK_BYTES = 1 << 20
#: Pairs of shared q-grams expanded at once.
EXPAND = 2_000_000


def canonical(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Canonical bytes of all rows, their offsets, and the place of each byte in ``data``."""
    space = _SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    keep = ~space | ~(np.r_[True, space[:-1]] | first[:-1])[:len(data)]
    place = np.flatnonzero(keep)
    out = np.where(space[place], np.uint8(32), LOWER[data[place]])
    at = np.searchsorted(place, offsets)
    # a space that ends a row
    last = at[1:][at[1:] > at[:-1]] - 1
    drop = last[out[last] == 32]
    if len(drop):
        keep = np.ones(len(out), bool)
        keep[drop] = False
        at = at - np.searchsorted(drop, at)
        out, place = out[keep], place[keep]
    return out, at, place


def codes(data: np.ndarray) -> np.ndarray:
    """The q-gram that starts at each byte as one number (zeros after the end)."""
    padded = np.r_[data, np.zeros(2 * Q, np.uint8)]
    out = np.empty(len(data), np.uint64)
    for i in range(Q):
        part = padded[i:i + (len(data) - i + Q - 1) // Q * Q].view("<u8")
        out[i::Q] = part[:len(out[i::Q])]
    return out


class Index:
    """Items of a block with postings of their q-grams."""

    def __init__(self, items: list[tuple[int | None, str]]):
        by_text: dict[bytes, list] = {}
        self.tiny: dict[bytes, list] = {}
        for i, t in items:
            raw = np.frombuffer((t or "").encode(), np.uint8)
            body = canonical(raw, np.array([0, len(raw)]))[0].tobytes()
            if body:
                (by_text if len(body) >= Q else self.tiny).setdefault(body, []).append(i)
        self.texts, self.ids = list(by_text), list(by_text.values())
        self.places = [letters(t) for t in self.texts]
        self.m = np.array([len(t) for t in self.texts], np.int64)
        self.k = np.where(self.m < MIN_ITEM, 0, self.m * ERRORS).astype(np.int64)
        self.bound = self.m + 1 - Q - self.k * Q
        n = self.m - Q + 1
        data = np.frombuffer(b"".join(self.texts), np.uint8)
        first = np.cumsum(self.m) - self.m
        at = _ranges(first, n)
        gram = codes(data)[at] if len(at) else np.zeros(0, np.uint64)
        order = np.argsort(gram, kind="stable")
        self.gram, self.start = np.unique(gram[order], return_index=True)
        self.start = np.r_[self.start, len(order)]
        item = np.repeat(np.arange(len(self.m)), n)
        self.item, self.pos = item[order], (at - first[item])[order]
        bits = max(16, int(32 * max(1, len(self.gram)) - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self._slot(self.gram)] = True

    def _slot(self, gram: np.ndarray) -> np.ndarray:
        return (gram * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def regions(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, first byte, last byte + 1) of every retained band in canonical bytes."""
        if not len(self.gram):
            return []
        gram = codes(data)
        hit = np.flatnonzero(self.table[self._slot(gram)])
        found = np.minimum(np.searchsorted(self.gram, gram[hit]), len(self.gram) - 1)
        good = self.gram[found] == gram[hit]
        hit, found = hit[good], found[good]
        row = np.searchsorted(offsets, hit, "right") - 1
        good = hit + Q <= offsets[row + 1]
        hit, found, row = hit[good], found[good], row[good]
        n = self.start[found + 1] - self.start[found]
        total = np.r_[0, np.cumsum(n)]
        cuts = [0]
        while cuts[-1] < len(hit):
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(total, total[cuts[-1]] + EXPAND, "right")) - 1))
        parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

        def pairs(part):
            """Bands of the shared q-grams of a part, twice: each lies in two; then bound, p and item position."""
            post = _ranges(self.start[found[part]], n[part])
            item, p, r = self.item[post], np.repeat(hit[part], n[part]), np.repeat(row[part], n[part])
            # diagonals from the start of the row, made positive
            band = (p - offsets[r] - self.pos[post] + self.m[item]) // (self.k[item] + 1)
            key = (r * len(self.m) + item << 32) + band
            return np.r_[key + 1, key], np.tile(self.bound[item], 2), np.tile(p, 2), np.tile(self.pos[post], 2)

        # counts by hash are never too small, and settle nearly all bands
        slot = lambda key: (mix(key.astype(np.uint64)) >> np.uint64(44)).astype(np.int64)
        counts, made = np.zeros(1 << 20, np.int64), None
        for part in parts:
            made = pairs(part)
            counts += np.bincount(slot(made[0]), minlength=len(counts))
        keys, places, inner = [], [], []
        for part in parts:
            key, bound, p, pos = made if len(parts) == 1 else pairs(part)
            rich = counts[slot(key)] >= bound
            key, p, pos = key[rich], p[rich], pos[rich]
            if len(parts) > 1:  # a part of very repetitive text: each place once
                order = np.lexsort((p, key))
                first = np.r_[True, (key[order][1:] != key[order][:-1]) | (p[order][1:] != p[order][:-1])][:len(order)]
                key, p, pos = (x[order][first] for x in (key, p, pos))
            keys.append(key)
            places.append(p)
            inner.append(pos)
        if not keys:
            return []
        key, p, pos = (np.concatenate(x) for x in (keys, places, inner))
        band, count = self._distinct(key, p)
        if len(parts) == 1:  # as many places of the item must be met
            count = np.minimum(count, self._distinct(key, pos)[1])
        out = []
        for x in band[count >= self.bound[(band >> 32) % len(self.m)]].tolist():
            r, i = divmod(x >> 32, len(self.m))
            m, k = int(self.m[i]), int(self.k[i])
            low = int(offsets[r]) + ((x & 0xFFFFFFFF) - 1) * (k + 1) - m
            out.append((r, i, max(int(offsets[r]), low - k), min(int(offsets[r + 1]), low + 2 * (k + 1) + m + k)))
        return out

    @staticmethod
    def _distinct(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys and the number of distinct values of each."""
        order = np.lexsort((value, key))
        key, value = key[order], value[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (value[1:] != value[:-1])][:len(key)]
        return np.unique(key[new], return_counts=True)

    def verify(self, i: int, region: bytes) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best span of ``region`` for item ``i``, if within its budget."""
        text, k = self.texts[i], int(self.k[i])
        at = region.find(text)
        if at >= 0:
            return 0, at, at + len(text)
        edits, end = align(text, region, places=self.places[i])
        if edits > k:
            return None
        start = end - align(text[::-1], region[:end][::-1], fixed=True)[1]
        return edits, start, end


    def copies(self, i: int, body: np.ndarray, low: int, high: int, first: int, last: int) -> Iterator[tuple[int, int, int]]:
        """(0, start, end), from ``low``, of the copies of item ``i`` between word borders in
        ``body[low:high]``, of a text in ``body[first:last]``."""
        inside = lambda p: first < p < last and WORD[body[p - 1]] and WORD[body[p]]
        region, text = body[low:high].tobytes(), self.texts[i]
        at = region.find(text)
        while at >= 0:
            if not inside(low + at) and not inside(low + at + len(text)):
                yield 0, at, at + len(text)
            at = region.find(text, at + 1)


def letters(text: bytes) -> dict[int, int]:
    """For each byte the bits of its places in ``text``."""
    out: dict[int, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


def align(text: bytes, region: bytes, fixed: bool = False, places: dict[int, int] | None = None) -> tuple[int, int]:
    """Least edits of ``text`` against a span of ``region``, and the span's end. The span may start
    anywhere, or only at 0 if ``fixed``. ``region`` holds the retained band of diagonals; each column
    of the alignment is a pair of bit vectors over ``text`` (Myers), up and down steps."""
    m = len(text)
    places = letters(text) if places is None else places
    full, top, edge = (1 << m) - 1, 1 << m - 1, int(fixed)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(region, 1):
        eq = places.get(c, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(across | up))
        minus = up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 | edge, minus << 1
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical & full
        if score < best:
            best, end = score, j
    return best, end


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[list[tuple[int | None, str]]]:
    """The query set in blocks, each of bounded size; one block comes to the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n = total // block_bytes + 1
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [(r["item_id"], r["text"]) for r in part.orderBy("item_id").collect()]


def _found(index: Index, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
    """(row, item ids, start, end, edits) of all contained items; places in bytes of the row."""
    body, at, place = canonical(data, offsets)
    span = lambda r, a, b: (int(place[a]) - int(offsets[r]), int(place[b - 1]) + 1 - int(offsets[r]))
    if index.tiny:
        for r in np.flatnonzero((at[1:] > at[:-1]) & (at[1:] - at[:-1] < Q)):
            ids = index.tiny.get(body[at[r]:at[r + 1]].tobytes())
            if ids:
                yield r, ids, *span(r, int(at[r]), int(at[r + 1])), 0
    seen = set()
    for r, i, a, b in index.regions(body, at):
        if index.m[i] < MIN_ITEM:
            hits = index.copies(i, body, a, b, int(at[r]), int(at[r + 1]))
        else:
            hits = [index.verify(i, body[a:b].tobytes())]
        for edits, start, end in filter(None, hits):
            if (r, i, a + start) not in seen and end > start:
                seen.add((r, i, a + start))
                yield r, index.ids[i], *span(r, a + start, a + end), edits


def contained_items(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document, item and place: doc_id, item_id, start and end (code points of the
    text), edits."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, start bigint, end bigint, edits bigint")
    for items in _blocks(benchmark, block_bytes):
        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items)
            for rows, data, offsets in chunks(batches):
                points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                ids = rows.column(0)
                hits = [(ids[r].as_py(), i, int(points[offsets[r] + a] - points[offsets[r]]), int(points[offsets[r] + b] - points[offsets[r]]), e)
                        for r, named, a, b, e in _found(index, rows, data, offsets) for i in named]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*hits, strict=True) if hits else [[]] * 5)],
                                                 ["doc_id", "item_id", "start", "end", "edits"])
        out = out.unionAll(docs.mapInArrow(search, out.schema))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item."""
    schema = docs.schema
    for items in _blocks(benchmark, block_bytes):
        def clean(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items)
            for rows, data, offsets in chunks(batches):
                keep = np.ones(rows.num_rows, bool)
                for r, *_ in _found(index, rows, data, offsets):
                    keep[r] = False
                yield rows.filter(pa.array(keep))
        docs = docs.mapInArrow(clean, schema)
    return docs
