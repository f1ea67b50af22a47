"""Repeated substrings by prefix-free parsing.

A text is cut into phrases at *triggers*, the places where the rolling hash of
``TRIGGER`` bytes is 0 modulo ``MODULUS``; each phrase runs through the trigger
that ends it, so that phrases form a prefix-free dictionary and equal strings
are cut alike wherever they stand. A suffix of the corpus is then a suffix of a
dictionary phrase followed by a suffix of the parse. Here suffixes matter only
to a depth of ``length`` bytes, and only whether a neighbour in corpus order is
equal to that depth. So both orders are kept as classes of equal prefixes
instead of being sorted (sorted order needs a shuffle of every byte position;
see README), from coarse to fine:

1. *Parse classes*: the ``length - REACH`` bytes that follow a trigger, with
   which each window anchored at it begins or continues. A class met once ends
   all windows anchored there; most triggers stop here.
2. *Dictionary and parse together*: the whole string that all windows anchored
   at a trigger cover, from the phrase before it on. Two equal ones settle all
   these windows.
3. Windows one by one, where a repeat begins or ends between triggers: at
   triggers of a parse class that holds a string met once, for one trigger of
   each distinct string.

Windows whose first trigger is ``REACH`` bytes away or more are compared one by
one in round 1 (few, except in text that never triggers).

Texts become blocks, written once. A block sends its distinct keys to buckets,
a bucket answers which of them others sent too; documents that have nothing left
to ask leave after round 1. A key that fills the corpus is one entry per block.
Classes that settle windows are compared by 128 bits.

Defined results: a NULL or empty text has no bytes; rows that repeat a doc_id are
texts of their own, so equal rows of at least ``length`` bytes repeat each other;
a NULL doc_id stays NULL; an empty table gives an empty table. Long texts are
scanned in overlapping pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import LAST_ID, Scratch
from quayside.llm.kernel import Hashes, chunks
from quayside.llm.katz import _PARTS, _SCHEMA, _parts, pack, unpack, word_bucket

LENGTH = 400
TRIGGER = 16
MODULUS_BITS = 5
#: Distance of a window's first trigger beyond which it is compared by itself.
REACH = 160
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 32 << 20
PIECE = 1 << 20

_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0] .. lo[0]+n[0]-1, lo[1] .. and so on."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def classes(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each row with equal keys, in order of the keys, and the first row of each class."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    return at, order[new]


class Scan:
    """Triggers, anchored windows and lone windows of a block of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.data, self.offsets, self.length = data, offsets, length
        reach = min(REACH, length // 2)
        self.context = length - reach
        margin = length + reach + TRIGGER
        trigger, lo, hi, near, whole1, whole2, lone, lone1, lone2 = ([] for _ in range(9))
        cuts = [0]
        for b in offsets[1:].tolist():  # pieces of whole texts, or parts of a long one
            if b - cuts[-1] > PIECE:
                last = int(offsets[np.searchsorted(offsets, b) - 1])
                if last > cuts[-1]:
                    cuts.append(last)
                cuts += range(cuts[-1] + PIECE, b, PIECE)
                cuts.append(b)
        if cuts[-1] < len(data):
            cuts.append(len(data))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            left, right = max(0, a - margin), min(len(data), b + margin)
            hashes, second = Hashes(data[left:right]), None
            n = right - left
            ends = np.minimum(offsets[1:], right) - left
            ends = ends[(offsets[1:] > left) & (offsets[:-1] < right)]
            starts = np.maximum(offsets[:-1], left) - left
            starts = starts[(offsets[1:] > left) & (offsets[:-1] < right)]
            sizes = ends - starts
            start, end = np.repeat(starts, sizes), np.repeat(ends, sizes)
            size = max(0, n - TRIGGER + 1)
            roll = (hashes.sums[TRIGGER:] - hashes.sums[:size]) * hashes.down[:size] * np.uint64(0xD6E8FEB86659FD93)
            t = np.flatnonzero((roll >> np.uint64(64 - MODULUS_BITS)) == 0)
            t = t[t + TRIGGER <= end[t]]
            before = np.r_[-1, t[:-1]][:len(t)]
            low = np.maximum(np.maximum(before + 1, t - reach + 1), start[t])
            high = np.minimum(t, end[t] - length)
            own = (high >= low) & (t + left >= a) & (t + left < b)
            t, low, high = t[own], low[own], high[own]
            trigger.append(t + left)
            lo.append(low + left)
            hi.append(high + left)
            near.append(hashes.span(t, t + self.context))
            second = Hashes(data[left:right], 1)
            whole1.append(hashes.span(low, high + length))
            whole2.append(second.span(low, high + length))
            # windows without a trigger within reach
            anchored = np.zeros(n + 1, np.int32)
            every = np.flatnonzero((roll >> np.uint64(64 - MODULUS_BITS)) == 0)
            every = every[every + TRIGGER <= end[every]]
            np.add.at(anchored, np.maximum(np.maximum(every - reach + 1, 0), start[every]), 1)
            np.add.at(anchored, every + 1, -1)
            i = np.flatnonzero((np.cumsum(anchored)[:-1] == 0) & (np.arange(n) + length <= end))
            i = i[(i + left >= a) & (i + left < b)]
            lone.append(i + left)
            lone1.append(hashes.span(i, i + length))
            lone2.append(second.span(i, i + length))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.trigger, self.lo, self.hi, self.lone = (join(x, np.int64) for x in (trigger, lo, hi, lone))
        self.near, self.whole1, self.whole2, self.lone1, self.lone2 = (join(x, np.uint64) for x in (near, whole1, whole2, lone1, lone2))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of all windows anchored at triggers ``which``, and their keys."""
        lo, n = self.lo[which], self.hi[which] - self.lo[which] + 1
        out, k1, k2 = _ranges(lo, n), [], []
        cut, size = np.searchsorted(out, np.arange(0, len(self.data), PIECE)), len(self.data)
        for a, b in zip(cut, [*cut[1:], len(out)], strict=True):
            i = out[a:b]
            if len(i):
                left, right = int(i[0]), min(size, int(i[-1]) + self.length)
                for k, keys in ((0, k1), (1, k2)):
                    keys.append(Hashes(self.data[left:right], k).span(i - left, i - left + self.length))
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.uint64)
        return out, join(k1), join(k2)


class Asked:
    """Distinct keys of a block in the order in which buckets get and answer them."""

    def __init__(self, buckets: int, *keys: np.ndarray):
        self.at, first = classes(*keys)
        self.keys = [k[first] for k in keys]
        self.many = np.bincount(self.at, minlength=len(first)) > 1
        self.cut = np.searchsorted(word_bucket(self.keys[0], buckets), np.arange(buckets + 1))

    def part(self, b: int) -> list[bytes]:
        s = slice(self.cut[b], self.cut[b + 1])
        return [*[pack(k[s]) for k in self.keys], pack(self.many[s].astype(np.uint8))]

    def answered(self, parts: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """The answer to each row that asked, from (bucket, answers)."""
        out = np.zeros(len(self.many), np.uint8)
        for b, x in parts:
            out[self.cut[b]:self.cut[b + 1]] = x
        return out[self.at]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, made, ids, texts, lengths, size = TaskContext.get().partitionId() << 20, 0, [], [], [], 0

    def block():
        data = np.concatenate(texts)
        return pa.RecordBatch.from_pylist([{"kind": "text", "block": base + made, "bucket": 0, "nums": [len(data)], "data":
                                            [pack(np.concatenate(ids)), pack(np.concatenate(lengths)), pack(data)]}], _SCHEMA)

    for rows, data, offsets in chunks(batches):
        ids.append(rows.column(0).to_numpy())
        texts.append(data)
        lengths.append(np.diff(offsets))
        size += len(data)
        if size >= BLOCK_BYTES:
            yield block()
            ids, texts, lengths, size, made = [], [], [], 0, made + 1
    if ids:
        yield block()


def _text(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, lengths, text = map(unpack, data[:3])
    return ids, np.r_[0, np.cumsum(lengths)], text


def _answers(rows: pa.Table, kind: str, k: int) -> list[tuple[int, np.ndarray]]:
    return [(r["bucket"], unpack(r["data"][k])) for r in rows.to_pylist() if r["kind"] == kind]


def _round1(buckets: int, length: int):
    """Parse classes and lone windows of every block."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                _, offsets, text = _text(r["data"])
                scan = Scan(text, offsets, length)
                near, lone = Asked(buckets, scan.near), Asked(buckets, scan.lone1, scan.lone2)
                for b in range(buckets):
                    if near.cut[b] < near.cut[b + 1] or lone.cut[b] < lone.cut[b + 1]:
                        yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, ("ask", r["block"], b, near.part(b) + lone.part(b), []), strict=True))], _SCHEMA)
    return ask


def _met_twice(keys: list[list[np.ndarray]]) -> list[np.ndarray]:
    """For each sender's keys (key columns, then its own "many"): which are met twice or more."""
    columns = [np.concatenate(x) for x in zip(*keys, strict=True)]
    at, first = classes(*columns[:-1])
    count = np.bincount(at, 1 + columns[-1].astype(np.int64), minlength=len(first))
    return np.split((count > 1)[at].astype(np.uint8), np.cumsum([len(x[0]) for x in keys])[:-1])


def _answer1(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    parts = [list(map(unpack, r["data"])) for r in rows]
    near, lone = _met_twice([p[:2] for p in parts]), _met_twice([p[2:] for p in parts])
    return _parts([("answer1", r["block"], r["bucket"], [pack(a), pack(b)], []) for r, a, b in zip(rows, near, lone, strict=True)])


def _results(ids: np.ndarray, offsets: np.ndarray, text: np.ndarray, starts: np.ndarray, length: int) -> dict:
    """Rows of _RESULT, all windows at ``starts`` removed."""
    change = np.zeros(len(text) + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    gone = np.cumsum(change)[:-1] > 0
    out = {"doc_id": [], "n_bytes": [], "n_removed": [], "spans": [], "kept_sha256": []}
    for i, a, b in zip(ids.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        mine = gone[a:b]
        edge = np.flatnonzero(np.diff(np.r_[False, mine, False].astype(np.int8))).reshape(-1, 2)
        out["doc_id"].append(None if i == LAST_ID else i)
        out["n_bytes"].append(b - a)
        out["n_removed"].append(int(mine.sum()))
        out["spans"].append([{"start": x, "end": y} for x, y in edge.tolist()])
        out["kept_sha256"].append(hashlib.sha256((text[a:b][~mine] if len(edge) else text[a:b]).tobytes()).hexdigest())
    return out


def _round2(buckets: int, length: int):
    """Documents without a repeat leave; the others' text, triggers and settled windows go on."""
    def ask(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _SCHEMA.empty_table()
        number = block.column("block")[0].as_py()
        ids, offsets, text = _text(block.to_pylist()[0]["data"])
        scan = Scan(text, offsets, length)
        near = Asked(buckets, scan.near).answered(_answers(answers, "answer1", 0)).astype(bool)
        lone = scan.lone[Asked(buckets, scan.lone1, scan.lone2).answered(_answers(answers, "answer1", 1)).astype(bool)]
        row = lambda x: np.searchsorted(offsets, x, "right") - 1
        live = np.zeros(len(ids), bool)
        live[row(scan.trigger[near])] = True
        live[row(lone)] = True
        done, sizes = ~live, np.diff(offsets)
        out = []
        if done.any():
            which = np.repeat(done, sizes)
            clean = _results(ids[done], np.r_[0, np.cumsum(sizes[done])], text[which], np.zeros(0, np.int64), length)
            out.append(("clean", number, 0, [pack(ids[done]), pack(np.array(clean["n_bytes"])), b"".join(bytes.fromhex(x) for x in clean["kept_sha256"])], []))
        if live.any():
            moved = offsets[:-1] - np.r_[0, np.cumsum(np.where(live, sizes, 0))][:-1]
            lone = lone - moved[row(lone)]
            x = Asked(buckets, scan.near[near], scan.whole1[near], scan.whole2[near])
            at = moved[row(scan.trigger[near])]
            out.append(("live", number, 0, [pack(ids[live]), pack(sizes[live]), pack(text[np.repeat(live, sizes)]), pack(lone),
                                            *[pack(y[near] - at) for y in (scan.trigger, scan.lo, scan.hi)],
                                            *[pack(y[near]) for y in (scan.near, scan.whole1, scan.whole2)]], []))
            out += [("ask", number, b, x.part(b), []) for b in range(buckets) if x.cut[b] < x.cut[b + 1]]
        return _parts(out)
    return ask


SETTLED, SETTLED_SPEAKS, OPEN = 0, 1, 2


def _answer2(group: pa.Table) -> pa.Table:
    """Strings met twice settle their windows; in parse classes with a string met once, one
    sender of each distinct string goes on to compare windows."""
    rows = group.to_pylist()
    parts = [list(map(unpack, r["data"])) for r in rows]
    near, whole1, whole2, many = (np.concatenate(x) for x in zip(*parts, strict=True))
    at, first = classes(near, whole1, whole2)
    once = np.bincount(at, 1 + many.astype(np.int64), minlength=len(first)) == 1
    parse, _ = classes(near)
    mixed = np.zeros(int(parse.max(initial=-1)) + 1, bool)
    mixed[parse[first[once]]] = True
    speaks = np.zeros(len(near), bool)
    speaks[first] = True
    state = np.where(once[at], OPEN, np.where(speaks & mixed[parse], SETTLED_SPEAKS, SETTLED)).astype(np.uint8)
    return _parts([("answer2", r["block"], r["bucket"], [pack(x)], []) for r, x in
                   zip(rows, np.split(state, np.cumsum([len(p[0]) for p in parts])[:-1]), strict=True)])


class _Live:
    """The documents of a block that round 2 left, with the state of their triggers."""

    def __init__(self, block: pa.Table, answers: pa.Table, buckets: int, length: int):
        data = block.to_pylist()[0]["data"]
        self.ids, self.offsets, self.text = _text(data)
        lone, trigger, lo, hi, near, whole1, whole2 = map(unpack, data[3:])
        scan = self.scan = object.__new__(Scan)
        scan.data, scan.length, scan.trigger, scan.lo, scan.hi = self.text, length, trigger, lo, hi
        state = Asked(buckets, near, whole1, whole2).answered(_answers(answers, "answer2", 0))
        settled = np.flatnonzero(state != OPEN)
        self.starts = np.r_[lone, _ranges(lo[settled], hi[settled] - lo[settled] + 1)]
        self.windows, k1, k2 = scan.windows(np.flatnonzero(state != SETTLED))
        self.asked = Asked(buckets, k1, k2)


def _round3(buckets: int, length: int):
    def ask(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _SCHEMA.empty_table()
        x = _Live(block, answers, buckets, length).asked
        number = block.column("block")[0].as_py()
        return _parts([("ask", number, b, x.part(b), []) for b in range(buckets) if x.cut[b] < x.cut[b + 1]])
    return ask


def _answer3(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    met = _met_twice([list(map(unpack, r["data"])) for r in rows])
    return _parts([("answer3", r["block"], r["bucket"], [pack(x)], []) for r, x in zip(rows, met, strict=True)])


def _table(x: dict) -> pa.Table:
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(x.items(), [pa.int64()] * 3 + [_SPANS, pa.string()], strict=True)})


def _finish(buckets: int, length: int):
    def finish(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _table({k: [] for k in ("doc_id", "n_bytes", "n_removed", "spans", "kept_sha256")})
        x = _Live(block, answers, buckets, length)
        met = x.asked.answered(_answers(answers, "answer3", 0)).astype(bool)
        return _table(_results(x.ids, x.offsets, x.text, np.unique(np.r_[x.starts, x.windows[met]]), length))
    return finish


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            ids, n = map(unpack, r["data"][:2])
            sha = r["data"][2]
            yield from _table({"doc_id": [None if i == LAST_ID else i for i in ids.tolist()], "n_bytes": n.tolist(), "n_removed": [0] * len(n),
                               "spans": [[]] * len(n), "kept_sha256": [sha[i:i + 32].hex() for i in range(0, len(sha), 32)]}).to_batches()


def repeated_spans(docs: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: the maximal spans of bytes covered by a ``length``-byte
    string that also starts anywhere else, their total, and the digest of the other bytes."""
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    names = _SCHEMA.names
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc_id"), "text")
    blocks = scratch.save(rows.mapInArrow(_blocks, _PARTS))
    buckets = (blocks.agg(F.sum(F.col("nums")[0])).head()[0] or 0) // bucket_bytes + 1

    asked = blocks.mapInArrow(_round1(buckets, length), _PARTS)
    first = scratch.save(asked.groupBy("bucket").applyInArrow(_answer1, _PARTS))
    split = scratch.save(blocks.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(_round2(buckets, length), _PARTS), "kind")
    scratch.drop(blocks, first)
    live = split.where("kind = 'live'").select(*names)
    second = scratch.save(split.where("kind = 'ask'").select(*names).groupBy("bucket").applyInArrow(_answer2, _PARTS))
    asked = live.groupBy("block").cogroup(second.groupBy("block")).applyInArrow(_round3(buckets, length), _PARTS)
    third = scratch.save(asked.groupBy("bucket").applyInArrow(_answer3, _PARTS))
    answers = second.unionAll(third)
    out = live.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_finish(buckets, length), _RESULT)
    return out.unionAll(split.where("kind = 'clean'").select(*names).mapInArrow(_clean, _RESULT))
