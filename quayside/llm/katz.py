"""Katz backoff language model of order two, and the score of every text under it.

    P(w | h) = d(c(h,w)) c(h,w) / c(h)         if c(h,w) > 0
             = alpha(h) P(w)                   otherwise, or P(w) if h was never seen
    P(w)     = d(c(w)) c(w) / N                if c(w) > 0
             = what is left                    for the one class of unknown words

d are Good-Turing discounts of counts up to ``LOW`` (those that lie strictly
between 0 and 1), alpha(h) is what the discounts leave of h divided by the
unigram mass of the words not seen after h: both levels sum to one exactly over
the known words, the end and the unknown class. Where discounts leave nothing, a
pseudo-count of one does.

Counting and scoring are one exchange. Texts become token blocks, written once;
a block asks for its distinct words, later for its distinct word pairs, each
with its own training count. A bucket adds up the counts of all blocks, keeps
them as a part of the model (a partitioned table, sorted by key), and answers
with the sums. So what travels is pre-aggregated per block: a word or pair that
fills the corpus is one entry of each block. Buckets follow from the number of
tokens; a history with more than ``split`` occurrences is spread over several.
No vocabulary, n-gram or score passes through the driver: only ``LOW + 3`` sums
per level do.

The order is two; README says what order three would cost.

Defined results: a NULL or empty text is one end token; a row whose ``held_out``
is NULL, as for a NULL doc_id, teaches; rows that repeat a doc_id are scored and
counted each; without training documents every token has probability 1, as in
the base score; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import LAST_ID, Scratch
from quayside.llm.kernel import chunks, mix, word_hashes

#: Counts up to LOW are discounted.
LOW = 5
#: Bytes of text of a token block, tokens of a bucket, occurrences of a history per bucket.
BLOCK_BYTES = 8 << 20
BUCKET_TOKENS = 2_000_000
SPLIT = 1 << 20

_END = np.uint64(0x656E64)
_START = np.int64(1 << 62)
_PARTS = "kind string, block bigint, bucket int, data array<binary>, nums array<bigint>"
_SCHEMA = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("bucket", pa.int32()),
                     ("data", pa.list_(pa.binary())), ("nums", pa.list_(pa.int64()))])
_SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
           "base_score double, score double")


def pack(x: np.ndarray) -> bytes:
    """Compressed array: the bytes of all values by significance."""
    x = np.ascontiguousarray(x)
    flat = x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()
    return b"%s,%d;" % (x.dtype.str.encode(), len(x)) + (pa.compress(flat, "zstd", asbytes=True) if flat else b"")


def unpack(data: bytes) -> np.ndarray:
    head, _, body = data.partition(b";")
    kind, _, n = head.partition(b",")
    kind, n = np.dtype(kind.decode()), int(n)
    if not n:
        return np.zeros(0, kind)
    flat = np.frombuffer(pa.decompress(body, n * kind.itemsize, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(kind.itemsize, n).T).view(kind).ravel()


def _parts(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(_SCHEMA.names, r, strict=True)) for r in rows], _SCHEMA)


def word_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the hash, so that a sorted vocabulary falls into runs."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _token_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, made = TaskContext.get().partitionId() << 20, 0
    ids, held, hashes, lengths, size = [], [], [], [], 0

    def block():
        tokens = np.concatenate(hashes)
        words, local = np.unique(tokens, return_inverse=True)
        n = np.concatenate(lengths)
        out = np.concatenate(held)
        taught = np.bincount(local[~np.repeat(out, n)], minlength=len(words))
        return pa.RecordBatch.from_pylist([
            {"kind": "tokens", "block": base + made, "bucket": 0, "nums": [len(tokens)], "data":
             [pack(np.concatenate(ids)), pack(out.astype(np.uint8)), pack(n.astype(np.int32)), pack(local.astype(np.int32))]},
            {"kind": "words", "block": base + made, "bucket": 0, "nums": [], "data": [pack(words), pack(taught)]}], _SCHEMA)

    for rows, data, offsets in chunks(batches):
        h, at = word_hashes(data, offsets)
        hashes.append(np.insert(h, at[1:], _END))
        lengths.append(np.diff(at) + 1)
        ids.append(rows.column(0).to_numpy())
        held.append(rows.column(1).to_numpy(zero_copy_only=False))
        size += len(data)
        if size >= BLOCK_BYTES:
            yield block()
            ids, held, hashes, lengths, size, made = [], [], [], [], 0, made + 1
    if ids:
        yield block()


def _deal_words(buckets: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words, taught = map(unpack, r["data"])
                cut = np.searchsorted(word_bucket(words, buckets), np.arange(buckets + 1))
                yield pa.RecordBatch.from_pylist([
                    {"kind": "words", "block": r["block"], "bucket": b, "nums": [], "data": [pack(words[cut[b]:cut[b + 1]]), pack(taught[cut[b]:cut[b + 1]])]}
                    for b in np.flatnonzero(np.diff(cut)).tolist()], _SCHEMA)
    return deal


def _low_counts(c: np.ndarray) -> list[int]:
    """Numbers of keys with count 1 .. LOW + 1, then all occurrences and all keys."""
    return [*np.bincount(np.minimum(c, LOW + 2), minlength=LOW + 3)[1:LOW + 2].tolist(), int(c.sum()), int((c > 0).sum())]


def _add_words(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    bucket = rows[0]["bucket"]
    parts = [list(map(unpack, r["data"])) for r in rows]
    words, at = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
    c = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
    out, pos = [("model", 0, bucket, [pack(words), pack(c)], []), ("sums", 0, bucket, [], _low_counts(c))], 0
    for r, (w, _) in zip(rows, parts, strict=True):
        mine = at[pos:pos + len(w)]
        out.append(("words", r["block"], bucket, [pack(mine + (np.int64(bucket) << 32)), pack(c[mine])], []))
        pos += len(w)
    return _parts(out)


class Discounts:
    """Good-Turing discounts from the sums of one level."""

    def __init__(self, sums: list[int]):
        n, self.tokens, self.types = np.array([0, *sums[:LOW + 1]], float), sums[LOW + 1], sums[LOW + 2]
        self.d = np.ones(LOW + 1)
        if n[1]:
            for r in range(1, LOW + 1):
                # Katz's form, with the discounts of counts above LOW at one
                cut = (LOW + 1) * n[LOW + 1] / n[1]
                d = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut < 1 else 1.0
                self.d[r] = d if 0 < d < 1 else 1.0
            if (self.d == 1).all():
                self.d[1] = 0.5
        self.left = float((n[1:LOW + 1] * np.arange(1, LOW + 1) * (1 - self.d[1:])).sum())

    def of(self, c: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return c * np.where(c <= LOW, self.d[np.minimum(c, LOW)], 1.0)


class Unigrams(Discounts):
    def p(self, c: np.ndarray) -> np.ndarray:
        """Probabilities by count; count 0 is the class of unknown words."""
        if not self.tokens:
            return np.ones(len(c))
        left, total = (self.left, self.tokens) if self.left else (1.0, self.tokens + 1.0)
        return np.where(c > 0, self.of(c), left) / total


class _Block:
    """A token block, the model's answer to its words, and its distinct pairs, the same at every call."""

    def __init__(self, tokens: pa.Table, answers: list[dict], buckets: int, split: int):
        self.ids, held, self.n, self.local = map(unpack, tokens.to_pylist()[0]["data"])
        self.block, self.held = tokens.column("block")[0].as_py(), held.astype(bool)
        known = sorted((r for r in answers if r["kind"] == "words"), key=lambda r: r["bucket"])
        # one more local word: the start of a text, seen as a history once for every end
        self.word = np.r_[np.concatenate([unpack(r["data"][0]) for r in known]), _START]
        self.c = np.concatenate([unpack(r["data"][1]) for r in known])
        size = len(self.word)
        first = np.cumsum(self.n) - self.n
        end = self.local[-1]
        before = np.r_[size - 1, self.local[:-1]].astype(np.int64)
        before[first] = size - 1
        self.first, self.c = first, np.r_[self.c, self.c[end]]
        key, self.pair = np.unique(before * size + self.local, return_inverse=True)
        self.h, self.w = key // size, key % size
        self.taught = np.bincount(self.pair[~np.repeat(self.held, self.n)], minlength=len(key))
        ch = self.c[self.h]
        pieces = 1 + ch // split
        self.asked = np.flatnonzero((ch > 0) & (self.c[self.w] > 0))
        piece = (mix(self.word[self.w].astype(np.uint64)) % pieces.astype(np.uint64)).astype(np.int64)
        to = self.bucket(self.word[self.h], piece, buckets)[self.asked]
        self.asked = self.asked[np.argsort(to, kind="stable")]
        self.cut = np.searchsorted(np.sort(to), np.arange(buckets + 1))
        # histories whose leftover may be needed: not all pairs taught here, or several pieces
        need = np.unique(self.h[(ch > 0) & ((self.taught == 0) | (pieces > 1))])
        many = 1 + self.c[need] // split
        self.need = np.repeat(need, many)
        to = self.bucket(self.word[self.need], np.arange(len(self.need)) - np.repeat(np.cumsum(many) - many, many), buckets)
        asked = np.unique(to * size + self.need)  # a bucket answers for all pieces it holds
        self.need, self.need_cut = asked % size, np.searchsorted(asked // size, np.arange(buckets + 1))
        self.split = pieces > 1

    @staticmethod
    def bucket(word: np.ndarray, piece: np.ndarray, buckets: int) -> np.ndarray:
        return (mix(mix(word.astype(np.uint64)) + piece.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _ask_pairs(buckets: int, split: int):
    def ask(tokens: pa.Table, answers: pa.Table) -> pa.Table:
        if not tokens.num_rows:
            return _SCHEMA.empty_table()
        x, out = _Block(tokens, answers.to_pylist(), buckets, split), []
        for b in range(buckets):
            i, j = x.asked[x.cut[b]:x.cut[b + 1]], x.need[x.need_cut[b]:x.need_cut[b + 1]]
            if len(i) or len(j):
                out.append(("pairs", x.block, b, [pack(x.word[x.h[i]]), pack(x.word[x.w[i]]), pack(x.taught[i].astype(np.int32)),
                                                  pack(x.c[x.w[i]]), pack(x.word[j])], []))
        return _parts(out)
    return ask


def _add_pairs(unigrams: Unigrams):
    def add(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        bucket = rows[0]["bucket"]
        parts = [list(map(unpack, r["data"])) for r in rows]
        h, w, taught, cw = (np.concatenate([p[k] for p in parts]) for k in range(4))
        hs, hi = np.unique(h, return_inverse=True)
        ws, wi = np.unique(w, return_inverse=True)
        key, first, at = np.unique(hi * max(1, len(ws)) + wi, return_index=True, return_inverse=True)
        c = np.bincount(at, taught, minlength=len(key)).astype(np.int64)
        own = hi[first]
        low = np.stack([np.bincount(own[c == r], minlength=len(hs)) for r in range(1, LOW + 1)], 1)
        seen = np.bincount(own[c > 0], unigrams.p(cw[first][c > 0]), minlength=len(hs))
        lows = ((low > 0) << np.arange(LOW)).sum(1).astype(np.uint8)
        live = c > 0
        out = [("model", 0, bucket, [pack(hs), pack(np.bincount(own[live], minlength=len(hs))), pack(w[first][live]), pack(c[live])], []),
               ("sums", 0, bucket, [], _low_counts(c))]
        pos = 0
        for r, p in zip(rows, parts, strict=True):
            mine = at[pos:pos + len(p[0])]
            pos += len(mine)
            need = np.searchsorted(hs, p[4])
            there = need < len(hs)
            there[there] = hs[need[there]] == p[4][there]
            left, sums = np.zeros((len(need), LOW), np.int64), np.zeros(len(need))
            left[there], sums[there] = low[need[there]], seen[need[there]]
            out.append(("pairs", r["block"], bucket, [pack(c[mine]), pack(lows[own[mine]]), pack(left.ravel()), pack(sums)], []))
        return _parts(out)
    return add


def _score(buckets: int, split: int, unigrams: Unigrams, pairs: Discounts):
    def score(tokens: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not tokens.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, [pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2], strict=True)})
        answers = answers.to_pylist()
        x = _Block(tokens, answers, buckets, split)
        c, lows = np.zeros(len(x.h), np.int64), np.zeros(len(x.h), np.uint8)
        low, seen = np.zeros((len(x.word), LOW), np.int64), np.zeros(len(x.word))
        for r in sorted((r for r in answers if r["kind"] == "pairs"), key=lambda r: r["bucket"]):
            b = r["bucket"]
            i, j = x.asked[x.cut[b]:x.cut[b + 1]], x.need[x.need_cut[b]:x.need_cut[b + 1]]
            c[i], lows[i] = unpack(r["data"][0]), unpack(r["data"][1])
            np.add.at(low, j, unpack(r["data"][2]).reshape(-1, LOW))
            np.add.at(seen, j, unpack(r["data"][3]))
        # a pair that is not seen has its history's leftover in ``low``, as has one of several pieces
        lone = (c == 0) | x.split
        lows[lone] = ((low[x.h[lone]] > 0) << np.arange(LOW)).sum(1)
        cut = int(((pairs.d[1:] < 1) << np.arange(LOW)).sum())
        full = (lows & cut) == 0  # no discount leaves anything: one pseudo-count does
        ch = np.maximum(1, x.c[x.h])
        denominator = np.where(full, ch + 1.0, ch)
        left = np.where(full, 1.0, (low * np.arange(1, LOW + 1) * (1 - pairs.d[1:])).sum(1)[x.h])
        p = unigrams.p(x.c[x.w])
        back = np.where(x.c[x.h] > 0, left / denominator / (1 - seen[x.h]) * p, p)
        p = np.where(c > 0, np.where(full, c, pairs.of(c)) / denominator, back)
        count = x.c[x.local]
        n = unigrams.tokens
        base = np.log10((count + 0.1) / (n + 0.1 * (unigrams.types + 1)))
        doc = np.where(x.ids == LAST_ID, 0, x.ids)
        return pa.table([pa.array(doc, mask=x.ids == LAST_ID), pa.array(x.held), pa.array(x.n.astype(np.int64)),
                         pa.array(np.add.reduceat((count > 0).astype(np.int64), x.first)), pa.array(np.full(len(x.n), n)),
                         pa.array(np.add.reduceat(base, x.first)), pa.array(np.add.reduceat(np.log10(p)[x.pair], x.first))], names=names)
    return score


def _sums(df: DataFrame) -> list[int]:
    rows = (df.where("kind = 'sums'").select(F.posexplode("nums").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n"))
            .orderBy("i").collect())  # LOW + 3 numbers
    return [r["n"] for r in rows] or [0] * (LOW + 3)


def katz_scores(docs: DataFrame, held_out: Column, bucket_tokens: int = BUCKET_TOKENS, split: int = SPLIT) -> DataFrame:
    """One row per row of ``docs``: learn from the rows where ``held_out`` is false, score all."""
    scratch = Scratch(docs.sparkSession, "katz")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc_id"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    made = scratch.save(rows.mapInArrow(_token_blocks, _PARTS), "kind")
    tokens = made.where("kind = 'tokens'").select(*_SCHEMA.names)
    total = tokens.agg(F.sum(F.col("nums")[0])).head()[0] or 0
    buckets = total // bucket_tokens + 1

    asked = made.where("kind = 'words'").select(*_SCHEMA.names).mapInArrow(_deal_words(buckets), _PARTS)
    words = scratch.save(asked.groupBy("bucket").applyInArrow(_add_words, _PARTS), "kind")
    unigrams = Unigrams(_sums(words))
    answers = words.where("kind = 'words'").select(*_SCHEMA.names)

    asked = tokens.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_ask_pairs(buckets, split), _PARTS)
    pairs = scratch.save(asked.groupBy("bucket").applyInArrow(_add_pairs(unigrams), _PARTS), "kind")
    discounts = Discounts(_sums(pairs))
    answers = answers.unionAll(pairs.where("kind = 'pairs'").select(*_SCHEMA.names))
    return tokens.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(buckets, split, unigrams, discounts), _SCORES)
