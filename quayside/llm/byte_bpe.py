"""Byte-level BPE encoding and decoding by prefix dynamic programming.

A text is cut into pieces by the tokenizer's pattern; each piece is encoded by itself.
A sequence of tokens is the encoding of its bytes exactly if each two neighbours are
the encoding of theirs. So the encoding of a prefix is that of a shorter one plus one
token, and every prefix has exactly one token that can be its last. A piece keeps that
*last token of each prefix* and nothing else:

* encoding walks back through last tokens from the end;
* appending bytes adds entries and changes none (``Prefixes.append``);
* an edit keeps the entries before it (``Prefixes.cut``); in a text, the pieces before
  the edit stay, and those after it from where the old and new cuts meet again
  (``Encoded.replace``).

Two tokens are neighbours in an encoding if no merge across their border comes before
the merges that made them: ``Vocabulary.adjacent`` undoes the later of the two border
tokens' merges step by step and looks for a token that spans the border and would
have been made earlier.

Spark part: ``encode_texts`` and ``decode_ids`` are maps without a shuffle; tasks get
the vocabulary as plain tables by broadcast (its file is checked to be below
``VOCABULARY_BYTES``) and keep the encodings of up to ``2 * CACHED`` short pieces. Long
texts are cut and encoded ``PIECES`` pieces at a time. New pieces are encoded in
order, each from the prefix table of the one before.

Defined results: a NULL or empty text has no tokens and decodes to no bytes; strings of
special tokens in a text are ordinary text; bytes that are not UTF-8 count as U+FFFD;
repeated rows and ids, and NULL ids, are rows of their own; an empty table gives an
empty table; an id outside the vocabulary is an error of the decoder.
"""

from __future__ import annotations

import base64
import os
import sys
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.kernel import chunks, texts

VOCABULARY_BYTES = 64 << 20
#: Short pieces whose tokens a worker remembers, in each of two generations, and their greatest length.
CACHED, SHORT = 1 << 18, 48
#: Pairs of tokens that a worker remembers.
PAIRS = 1 << 19
#: Bytes of texts cut at once, and pieces of a longer text.
CHUNK_BYTES, PIECES = 2 << 20, 1 << 17
#: A match of the pattern depends on no character further than this beyond its end.
AHEAD = 3
#: Code points that are letters or digits since Unicode 17 or later. The tokenizer's tables are
#: those of Unicode 16, to which they are unassigned, and the ``regex`` module's are newer.
LATER_LETTERS = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 "
    "10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
    "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 "
    "1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F")
#: UTF-8 has no byte from here on before U+0540, nor any of the above.
LATER_BYTE = 0xD5
LATER_DIGITS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each token's bytes, from a file of lines "base64 rank"."""
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is over {VOCABULARY_BYTES} bytes, too large to send to every worker")
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def merged(data: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Parts of ``data`` after all merges of rank less than ``below``, lowest and leftmost first."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank >= below:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def split_table(ranks: dict[bytes, int]) -> dict[int, tuple[int, int] | None]:
    """The two tokens that merge into each token, None for single bytes; tokens that merging never makes are missing."""
    out: dict[int, tuple[int, int] | None] = {}
    for token, rank in ranks.items():
        parts = [token] if len(token) == 1 else merged(token, ranks, rank)
        if len(token) == 1:
            out[rank] = None
        elif len(parts) == 2:
            out[rank] = ranks[parts[0]], ranks[parts[1]]
    return out


def cutter(pattern: str) -> regex.Pattern:
    """The compiled pattern, with the letters and digits of the tokenizer's Unicode version."""
    for name, later in (("L", LATER_LETTERS), ("N", LATER_DIGITS)):
        ranges = "".join("-".join(f"\\U{int(x, 16):08X}" for x in r.split("-")) for r in later.split())
        pattern = pattern.replace(rf"\p{{{name}}}", rf"[\p{{{name}}}--[{ranges}]]")
    return regex.compile(pattern, regex.V1)


class Vocabulary:
    """Lookup tables of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], split: dict[int, tuple[int, int] | None]):
        self.ranks, self.split = ranks, split
        self.token = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[int, bool] = {}
        self.shift = max(self.token).bit_length()
        # tokens by their bytes from the last to the first: node and byte -> node, node -> token or -1
        self.step: dict[int, int] = {}
        for rank in split:
            node = 0
            for byte in reversed(self.token[rank]):
                node = self.step.setdefault(node << 8 | byte, len(self.step) + 1)
        self.ends = [-1] * (len(self.step) + 1)
        for rank in split:
            node = 0
            for byte in reversed(self.token[rank]):
                node = self.step[node << 8 | byte]
            self.ends[node] = rank

    def adjacent(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens are encoded as just these two."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        known = self.pairs[left << self.shift | right] = self._adjacent(left, right)
        return known

    def _adjacent(self, left: int, right: int) -> bool:
        before = len(self.ranks) + max(left, right) + 1  # rank of the merge undone last; none so far
        while True:
            across = self.ranks.get(self.token[left] + self.token[right])
            if across is not None and across < before:
                return False
            parts, other = self.split[left], self.split[right]
            # of equal ranks the left merge comes first, so the right one is undone first
            if other is not None and (parts is None or right >= left):
                before, right = right + 1, other[0]
            elif parts is not None:
                before, left = left, parts[1]
            else:
                return True


class Prefixes:
    """The last token of every prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, bytearray(), array("q")
        self.append(data)

    def append(self, more: bytes) -> None:
        v, data, last = self.vocabulary, self.data, self.last
        step, ends, pairs, shift = v.step, v.ends, v.pairs, v.shift
        at = len(data)
        data += more
        for end in range(at, len(data)):
            node, start = 0, end
            while True:
                node = step.get(node << 8 | data[start])
                if node is None:
                    raise ValueError("bytes that the vocabulary cannot encode")
                token = ends[node]
                if token >= 0:
                    if not start:
                        break
                    known = pairs.get(last[start - 1] << shift | token)
                    if known or known is None and v.adjacent(last[start - 1], token):
                        break
                start -= 1
                if start < 0:
                    raise ValueError("bytes that the vocabulary cannot encode")
            last.append(token)

    def cut(self, size: int) -> None:
        """Keep the first ``size`` bytes."""
        del self.data[size:], self.last[size:]

    def change(self, data: bytes) -> None:
        """Become the table of ``data``; what both have in front is kept."""
        same = len(os.path.commonprefix((bytes(self.data), data)))
        self.cut(same)
        self.append(data[same:])

    def tokens(self) -> list[int]:
        whole = self.vocabulary.ranks.get(bytes(self.data))
        if whole is not None:  # a piece that is a token is that token, made by merging or not
            return [whole]
        out, at, sizes = [], len(self.data), self.vocabulary.token
        while at:
            out.append(self.last[at - 1])
            at -= len(sizes[out[-1]])
        return out[::-1]


class Encoded:
    """A text with the prefix tables of its pieces, for appends and edits."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, text: str = ""):
        self.vocabulary, self.cutter = vocabulary, cutter(pattern)
        self.text = ""
        self.starts: list[int] = []
        self.pieces: list[Prefixes] = []
        self.replace(0, 0, text)

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of the characters from ``start`` to ``end``."""
        text, moved = self.text[:start] + new + self.text[end:], len(new) - (end - start)
        ends = [*self.starts[1:], len(self.text)][:len(self.starts)]
        first = next((i for i, e in enumerate(ends) if e + AHEAD > start), len(self.starts))
        at = self.starts[first] if first < len(self.starts) else len(self.text)
        old = {s + moved: i for i, s in enumerate(self.starts) if s >= end}  # cuts after the edit, by their new place
        starts, pieces, rest = [], [], len(self.starts)
        for m in self.cutter.finditer(text, at):
            if m.start() in old:
                rest = old[m.start()]
                break
            data = m.group().encode()
            if not pieces and first < len(self.starts) and self.starts[first] < end:
                piece = self.pieces[first]  # the piece that the edit meets: its front may be as it was
                piece.change(data)
            else:
                piece = Prefixes(self.vocabulary, data)
            starts.append(m.start())
            pieces.append(piece)
        self.starts[first:] = starts + [s + moved for s in self.starts[rest:]]
        self.pieces[first:] = pieces + self.pieces[rest:]
        self.text = text

    def tokens(self) -> list[int]:
        return [t for p in self.pieces for t in p.tokens()]


class Pieces(dict):
    """Tokens of pieces as little-endian 32-bit integers. Short pieces are remembered in two
    generations: a full one becomes the old one, from which what is met again is taken over."""

    def __init__(self, vocabulary: Vocabulary):
        self.table, self.old = Prefixes(vocabulary), {}

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            self.table.change(piece.encode())
            out = array("I", self.table.tokens())
            if sys.byteorder == "big":
                out.byteswap()
            out = out.tobytes()
        if len(piece) <= SHORT:
            self[piece] = out
        return out

    def learn(self, pieces: set[str]) -> None:
        """Encode new pieces in order, each from what it has in common with the one before."""
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        for piece in sorted(pieces - self.keys()):
            self[piece]


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def _rows(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The bytes of each row's second column; NULL is empty."""
    data, offsets = texts(batch.column(1))
    whole = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield whole[a:b]


def _encode(tables, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = tables.value
        if "pieces" not in state:  # once for each worker process
            state["pieces"] = Pieces(Vocabulary(state["ranks"], state["split"]))
        known, early, exact = state["pieces"], regex.compile(pattern), cutter(pattern)

        def cut(data: np.ndarray) -> Iterator[list[str]]:
            text = data.tobytes().decode("utf-8", "replace")
            by = early if data.max(initial=0) < LATER_BYTE else exact
            if len(data) <= CHUNK_BYTES:
                yield by.findall(text)
                return
            found = by.finditer(text)
            while some := [m.group() for m in islice(found, PIECES)]:
                yield some

        def encoded(pieces: list[str]) -> bytes:
            return b"".join(map(known.__getitem__, pieces))

        for rows, data, offsets in chunks(batches, "text", CHUNK_BYTES):
            if len(data) > CHUNK_BYTES:  # one long text
                parts = []
                for some in cut(data):
                    known.learn(set(some))
                    parts.append(encoded(some))
                out = [b"".join(parts)]
            else:
                cuts = [next(cut(data[a:b])) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                known.learn(set().union(*cuts))
                out = [encoded(x) for x in cuts]
            yield pa.RecordBatch.from_arrays([rows.column(0), _binary(out)], ["id", "ids"])
    return run


def _decode(tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = tables.value
        if "bytes" not in state:
            state["bytes"] = {rank: token for token, rank in state["ranks"].items()}
        of = state["bytes"].__getitem__
        for batch in batches:
            out = [b"".join(map(of, np.frombuffer(ids, "<u4").tolist())) for ids in _rows(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns, _binary(out)], ["id", "ids", "decoded"])
    return run


class Codec:
    """Encoder and decoder of one vocabulary file for whole tables."""

    def __init__(self, spark, path: str, pattern: str):
        ranks = read_ranks(path)
        self.pattern = pattern
        self.tables = spark.sparkContext.broadcast({"ranks": ranks, "split": split_table(ranks)})

    def encode_texts(self, df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
        """(id, ids): the tokens of each row's whole text as little-endian unsigned 32-bit integers."""
        rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
        kind = dict(rows.dtypes)["id"]
        return rows.mapInArrow(_encode(self.tables, self.pattern), f"id {kind}, ids binary").withColumnRenamed("id", id_column)

    def decode_ids(self, df: DataFrame, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
        """(id, ids, decoded): the bytes of each row's tokens."""
        rows = df.select(F.col(id_column).alias("id"), F.col(ids).alias("ids"))
        kind = dict(rows.dtypes)["id"]
        return rows.mapInArrow(_decode(self.tables), f"id {kind}, ids binary, decoded binary").withColumnRenamed("id", id_column)
