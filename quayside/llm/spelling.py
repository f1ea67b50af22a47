"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

1. Words are counted; those of ``MIN_CHARS`` code points and ``MIN_COUNT`` occurrences
   or more are points: a word's vector holds how often it has each letter. One edit
   changes at most one count up and one down: L1 distance two for a replaced letter,
   one for an inserted or deleted one.
2. A word looks for its near words among those of its own length, one more and one
   less. For every length a k-d tree splits count space; its leaves are *cells*, one
   group of points each. The split planes come from a bounded sample (``SAMPLE``
   vectors): they decide how even cells are, not what is found. A word is a point of
   one cell and a query to every cell whose box its vector can enter with the counts
   the edit may change. Points with one vector, which no plane parts, are dealt to
   several cells by hash and queried in all of them.
3. A cell builds its own k-d tree down to ``LEAF`` points, sends all its queries down
   together, prunes by the same box rule, and verifies the order of letters for what
   remains. A query leaves with its number of near words and the best of them.
4. ``form`` is the near word of largest n (ties: first in code-point order) if that is at
   least ``TIMES`` the word's n. Since n grows along forms, following them ends; roots
   are found by doubling, each round a written table.

No task holds more than a cell and its queries, and only vectors of the sample and one
row of counts reach the driver.

Defined results: NULL and empty texts have no runs; a NULL doc_id counts as the empty
text; repeated rows count each; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Scratch, ascii_lower

RUN = r"[A-Za-zÀ-ÿ]+"
#: Letters after lower-casing A-Z: a to z, then U+00C0 to U+00FF.
LETTERS = 26 + 64
MIN_CHARS, MIN_COUNT, TIMES = 5, 3, 2
SAMPLE = 100_000
#: Points of a cell, and cells at most (beyond that, cells grow).
CELL, CELLS = 8192, 10_000
LEAF = 16
#: Letters compared at once when candidates are verified.
VERIFY = 1 << 22
#: By how much longer the point is than the query: counts that may go up and down on the way there.
STEPS = {0: (1, 1), 1: (1, 0), -1: (0, 1)}

_ROUTED = "length int, cell int, share int, query boolean, word string, n bigint"
_FOUND = "word string, n_near bigint, form string, form_n bigint"


def word_counts(docs: DataFrame, every: int = 97) -> DataFrame:
    """(word, n) over whole texts: runs of letters, one letter deleted where the crc32 of
    ``<doc_id>:<run>`` is a multiple of ``every``."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("id", ascii_lower(F.col("run")).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= MIN_CHARS).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    """How often each row has each letter."""
    which = np.where(codes < 0x80, codes.astype(np.int64) - 97, codes.astype(np.int64) - 0xC0 + 26)
    which += np.arange(len(codes))[:, None] * LETTERS
    counts = np.bincount(which.ravel(), minlength=len(codes) * LETTERS).reshape(-1, LETTERS)
    return counts.astype(np.int16 if codes.shape[1] < 1 << 15 else np.int64)


def split(points: np.ndarray) -> tuple[int, int] | None:
    """The letter and count (at most this many go left) that part the points most evenly; None if no plane parts them."""
    middle = np.partition(points, len(points) // 2, axis=0)[len(points) // 2]
    best = None
    for top in (middle, middle - 1):
        left = (points <= top).sum(0)
        even = np.minimum(left, len(points) - left)
        letter = int(even.argmax())
        if even[letter] and (best is None or even[letter] > best[0]):
            best = int(even[letter]), letter, int(top[letter])
    return best and best[1:]


def visit(node, queries: np.ndarray, rows: np.ndarray, up: np.ndarray, down: np.ndarray, moved: dict[int, tuple[np.ndarray, np.ndarray]]):
    """(leaf, rows) for every leaf of a tree whose box some of ``queries[rows]`` can enter.

    ``up`` and ``down`` are the changes each row has left, ``moved`` those it has spent on
    a letter on the way (planes of one letter do not add up). A tree is a leaf or
    (letter, count, left, right).
    """
    if not len(rows):
        return
    if not isinstance(node, tuple):
        yield node, rows
        return
    letter, top, *sides = node
    value = queries[rows, letter]
    spent_up, spent_down = moved.get(letter, (0, 0))
    for side, need_up, need_down in ((sides[0], 0, np.maximum(value - top, 0)), (sides[1], np.maximum(top + 1 - value, 0), 0)):
        more_up, more_down = np.maximum(need_up - spent_up, 0), np.maximum(need_down - spent_down, 0)
        keep = np.flatnonzero((more_up <= up) & (more_down <= down))
        if len(keep) < len(rows):
            at = lambda x, keep=keep: x[keep] if isinstance(x, np.ndarray) else x
        else:
            at = lambda x: x
        spent = {k: (at(a), at(b)) for k, (a, b) in moved.items()}
        spent[letter] = at(spent_up + more_up), at(spent_down + more_down)
        yield from visit(side, queries, at(rows), at(up - more_up), at(down - more_down), spent)


def enter(tree, queries: np.ndarray, step: int):
    """Leaves that points ``step`` letters longer than the queries, one edit away, can be in."""
    up, down = STEPS[step]
    n = len(queries)
    return visit(tree, queries, np.arange(n), np.full(n, up), np.full(n, down), {})


def plan_cells(sample: dict[int, np.ndarray], each: float, cell: int) -> dict[int, object]:
    """A tree per length; a leaf is [cell, shares]. A sampled vector stands for ``each`` words."""
    def grow(points: np.ndarray, made: list[int]):
        plane = split(points) if len(points) * each > cell else None
        if plane is None:
            made[0] += 1
            same = len(points) * each > cell and (points == points[0]).all()
            return [made[0] - 1, int(-(-len(points) * each // cell)) if same else 1]
        left = points[:, plane[0]] <= plane[1]
        return (*plane, grow(points[left], made), grow(points[~left], made))

    return {length: grow(points, [0]) for length, points in sample.items()}


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, places) of a list of words, ``VERIFY`` letters at a time."""
    sizes = np.array(list(map(len, words)), np.int64)
    for length in np.unique(sizes).tolist():
        places, step = np.flatnonzero(sizes == length), max(1, VERIFY // length)
        for a in range(0, len(places), step):
            yield length, places[a:a + step]


def _vectors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        for length, places in _by_length(words):
            counts = np.minimum(vectors(letters([words[i] for i in places.tolist()])), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([length] * len(places), pa.int32()), pa.array([r.tobytes() for r in counts], pa.binary())],
                                             ["length", "counts"])


def _route(trees: dict[int, object]):
    """Each word as a point of its cell and as a query to the cells of near lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1)
            for length, places in _by_length(words):
                some = [words[i] for i in places.tolist()]
                counts = vectors(letters(some))
                out = []

                def send(to: int, leaf: list[int], rows: np.ndarray, share: np.ndarray, query: bool, out=out):
                    out.append((np.full(len(rows), to), np.full(len(rows), leaf[0]), share, np.full(len(rows), query), rows))

                none = np.zeros(len(some), np.int64)
                for leaf, rows in visit(trees.get(length, [0, 1]), counts, np.arange(len(some)), none, none, {}):
                    share = np.array([share_of(some[i], leaf[1]) for i in rows.tolist()]) if leaf[1] > 1 else none[rows]
                    send(length, leaf, rows, share, False)
                for step in STEPS:
                    for leaf, rows in enter(trees.get(length + step, [0, 1]), counts, step):
                        for share in range(leaf[1]):
                            send(length + step, leaf, rows, np.full(len(rows), share), True)
                to, cell, share, query, rows = (np.concatenate(x) for x in zip(*out, strict=True))
                take = pa.array(places[rows])
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(cell, pa.int32()), pa.array(share, pa.int32()), pa.array(query),
                                                  batch.column(0).take(take), n.take(take)], ["length", "cell", "share", "query", "word", "n"])
    return run


def share_of(word: str, shares: int) -> int:
    """The same in every process, unlike ``hash``."""
    return zlib.crc32(word.encode()) % shares


def _local_tree(points: np.ndarray, places: np.ndarray):
    plane = split(points[places]) if len(places) > LEAF else None
    if plane is None:
        return places
    left = points[places, plane[0]] <= plane[1]
    return (*plane, _local_tree(points, places[left]), _local_tree(points, places[~left]))


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one replaced letter or, with one more in ``b``, an inserted one."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    size = a.shape[1]
    lead = np.logical_and.accumulate(a == b[:, :size], axis=1).sum(1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return lead + tail >= size


def near_pairs(points: list[str], queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all (query, point) one edit apart; each list holds words of one length."""
    step = len(points[0]) - len(queries[0])
    p, q = letters(points), letters(queries)
    counts = vectors(p)
    tree = _local_tree(counts, np.arange(len(points)))
    found, held, size = [], [], 0

    def verify():
        left, right = (np.concatenate(x) for x in zip(*held, strict=True))
        for a in range(0, len(left), max(1, VERIFY // len(points[0]))):
            i, j = left[a:a + max(1, VERIFY // len(points[0]))], right[a:a + max(1, VERIFY // len(points[0]))]
            good = one_edit(p[j], q[i]) if step < 0 else one_edit(q[i], p[j])
            found.append((i[good], j[good]))
        held.clear()

    for leaf, rows in enter(tree, vectors(q), step):
        held.append((np.repeat(rows, len(leaf)), np.tile(leaf, len(rows))))
        size += len(rows) * len(leaf)
        if size * len(points[0]) > VERIFY:
            verify()
            size = 0
    if held:
        verify()
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _search(group: pa.Table) -> pa.Table:
    """Near words in one cell of every query to it."""
    query = group.column("query").to_numpy()
    words, n = np.array(group.column("word").to_pylist(), object), group.column("n").to_numpy()
    points, asked = np.flatnonzero(~query), np.flatnonzero(query)
    out: dict[str, list] = {"word": [], "n_near": [], "form": [], "form_n": []}
    if len(points) and len(asked):
        points = points[np.lexsort((words[points].astype(str), -n[points]))]  # the best first
        sizes = np.array([len(w) for w in words[asked]])
        for length in np.unique(sizes).tolist():
            own = asked[sizes == length]
            i, j = near_pairs(words[points].tolist(), words[own].tolist())
            at, first, count = np.unique(i[order := np.lexsort((j, i))], return_index=True, return_counts=True)
            best = points[j[order][first]]
            out["word"] += words[own[at]].tolist()
            out["n_near"] += count.tolist()
            out["form"] += words[best].tolist()
            out["form_n"] += n[best].tolist()
    return pa.table([pa.array(out["word"], pa.string()), pa.array(out["n_near"], pa.int64()), pa.array(out["form"], pa.string()),
                     pa.array(out["form_n"], pa.int64())], names=list(out))


def near_words(words: DataFrame, scratch: Scratch, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``words`` (word, n; distinct words of letters) with n_near and the best near word and its n."""
    total = words.count()
    each = max(1, total // sample)
    chosen = words.where(F.pmod(F.xxhash64("word"), F.lit(each)) == 0).select("word")
    seen: dict[int, list[bytes]] = {}
    for length, counts in chosen.mapInArrow(_vectors_of, "length int, counts binary").toLocalIterator():
        seen.setdefault(length, []).append(bytes(counts))
    trees = plan_cells({k: np.frombuffer(b"".join(v), np.uint8).reshape(-1, LETTERS).astype(np.int16) for k, v in sorted(seen.items())},
                       each, max(cell, total // CELLS))
    found = words.mapInArrow(_route(trees), _ROUTED).groupBy("length", "cell", "share").applyInArrow(_search, _FOUND)
    every = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("string").alias("form"), F.lit(None).cast("bigint").alias("form_n"))
    found = found.select("word", F.lit(None).cast("bigint").alias("n"), "n_near", "form", "form_n")
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("minus"), "form")))
    return every.unionAll(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n", "n_near", F.col("best.form").alias("best"), (-F.col("best.minus")).alias("best_n"))


def spelling_groups(docs: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.save(word_counts(docs))
    near = near_words(words, scratch, cell, sample)
    strong = F.col("best_n") >= TIMES * F.col("n")
    linked = scratch.save(near.select("word", "n", "n_near", F.when(strong, F.col("best")).alias("form"), F.when(strong, F.col("best_n")).alias("form_n"),
                                      F.when(strong, F.col("best")).otherwise(F.col("word")).alias("root"), F.lit(True).alias("moved")))
    scratch.drop(words)
    while not linked.where("moved and form is not null").isEmpty():
        up = linked.where("form is not null").select(F.col("word").alias("root"), F.col("root").alias("above"))
        step = scratch.save(linked.join(up, "root", "left").select(
            "word", "n", "n_near", "form", "form_n", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        scratch.drop(linked)
        linked = step
    return linked.select("word", "form", "root", "n", "n_near", "form_n")
