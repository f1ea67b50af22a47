"""Quality rules and a hashed n-gram likelihood ratio.

The trusted target and the raw corpus are two multinomials over hashed byte
n-grams. A document's score is the mean over its n-grams of
``log p_target - log p_raw``; documents at or above one threshold are kept.

* raw counts cover every document; target counts the trusted ones (quality 1,
  toxic 0) of all labelled ids but a quarter of them, picked by hash;
* that quarter teaches nothing and sets the threshold: the middle of the widest
  range of scores with the best balanced accuracy between trusted and low-quality
  documents, found on ``BINS`` fixed bins;
* the base rules are exact counts per document.

Defined results: a NULL or empty text has no words, all counts 0, score 0 and
fails the base rules; several labels of a doc_id count as its worst; labels
without a document, or NULL, are ignored; without both classes in that quarter
the threshold is -infinity; rows repeat freely; an empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Scratch
from quayside.llm.kernel import _SPACE, chunks, mix

GRAMS = (2, 3)
BUCKETS = 1 << 16
SMOOTHING = 1.0
#: Scores are binned between -LIMIT and LIMIT.
BINS, LIMIT = 2000, 2.0
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-gram buckets and the row of each, rows ascending within each length."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)).astype(np.int32)
    code, out = np.zeros(len(data), np.uint64), []
    for n in range(1, max(GRAMS) + 1):
        size = max(0, len(data) - n + 1)
        code = code[:size] * np.uint64(257) + data[n - 1:] + np.uint64(1)
        if n in GRAMS:
            same = row[:size] == row[n - 1:]
            out.append(((mix(code[same]) % np.uint64(BUCKETS)).astype(np.int32), row[:size][same]))
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, BUCKETS), np.int64)
    for rows, data, offsets in chunks(batches):
        x, row = grams(data, offsets)
        total[0] += np.bincount(x, minlength=BUCKETS)
        trusted = rows.column(rows.schema.get_field_index("trusted")).to_numpy(zero_copy_only=False)
        if trusted.any():
            total[1] += np.bincount(x[trusted[row]], minlength=BUCKETS)
    for k in range(2):
        at = np.flatnonzero(total[k])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(total[k][at])],
                                         ["kind", "bucket", "n"])


def repeated_words(tokens: list[bytes], size: int = WINDOW) -> int:
    """Words covered by windows of ``size`` words that occur twice or more."""
    windows = list(zip(*(tokens[i:] for i in range(size)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen, first, covered = set(), {}, np.zeros(len(tokens) + 1, np.int64)
    for i, w in enumerate(windows):
        if w in first:
            seen.add(w)
        else:
            first[w] = i
    for i, w in enumerate(windows):
        if w in seen:
            covered[i] += 1
            covered[min(i + size, len(tokens))] -= 1
    return int((np.cumsum(covered)[:-1] > 0).sum())


def _rules(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    def per_row(mask):
        return np.diff(np.r_[0, np.cumsum(mask)][offsets])

    n_words, dup, rep = [], [], []
    whole = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        text = whole[a:b]
        tokens = text.split()
        lines = [x for x in text.split(b"\n") if x.strip()]
        n_words.append(len(tokens))
        dup.append(len(lines) - len(set(lines)))
        rep.append(repeated_words(tokens))
    return {"n_words": np.array(n_words, np.int64), "word_chars": per_row(~_SPACE[data] & ((data & 0xC0) != 0x80)),
            "n_symbols": per_row(_SYMBOL[data]), "n_dup_lines": np.array(dup, np.int64), "n_repeat_words": np.array(rep, np.int64)}


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def labelled_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, trusted, poor, fit) of every labelled id; a quarter of the ids is for the threshold."""
    per = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return per.where("quality is not null").select(
        "doc_id", F.expr("quality = 1 and coalesce(toxic, 0) = 0").alias("trusted"),
        F.expr("quality = 0").alias("poor"), (F.pmod(F.xxhash64("doc_id"), F.lit(4)) != 0).alias("fit"))


def best_threshold(good: np.ndarray, poor: np.ndarray) -> float:
    """The middle of the widest run of cuts with the best balanced accuracy; counts per bin."""
    if not good.sum() or not poor.sum():
        return float("-inf")
    kept = np.r_[good[::-1].cumsum()[::-1], 0] / good.sum()
    gone = np.r_[0, poor.cumsum()] / poor.sum()
    value = np.round(kept + gone, 12)
    best = np.flatnonzero(value == value.max())
    run = max(np.split(best, np.flatnonzero(np.diff(best) > 1) + 1), key=len)
    return float((run[0] + run[-1]) / 2 / BINS * 2 * LIMIT - LIMIT)


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` doc_id with the base measures, base_failed, score, threshold and kept."""
    scratch = Scratch(docs.sparkSession, "quality")
    labelled = scratch.save(labelled_ids(labels))  # of no bounded size, so never broadcast: one plan at every size
    docs = docs.select("doc_id", "text")
    marked = docs.join(labelled.where("fit and trusted").select("doc_id", "trusted").hint("merge"), "doc_id", "left")
    counts = (marked.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
              .mapInArrow(_count, "kind int, bucket int, n bigint").groupBy("kind", "bucket").agg(F.sum("n").alias("n")))
    x = np.zeros((2, BUCKETS))
    for r in counts.collect():  # two counts for each of a fixed number of buckets
        x[r["kind"], r["bucket"]] = r["n"]
    p = np.log((x + SMOOTHING) / (x.sum(1, keepdims=True) + SMOOTHING * BUCKETS))
    ratio = (p[1] - p[0]) if x[1].any() else np.zeros(BUCKETS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches):
            x, row = grams(data, offsets)
            n = np.bincount(row, minlength=rows.num_rows)
            score = np.bincount(row, ratio[x], minlength=rows.num_rows) / np.maximum(1, n)
            rules = _rules(data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column(0), *[pa.array(rules[k].astype(np.int64)) for k in _MEASURES], pa.array(score)],
                                             ["doc_id", *_MEASURES, "score"])

    id_type = dict(docs.dtypes)["doc_id"]
    scored = scratch.save(docs.mapInArrow(measure, f"doc_id {id_type}, {', '.join(f'{k} bigint' for k in _MEASURES)}, score double"))
    failed = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    scored = scored.withColumn("base_failed", failed)

    held = scored.where("not base_failed").join(labelled.where("not fit and (trusted or poor)").hint("merge"), "doc_id")
    place = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.col("score") + LIMIT) / (2 * LIMIT) * BINS))).cast("int")
    bins = np.zeros((2, BINS))
    for r in held.groupBy("trusted", place.alias("bin")).count().collect():  # at most two counts a bin
        bins[int(r["trusted"]), r["bin"]] = r["count"]
    threshold = best_threshold(bins[1], bins[0])
    return scored.withColumn("threshold", F.lit(threshold)).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
