"""Language identification as inference of a mixture of languages.

Training counts the hashed byte n-grams of every labelled document per language
and turns them into smoothed log-probabilities, one column of ``BUCKETS`` values
per language: a model whose size does not depend on the corpus.

A document is a mixture of languages that generate its words: a word's
likelihood under a language is the product over its n-grams. Expectation
maximisation estimates the proportions, first over all languages; then languages
are taken out, smallest proportion first, while the penalised likelihood
(log-likelihood less ``0.5 log(words)`` per free proportion) does not fall. The
language with the largest proportion in the selected set is the prediction, its
proportion the score.

Only the text decides. Defined results: NULL, empty or letterless text, and any
text when no language was learned, is ``und`` with score 0; labels that are NULL
teach nothing; ties go to the language first in order; rows repeat freely; an
empty table gives an empty table. Texts are handled whole, in chunks of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.kernel import LOWER, chunks, mix, words

UNDETERMINED = "und"
BUCKETS = 1 << 15
#: Byte n-gram lengths; a word is read with one space at either end.
GRAMS = (2, 3)
SMOOTHING = 0.5
#: Rounds of expectation maximisation over all languages, and after each removal.
ROUNDS = 8
REFIT = 3

_LETTER = re.compile(r"[^\W\d_]")


def word_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram buckets of all words in order, the start of each word among them, words before each row."""
    starts, ends, at = words(data, offsets)
    size = ends - starts + 2
    first = np.cumsum(size) - size
    flat = np.full(int(size.sum()), 32, np.uint64)
    pos = np.arange(len(flat)) - np.repeat(first, size)
    inner = (pos > 0) & (pos < np.repeat(size, size) - 1)
    flat[inner] = LOWER[data[np.repeat(starts, size)[inner] + pos[inner] - 1]]
    left = np.repeat(size, size) - pos
    code = np.zeros(len(flat), np.uint64)
    out = np.zeros((len(flat), len(GRAMS)), np.int32)
    good = np.zeros((len(flat), len(GRAMS)), bool)
    for n in range(1, max(GRAMS) + 1):
        shifted = np.r_[flat[n - 1:], np.zeros(min(n - 1, len(flat)), np.uint64)]
        code = code * np.uint64(257) + shifted + np.uint64(1)
        if n in GRAMS:
            k = GRAMS.index(n)
            out[:, k] = (mix(code) % np.uint64(BUCKETS)).astype(np.int32)
            good[:, k] = left >= n
    counts = good.sum(1)
    total = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
    return out[good], np.cumsum(total) - total, at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for rows, data, offsets in chunks(batches):
        lang = np.array(rows.column(0).to_pylist(), object)
        grams, first, at = word_grams(data, offsets)
        ends = np.r_[first, len(grams)][at]
        names, code = np.unique(lang, return_inverse=True)
        pair = np.repeat(code, np.diff(ends)) * BUCKETS + grams
        for k, x in zip(names, np.bincount(pair, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS), strict=True):
            total[k] = total.get(k, 0) + x
    for k, x in total.items():
        at = np.flatnonzero(x)
        yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(x[at])],
                                         ["lang", "bucket", "n"])


class Model:
    """Languages in order and their log-probability of each bucket."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        total = counts.sum(1, keepdims=True)
        self.logs = np.log((counts + SMOOTHING) / (total + SMOOTHING * BUCKETS)).astype(np.float32)


def train(labelled: DataFrame) -> Model:
    """From all rows of ``labelled`` (text, lang). What comes to the driver is one count for each
    language and bucket, summed over the corpus before."""
    rows = labelled.where("lang is not null").select("lang", "text")
    counts = rows.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per = (counts.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).orderBy("lang")).collect()
    x = np.zeros((len(per), BUCKETS))
    for k, r in enumerate(per):
        x[k, r["b"]] = r["n"]
    return Model([r["lang"] for r in per], x)


def mixture(like: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Proportions (rows x languages) from word log-likelihoods by EM and penalised selection.

    ``like`` is words x languages, ``row`` each word's row, ascending.
    """
    langs = like.shape[1]
    like = np.exp(like - like.max(1, keepdims=True))
    first = np.searchsorted(row, np.arange(n))
    count = np.diff(np.r_[first, len(row)])
    some, tiny = np.flatnonzero(count), np.float32(1e-30)

    def total(x):
        out = np.zeros((n,) + x.shape[1:], x.dtype)
        if len(some):
            out[some] = np.add.reduceat(x, first[some], axis=0)
        return out

    def fit(pi, rounds):
        for _ in range(rounds):
            part = like * pi[row]
            part /= np.maximum(part.sum(1, keepdims=True), tiny)
            pi = (total(part) / np.maximum(1, count)[:, None]).astype(np.float32)
        return pi, total(np.log(np.maximum((like * pi[row]).sum(1, dtype=np.float64), tiny)))

    def penalised(pi, fitted):
        return fitted - 0.5 * np.log(np.maximum(2, count)) * ((pi > 0).sum(1) - 1)

    pi, fitted = fit(np.full((n, langs), 1 / langs, np.float32), ROUNDS)
    best, value = pi, penalised(pi, fitted)
    live = np.ones(n, bool)
    for _ in range(langs - 1):
        less = best.copy()
        least = np.where(less > 0, less, 2).argmin(1)
        many = (less > 0).sum(1) > 1
        live &= many
        if not live.any():
            break
        less[np.arange(n), least] = np.where(live, 0, less[np.arange(n), least])
        less /= np.maximum(less.sum(1, keepdims=True), tiny)
        pi, fitted = fit(less, REFIT)
        now = penalised(pi, fitted)
        live &= now >= value
        best[live], value[live] = pi[live], now[live]
    return best


def identify(docs: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred and score, their names led by ``prefix``."""
    logs, langs = model.logs, model.langs
    made = [f"{prefix}lang_pred", f"{prefix}score"]
    own = [c for c in docs.columns if c not in made]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches):
            pred, score = [UNDETERMINED] * rows.num_rows, np.zeros(rows.num_rows)
            if langs:
                grams, first, at = word_grams(data, offsets)
                like = np.empty((len(first), len(langs)), np.float32)
                for k in range(len(langs)):
                    if len(first):
                        like[:, k] = np.add.reduceat(logs[k][grams], first)
                row = np.repeat(np.arange(rows.num_rows), np.diff(at))
                pi = mixture(like, row, rows.num_rows)
                text = rows.column(rows.schema.get_field_index("text"))
                for i, t in enumerate(text.to_pylist()):
                    if t and _LETTER.search(t):
                        k = int(pi[i].argmax())
                        pred[i], score[i] = langs[k], min(1.0, float(pi[i, k]))
            columns = [c for c, name in zip(rows.columns, rows.schema.names, strict=True) if name in own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(pred, pa.string()), pa.array(score)], [*own, *made])

    types = ", ".join(f"`{c}` {t}" for c, t in docs.select(*own).dtypes)
    return docs.select(*own).mapInArrow(predict, f"{types}, `{made[0]}` string, `{made[1]}` double")


def fold(docs: DataFrame, of: int) -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % of


def held_out_identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents outside fold 2 of 4, predict all."""
    model = train(docs.where(fold(docs, 4) != 2))
    return identify(docs, model).withColumn("held_out", fold(docs, 4) == 2)
