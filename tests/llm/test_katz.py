import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm.katz import LOW, katz_scores

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(low), None]


def discounts(counts):
    n = Counter(counts)
    d = {}
    for r in range(1, LOW + 1):
        cut = (LOW + 1) * n[LOW + 1] / n[1] if n[1] else 0
        x = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[1] and n[r] and cut < 1 else 1.0
        d[r] = x if 0 < x < 1 else 1.0
    if n[1] and all(x == 1 for x in d.values()):
        d[1] = 0.5
    return d


class Katz:
    def __init__(self, texts):
        self.c1, self.c2, self.h = Counter(), Counter(), Counter()
        self.after = defaultdict(set)
        for t in texts:
            prev = "START"
            for w in tokens(t):
                self.c1[w] += 1
                self.c2[prev, w] += 1
                self.h[prev] += 1
                self.after[prev].add(w)
                prev = ("w", w)
        self.n = sum(self.c1.values())
        self.d1, self.d2 = discounts(self.c1.values()), discounts(self.c2.values())

    def p1(self, w):
        if not self.n:
            return 1.0
        left = sum(c * (1 - self.d1[c]) for c in self.c1.values() if c <= LOW)
        total = self.n
        if not left:
            left, total = 1, total + 1
        c = self.c1.get(w, 0)
        return (self.d1.get(c, 1) * c if c else left) / total

    def p2(self, h, w):
        if not self.h.get(h):
            return self.p1(w)
        seen = {v: self.c2[h, v] for v in self.after[h]}
        left = sum(c * (1 - self.d2[c]) for c in seen.values() if c <= LOW)
        if any(self.d2.get(c, 1) < 1 for c in seen.values()):
            total, d = self.h[h], self.d2
        else:
            left, total, d = 1, self.h[h] + 1, {}
        if w in seen:
            return d.get(seen[w], 1) * seen[w] / total
        return left / total / (1 - sum(self.p1(v) for v in seen)) * self.p1(w)

    def score(self, t):
        prev, out = "START", 0.0
        for w in tokens(t):
            out += math.log10(self.p2(prev, w))
            prev = ("w", w)
        return out


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


TEXTS = ["the cat sat on the mat", "The dog sat on the log", "a cat and a dog", "", None, "  ", "the the the the the the the",
         "zebraé unknownword the cat", "on the mat the cat sat", "x " * 300, "the cat sat on the mat"] * 3 + [
    f"w{i % 7} w{i % 3} the v{i}" for i in range(60)]


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double, block string")
    got = katz_scores(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0).collect()
    train = [t for i, t, *_ in rows if not held(i)]
    model = Katz(train)
    assert len(got) == len(rows)
    want = defaultdict(list)
    for i, t, *_ in rows:
        want[i].append(t)
    left = {i: sorted(round(model.score(t), 6) for t in ts) for i, ts in want.items()}
    have = defaultdict(list)
    for r in got:
        have[r.doc_id].append(round(r.score, 6))
        assert r.train_tokens == model.n and r.held_out == held(r.doc_id)
        texts = [t for t in want[r.doc_id] if len(tokens(t)) == r.n_tokens and sum(w in model.c1 for w in tokens(t)) == r.n_known]
        base = [sum(math.log10((model.c1.get(w, 0) + 0.1) / (model.n + 0.1 * (len(model.c1) + 1))) for w in tokens(t)) for t in texts]
        assert any(abs(b - r.base_score) < 1e-9 * max(1, abs(b)) for b in base)
    assert {i: sorted(x) for i, x in have.items()} == left
    return model


def test_scores_match_brute_force(spark):
    rows = [(i, t, None, "x") for i, t in enumerate(TEXTS)] + [(None, "the cat", 1.0, None), (3, "the other row", None, None), (3, "the other row", None, None)]
    model = check(spark, rows)
    for h in list(model.h)[:20]:  # exactly normalised over known words, end and the unknown class
        assert abs(sum(model.p2(h, w) for w in model.c1) + model.p2(h, "never seen") - 1) < 1e-12


def test_split_histories_and_many_buckets(spark):
    rows = [(i, t, None, None) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double, block string")
    model = Katz([t for i, t, *_ in rows if not held(i)])
    got = {r.doc_id: r.score for r in katz_scores(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0, bucket_tokens=40, split=5).collect()}
    for i, t, *_ in rows:
        assert got[i] == pytest.approx(model.score(t), rel=1e-9)


def test_no_training_documents_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    got = katz_scores(docs, F.lit(True)).collect()
    assert [r.score for r in got] == [0, 0] and [r.base_score for r in got] == [0, 0]
    assert katz_scores(docs.limit(0), F.lit(True)).collect() == []
