import random
import re

import numpy as np

from quayside.llm.quality import assess, best_threshold, repeated_words

WORD = re.compile("[^\x20\x09-\x0d]+")


def rules(t):
    t = t or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("theanrsoié") for _ in range(rng.randrange(2, 8)))
    docs, labels = [], []
    for i in range(n):
        poor = i % 4 == 0
        t = " ".join(word() + (rng.choice(["###", "$$$", "!!"]) if poor else "") for _ in range(rng.randrange(10, 80)))
        if i % 3 == 0:
            t = t.replace(" ", "\n", 3)
        docs.append((i, t))
        if i % 2 == 0 or i % 8 == 1:
            labels.append((i, int(not poor), 0))
    docs += [(1000, None), (1001, ""), (1002, "a b c d e " * 6), (1003, "a\x0bb\nx\nx\n \nx"), (None, "one two three four five six seven eight nine ten"), (3, "again the same id with ten words or more in it")]
    return docs, labels


def test_rules_verdicts_and_clean_documents(spark):
    docs, labels = corpus()
    labels += [(0, 1, 0), (None, 1, 0), (5000, 0, None), (7, None, None)]
    d = spark.createDataFrame([(*x, 0.1, 5) for x in docs], "doc_id bigint, text string, score double, n_words int").repartition(3)
    got = assess(d, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(got) == len(docs)
    have = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=str)
    assert have == sorted(((i, *rules(t)) for i, t in docs), key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= r.threshold)
        if r.doc_id is not None and r.doc_id < 1000 and not r.base_failed and r.doc_id != 3:
            assert r.kept == (r.doc_id % 4 != 0)


def test_repeated_words_and_threshold():
    rng = random.Random(2)
    for _ in range(300):
        w = [rng.choice([b"a", b"b"]) for _ in range(rng.randrange(30))]
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        assert repeated_words(w) == len({i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)})
    good, poor = np.zeros(2000), np.zeros(2000)
    good[1500:1600], poor[400:500] = 1, 1
    assert abs(best_threshold(good, poor) - 0.0) < 0.01
    assert best_threshold(good, np.zeros(2000)) == float("-inf")


def test_no_labels_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "w " * 6 + "x y z u v"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: (r.kept, r.base_failed) for r in assess(d, labels).collect()}
    assert got[2] == (False, True) and got[1][0] == (not got[1][1])
    assert assess(d.limit(0), labels).collect() == []


def test_every_label_counts(spark):
    docs, labels = corpus(n=60)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    scores = lambda more: sorted(((r.doc_id, r.n_words, r.score, r.threshold) for r in assess(
        d, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").union(more)).collect()), key=str)
    others = spark.range(10_000, 130_000).selectExpr("id", "1", "0")  # labels of no document change nothing, however many
    assert scores(others) == scores(others.limit(0))
