import random
import re

import numpy as np
import pytest

from quayside.llm import near_dup
from quayside.llm.components import components
from quayside.llm.common import Scratch
from quayside.llm.near_dup import near_duplicates, one_of_each


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", low)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    return {d: (len(sets[i]), min(ids[find(i)])) for i, (d, _) in enumerate(rows)}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6)))
    text = lambda n: [word() for _ in range(n)]
    passage, out = text(30), []
    for n in (3, 12, 40, 80, 200):
        base = text(n)
        for _ in range(25):
            t = list(base)
            for _ in range(rng.randrange(0, max(1, n // 12))):
                t[rng.randrange(len(t))] = word()
            out.append(" ".join(t) if rng.random() < 0.8 else "\n".join(t).upper())
    chain = text(120)
    for i in range(30):  # each near the next only
        chain[i * 4] = word()
        out.append(" ".join(chain))
    out += [" ".join(text(rng.randrange(1, 15)) + passage + text(rng.randrange(1, 15))) for _ in range(40)]
    out += [" ".join(text(rng.randrange(1, 60))) for _ in range(30)]
    out += ["", " \n", None, "one", "ONE", "one two three four", "a b c d e", "a b c d e", " ".join(["x"] * 500), " ".join(["x"] * 50)]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed,blocks", [(1, None), (2, 7)])
def test_matches_brute_force(spark, monkeypatch, seed, blocks):
    if blocks:
        monkeypatch.setattr(near_dup, "LIST_BLOCK", blocks)
        monkeypatch.setattr(near_dup, "CLUSTER_BLOCK", blocks)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, node string, n int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    want = brute(rows)
    assert got == want
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in want.items() if c == d)


def test_null_ids_repeated_rows_and_empty_table(spark):
    t = "one two three four five six seven eight"
    docs = spark.createDataFrame([(None, t), (3, t), (3, t), (7, None), (7, "other"), (None, "alone here")], "doc_id bigint, text string")
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == [(0, 1, None, True), (0, 4, 3, False), (3, 4, 3, True), (3, 4, 3, True), (7, 0, 7, True), (7, 1, 7, True)]
    assert near_duplicates(docs.limit(0)).collect() == []
    kept = one_of_each(docs).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "alone here"), (3, t), (7, ""), (7, "other")]


@pytest.mark.parametrize("shared", [None, 5])
def test_texts_that_share_an_id_are_told_apart(spark, shared):
    t = " ".join(f"w{i}" for i in range(40))
    near, other = t + " end", " ".join(f"u{i}" for i in range(30))
    rows = [(3, t), (shared, near), (shared, other), (shared, other + " more"), (9, other + " and more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    low = shared or 9
    assert got == sorted([(3, 36, 3, True), (shared or 0, 37, 3, False), (shared or 0, 26, low, low == shared),
                          (shared or 0, 27, low, low == shared), (9, 28, low, low == 9)])
    kept = sorted(r.text for r in one_of_each(docs).collect())
    assert kept == sorted([t, other, other + " more"] if shared else [t, other + " and more"])
    docs = spark.createDataFrame([(3, t), (shared, near), (shared, other)], "doc_id bigint, text string")
    assert sorted(r.text for r in one_of_each(docs).collect()) == sorted([t, other])


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 450), (9, 9)] + [(1000, 1001 + i) for i in range(50)]
    random.Random(1).shuffle(edges)
    links = spark.createDataFrame(edges, "node bigint, other bigint")
    got = {r.node: r.component for r in components(links, Scratch(spark, "test")).collect()}
    want = {i: 0 for i in range(201)} | {400: 400, 450: 400, 500: 400} | {i: 1000 for i in range(1000, 1051)}
    assert got == want


@pytest.mark.parametrize("few", [0, 64])
def test_few_edges_are_joined_without_a_shuffle(spark, monkeypatch, few):
    monkeypatch.setattr("quayside.llm.components.FEW", few)
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = components(spark.createDataFrame(links, "node bigint, other bigint").repartition(3), Scratch(spark, "test"))
    assert {r.node: r.component for r in found.collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert ("hashpartitioning" in found._jdf.queryExecution().executedPlan().toString()) == (few == 0)


def test_members_that_share_one_key_only_are_not_estimated(monkeypatch):
    estimated = []
    real = near_dup.estimates
    monkeypatch.setattr(near_dup, "estimates", lambda one, others: estimated.append(len(others)) or real(one, others))
    rng = np.random.default_rng(3)
    sketches = np.sort(rng.integers(1000, 2**31, (300, near_dup.SKETCH), dtype=np.uint32), axis=1)
    sketches[:, 0] = 7  # the key of the list
    sketches[299, :60] = sketches[298, :60]
    sketches[299].sort()
    assert near_dup._join_list(np.arange(300), np.full(300, 400), sketches) == [(298, 299)]
    assert sum(estimated) < 10


def test_small_sets_are_estimated():
    sets = np.full((2, near_dup.SKETCH), near_dup._PAD)
    sets[0, :4], sets[1, :3] = [1, 2, 3, 4], [1, 2, 3]
    assert near_dup._join_list(np.array([5, 9]), np.array([4, 3]), sets) == [(5, 9)]
