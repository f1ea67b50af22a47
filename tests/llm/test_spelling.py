import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quayside.llm import spelling
from quayside.llm.spelling import enter, near_pairs, one_edit, plan_cells, spelling_groups, vectors


def brute_counts(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            out[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = brute_counts(rows)
    around = {w: [x for x in n if near(w, x)] for w in n}
    form = {w: min(around[w], key=lambda x: (-n[x], x)) if around[w] else None for w in n}
    form = {w: f if f and n[f] >= 2 * n[w] else None for w, f in form.items()}
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(around[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeé×ÿ") for _ in range(rng.randrange(4, 9))) for _ in range(25)] + ["STATION", "abcde", "edcba", "eeeee", "z" * 400]

    def word():
        w = list(rng.choice(stems))
        while rng.random() < 0.3:
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.choice([0, 1])] = rng.choice([[], ["a"], ["É"], ["x"]])
        return "".join(w)
    rows = [(i, rng.choice([" ", "1", ", ", "\n"]).join(word() for _ in range(rng.randrange(40)))) for i in range(n)]
    return [*rows, (None, "station station stations stations stations"), (3, None), (4, ""), (5, rows[5][1]), (5, rows[5][1]), (6, "longest" * 30_000)]


@pytest.mark.parametrize("cell,sample", [(8192, 100_000), (7, 100_000), (3, 20)])
def test_matches_brute_force(spark, cell, sample):
    rows = corpus(cell)
    docs = spark.createDataFrame([(*r, "w", 7) for r in rows], "doc_id bigint, text string, word string, n int").repartition(3)
    got = spelling_groups(docs, cell, sample)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == brute(rows)


def test_chain_of_forms_and_ties(spark):
    text = " ".join(["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aabbb"] * 24 + ["abbbb"] * 48 + ["bbbbb"] * 96 + ["bbbbc"] * 96)
    docs = spark.createDataFrame([(2, text)], "doc_id bigint, text string")
    rows = [(2, text)]
    got = {r.word: (r.form, r.root) for r in spelling_groups(docs).collect()}
    assert got == {r[0]: (r[1], r[2]) for r in brute(rows)}
    assert got["abbbb"] == ("bbbbb", "bbbbb") and got["aaaaa"][1] == "bbbbb"


def test_empty(spark):
    for rows in ([], [(1, None), (2, ""), (3, "word word word 12345")]):
        assert spelling_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() == []


def test_one_vector_is_dealt_to_several_cells():
    points = np.repeat(np.array([[2, 1, 0]], np.int16), 50, 0)
    assert plan_cells({5: points}, 2, 30) == {5: [0, 4]}


def test_boxes_lose_no_near_word():
    rng = random.Random(5)
    words = {k: sorted({"".join(rng.choice("abcd") for _ in range(k)) for _ in range(400)}) for k in (5, 6, 7)}
    for a in words:
        for b in words:
            if abs(a - b) > 1:
                continue
            i, j = near_pairs(words[b], words[a])
            assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(x, y) for x, q in enumerate(words[a]) for y, p in enumerate(words[b]) if near(q, p)]


def test_box_search_prunes():
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(4000)})
    counts = vectors(spelling.letters(words))
    tree = spelling._local_tree(counts, np.arange(len(words)))
    met = sum(len(leaf) * len(rows) for leaf, rows in enter(tree, counts, 0))
    assert met < 0.2 * len(words) ** 2


def test_one_edit():
    pairs = [("abcde", "abcdf", True), ("abcde", "abdce", False), ("abcde", "abcde", False), ("abcde", "abccde", True), ("abcde", "xabcde", True),
             ("abcde", "abcdex", True), ("abcde", "axbcdx", False)]
    for a, b, want in pairs:
        assert one_edit(spelling.letters([a]), spelling.letters([b])).tolist() == [want]
