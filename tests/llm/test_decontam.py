import random

import numpy as np
import pytest

from quayside.llm import decontam
from quayside.llm.decontam import ERRORS, MIN_ITEM, Index, align, canonical, contained_items, decontaminate


def canon(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return " ".join(w for w in low.split(" ") if w).encode()


def distance(p, t):
    """Least edits of p against any substring of t (Sellers)."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def stands(p, t):
    """p is in t between word borders."""
    word = lambda c: c >= 128 or chr(c).isalnum()
    border = lambda k: not (0 < k < len(t) and word(t[k - 1]) and word(t[k]))
    return any(t[a:a + len(p)] == p and border(a) and border(a + len(p)) for a in range(len(t) - len(p) + 1))


def brute(docs, items):
    out = set()
    for d, t in docs:
        for i, x in items:
            p = canon(x)
            if p and (canon(t) == p if len(p) < 8 else len(p) < MIN_ITEM and stands(p, canon(t))):
                out.add((d, i))
            if len(p) >= MIN_ITEM and distance(p, canon(t)) <= int(len(p) * ERRORS):
                out.add((d, i))
    return out


def edit(rng, t, n):
    for _ in range(n):
        i = rng.randrange(len(t) + 1)
        t = rng.choice([t[:i] + t[i + 1:], t[:i] + rng.choice("abcé ") + t[i:], t[:i] + "x" + t[i + 1:]])
    return t


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeinorst") for _ in range(rng.randrange(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((5, 9, 12, 20, 30))]
    items += [(50, "a" * 60), (51, "ab " * 30), (52, None), (53, ""), (54, items[4][1].upper()), (None, text(15))]
    items += [(60, "Is it 8?"), (61, "a question of thirty-nine bytes: or not"), (62, "yes"), (63, "é bytes +")]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(6)]
    for n, (_, t) in enumerate(items):
        if t:
            for k, e in enumerate((0, 1, int(len(t) * ERRORS), int(len(t) * ERRORS) + 1, int(len(t) * 0.15) + 2)):
                docs.append((100 + n * 10 + k, text(rng.randrange(0, 20)) + "\n" + edit(rng, t, e).replace(" ", rng.choice([" ", "\n", "  "])) + " " + text(9)))
    return docs + [(900, None), (901, ""), (902, "a" * 1500), (903, "ab " * 300), (904, "x" * 39), (905, items[4][1]), (905, items[3][1])] + [
        (910, "so\nis  it 8? yes"), (911, "this it 8?"), (912, " YES\n"), (913, "yes yes"), (914, "x é bytes +y"), (915, "xé bytes +"),
        (916, items[-3][1]), (917, "A " + items[-3][1].replace(" ", "\n") + "s"), (918, items[-3][1][:-1]), (919, "yes")], items


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 600)])
def test_matches_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(decontam, "EXPAND", 500)
    docs, items = corpus(seed)
    d = spark.createDataFrame([(*x, 7, "z") for x in docs], "doc_id bigint, text string, item_id int, start string").repartition(2)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    rows = contained_items(d, b, block).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert {i for _, i in want} >= {0, 60, 61, 62}
    texts = dict(items)
    for r in rows:
        spans = [canon(t[r.start:r.end]) for i, t in docs if i == r.doc_id and t]
        p = canon(texts[r.item_id])
        # canon() trims a space at either end of the span
        if len(p) < MIN_ITEM:
            assert r.edits == 0 and p in spans
            continue
        assert r.edits <= int(len(p) * ERRORS) and any(distance(p, s) <= r.edits + 2 for s in spans)
    kept = decontaminate(d, b, block)
    assert kept.columns == d.columns
    bad = {i for i, _ in want}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id != 905) == sorted(i for i, _ in docs if i not in bad and i != 905)


def test_bound_is_positive_and_align_is_exact():
    assert all(m + 1 - 8 - 8 * int(m * ERRORS) > 0 for m in range(MIN_ITEM, 5000))
    rng = random.Random(5)
    for _ in range(200):
        p = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 30)))
        t = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 40)))
        best = distance(p, t)
        got, end = align(p, t)
        if best <= int(len(p) * ERRORS):
            assert got == best and distance(p, t[:end]) == best
    raw = np.frombuffer(b"  A  b\n c  \t D ", np.uint8)
    body, at, _ = canonical(raw, np.array([0, 10, 10, 15]))
    assert body.tobytes() == b"a b cd" and at.tolist() == [0, 5, 5, 6]


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "some text " * 20), (None, None)], "doc_id bigint, text string")
    b = spark.createDataFrame([(1, "some text " * 10)], "item_id bigint, text string")
    assert contained_items(d, b.limit(0)).collect() == [] and contained_items(d.limit(0), b).collect() == []
    assert decontaminate(d, b.limit(0)).count() == 2 and decontaminate(d, b).count() == 1
    assert Index([]).regions(np.zeros(5, np.uint8), np.array([0, 5])) == []


def test_long_text(spark):
    item, short = "what is the boiling point of water at sea level in kelvin?", "name the sixth moon"
    filler = "some words of a long text " * 60_000
    docs = [(1, filler + item.upper() + " " + filler), (2, filler), (3, filler + short), (4, filler + "re" + short)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame([(1, item), (2, short)], "item_id bigint, text string")
    rows = contained_items(d, b).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 1, len(filler), len(filler) + len(item), 0), (3, 2, len(filler), len(filler) + len(short), 0)]
    assert sorted(r.doc_id for r in decontaminate(d, b).collect()) == [2, 4]
