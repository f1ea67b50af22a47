import hashlib
import random
from collections import Counter

import pytest

from quayside.llm import suffix_dedup
from quayside.llm.suffix_dedup import repeated_spans


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, alphabet="abcdefghij é"):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [text(n) for n in (390, 399, 400, 401, 450, 900, 2500)]
    out = [text(rng.randrange(0, 1500)) for _ in range(20)]
    for _ in range(40):
        parts = [text(rng.randrange(0, 300))]
        for _ in range(rng.randrange(1, 4)):
            s = rng.choice(shared)
            a = rng.randrange(0, len(s) // 2)
            parts += [s if rng.random() < 0.4 else s[a:a + rng.randrange(300, 900)], text(rng.randrange(0, 200))]
        out.append("".join(parts))
    base = text(3000)
    for _ in range(10):
        i = rng.randrange(3000)
        out.append(base[:i] + text(3) + base[i + 2:])
    return out + [base, base, None, "", "a" * 399, "a" * 400, "a" * 1000, "ab" * 500, "xyz" * 131, base[:400], "b" * 401]


@pytest.mark.parametrize("seed,alphabet,length,bucket", [(1, "abcdefghij é", 400, 1 << 25), (2, "ab", 400, 3000), (3, "abcdefghij é", 50, 3000)])
def test_matches_brute_force(spark, monkeypatch, seed, alphabet, length, bucket):
    monkeypatch.setattr(suffix_dedup, "PIECE", 2000)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 20000)
    texts = corpus(seed, alphabet)
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, block int, kind string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in repeated_spans(docs, length, bucket).collect()}
    want = brute(texts, length)
    assert len(got) == len(texts)
    bad = [i for i in range(len(texts)) if got[i] != want[i]]
    assert not bad, [(i, got[i], want[i]) for i in bad[:5]]


def test_null_ids_repeated_rows_and_empty_table(spark):
    t = "".join(chr(97 + i * i % 23) + str(i) for i in range(300))
    docs = spark.createDataFrame([(None, t), (1, t), (1, t), (2, None), (2, "short")], "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in repeated_spans(docs).collect())
    n = len(t)
    assert got == [(0, n, n), (1, n, n), (1, n, n), (2, 0, 0), (2, 5, 0)]
    assert repeated_spans(docs.limit(0)).collect() == []
