import math
import random
from fractions import Fraction

import numpy as np
import pytest

from quayside.llm.whitening import square_sums, whiten

SCHEMA = "vec_id bigint, embedding array<float>, id int, vector string"


def brute(rows):
    """n, deviations and covariance of the usable vectors, in fractions."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in rows]
    n, d = len(kept), len(kept[0][1])
    sums = [sum(x[k] for _, x in kept) for k in range(d)]
    means = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((x[i] - means[i]) * (x[j] - means[j]) for _, x in kept) / n) for j in range(d)] for i in range(d)])
    return n, {i: sum((n * x[k] - sums[k]) ** 2 for k in range(d)) for i, x in kept}, cov, {i: [float(x[k] - means[k]) for k in range(d)] for i, x in kept}


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) * np.linspace(0.05, 0.5, d) + rng.normal(size=d) + rng.normal(size=(n, 1)) * 0.2
    return [(i, [float(c) for c in v]) for i, v in enumerate(base.astype(np.float32))]


@pytest.mark.parametrize("n,d", [(60, 5), (200, 11)])
def test_matches_fractions(spark, n, d):
    rows = vectors(n, n, d)
    odd = [(900, None), (901, [None] * d), (902, [float("nan")] + [0.0] * (d - 1)), (903, [0.0] * (d - 1) + [float("-inf")]), (904, [1.0]), (905, [])]
    everything = [(i, v, 7, "x") for i, v in rows + odd]
    random.Random(0).shuffle(everything)
    got = whiten(spark.createDataFrame(everything, SCHEMA).repartition(5)).collect()
    n, deviation, cov, centred = brute(rows)
    values, vecs = np.linalg.eigh(cov)
    k = min(8, d)
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    assert len(got) == n * k and {r.n for r in got} == {n}
    assert all(r.deviation == deviation[r.vec_id] for r in got)
    sign = {}
    for r in sorted(got, key=lambda r: (r.vec_id, r.component)):
        want = float(np.dot(centred[r.vec_id], vecs[:, r.component - 1]) / math.sqrt(values[r.component - 1]))
        s = sign.setdefault(r.component, 1 if want * r.whitened > 0 else -1)
        assert s * r.whitened == pytest.approx(want, abs=1e-9)
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
        assert r.identity_error < 1e-9


def test_square_sums_are_exact_at_every_size():
    rng = random.Random(1)
    for top in (3, 1 << 20, 1 << 31, 1 << 50):
        y = np.array([[rng.randrange(-top, top) for _ in range(4)] for _ in range(50)], np.int64)
        got = square_sums(y)
        for i in range(4):
            for j in range(i, 4):
                assert got[i, j] == sum((int(r[i]) + (int(r[j]) if i != j else 0)) ** 2 for r in y)


def test_ties_repeats_and_flat_dimensions(spark):
    rows = [(1, [0.5, 2.0, 1.0]), (1, [0.5, 2.0, 1.0]), (None, [0.25, 1.0, 1.0]), (4, [0.75, 3.0, 1.0])]
    got = whiten(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)).collect()
    assert len(got) == 12 and {r.n for r in got} == {4}
    assert sum(r.vec_id is None for r in got) == 3
    assert all((r.whitened is None) == (r.component > 1) for r in got)
    assert all(r.explained == pytest.approx(float(r.component == 1)) for r in got)
    assert max(r.identity_error for r in got) < 1e-9
    flat = whiten(spark.createDataFrame([(1, [0.5], 0, ""), (2, [0.5], 0, "")], SCHEMA)).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in flat] == [(0, None, None, None)] * 2


def test_huge_entries_and_empty(spark):
    rows = [(1, [1e300, 0.0], 0, ""), (2, [-1e300, 1.0], 0, ""), (3, [0.0, 2.0], 0, "")]
    got = whiten(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()
    assert len(got) == 6 and {r.vec_id for r in got if r.deviation is None} == {1, 2}
    assert all(r.identity_error < 1e-6 for r in got)
    for empty in ([], [(1, None, 0, ""), (2, [], 0, "")]):
        out = whiten(spark.createDataFrame(empty, SCHEMA))
        assert out.collect() == []
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
