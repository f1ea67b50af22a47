import hashlib
import random

from pyspark.sql import functions as F

from quayside.llm.mixing import fair_queue, schedule


def targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        weights = sum(weight[s] for s in order if s not in full)
        share = {s: 2 * sizes[s] if s in full else left * weight[s] / weights for s in order}
        over = {s for s in order if s not in full and share[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return share
        full |= over


def words(t):
    for c in "\t\n\x0b\x0c\r":
        t = (t or "").replace(c, " ")
    return len([w for w in t.split(" ") if w])


def test_matches_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), rng.choice(["a", "b", "é", "Z", None, "", "big", "big", "big"])) for i in range(200)]
    rows += [(300, None, "a"), (301, "", "void"), (302, "one word\x0btwo", "é"), (303, "w " * 5000, "long")]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, text string, source string, size int, extra string").repartition(4)
    got = fair_queue(docs).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = targets(sizes)
    assert len(got) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.size == words(r.text) and r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size and r.extra == "s"
        taken[r.source] += r.taken
    packets = []
    for s in sizes:  # one pass after the other, each in the shuffled order
        own, before = sorted((hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id, r.size) for r in got if r.source == s), 0
        for p in (1, 2):
            for h, i, n in own:
                before += n
                if n:
                    packets.append((before / want[s], h, p, s is None, s or "", i, n))
    left, expected = 3 * sum(sizes.values()) // 2, dict.fromkeys((r[0] for r in rows), 0)
    for *_, i, n in sorted(packets):
        expected[i] += min(n, left)
        left -= min(n, left)
    assert {r.doc_id: r.taken for r in got} == expected and left == 0
    longest = max(r.size for r in got if r.source != "long")
    assert all(abs(taken[s] - want[s]) <= longest * len(sizes) for s in sizes)


def test_schedule_is_in_virtual_time_and_fair(spark):
    rows = [(i, "w " * (1 + i % 5), f"s{i % 3}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = schedule(docs).collect()
    assert [r.finish for r in got] == sorted(r.finish for r in got) and got[-1].finish <= 1.01
    target = {r.source: r.target for r in got}
    done = dict.fromkeys(target, 0)
    for r in got:  # at any time all sources are as far as each other, to a document
        done[r.source] += r.words
        assert all(abs(done[s] / target[s] - r.finish) <= 6 / target[s] for s in done)
    again = fair_queue(docs.repartition(7)).agg(F.sum(F.xxhash64("doc_id", "taken").cast("decimal(38,0)"))).head()[0]
    assert again == fair_queue(docs).agg(F.sum(F.xxhash64("doc_id", "taken").cast("decimal(38,0)"))).head()[0]


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, None), (None, "", "x"), (1, None, None)], "doc_id bigint, text string, source string")
    assert [(r.size, r.target, r.taken) for r in fair_queue(docs).collect()] == [(0, 0.0, 0)] * 3
    assert fair_queue(docs.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, "c d e", "x")], "doc_id bigint, text string, source string")
    got = fair_queue(twice).collect()
    assert sum(r.taken for r in got) == 10 and all(r.taken <= 2 * r.size for r in got)
