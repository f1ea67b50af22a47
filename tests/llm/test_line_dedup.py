import hashlib
import random

import pytest

from quayside.llm import line_dedup
from quayside.llm.line_dedup import dedup_lines, dedup_lines_stage

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows):
    """(n_lines, n_dropped, kept text) of each row; a missing id comes after all others."""
    place = lambda d: 2**63 - 1 if d is None else d
    first = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                first[key(x)] = min(place(d), first.get(key(x), place(d)))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == place(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcXYZé ") for _ in range(rng.randrange(1, 30))) for _ in range(60)] + ["", "short", " 123456789 ", "1234567890", "\tÉÉÉÉÉÉÉÉÉÉ\r"]
    change = [lambda x: x, str.upper, lambda x: f"  {x}\t", lambda x: x + "\r"]
    rows = [(i * 3, "\n".join(rng.choice(change)(rng.choice(pool)) for _ in range(rng.randrange(1, 12)))) for i in range(60)]
    rows += [(5, None), (8, ""), (None, pool[0] + "\n" + pool[1]), (None, "only here, with no id"), (9, rows[3][1]), (9, rows[3][1]), (10, "same line twice\nsame line twice"),
             (-4, "\n".join(pool)), (400, "x" * 100_000 + "\n" + pool[2])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("batches,fanout", [(4, 2), (1, 2), (7, 3)])
def test_matches_brute_force(spark, batches, fanout):
    rows = corpus(batches)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, idx int, owner string").repartition(3)
    got = dedup_lines(docs, batches, fanout)
    assert got.columns == ["doc_id", "idx", "owner", "text", "n_lines", "n_dropped"]
    have = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()), key=str)
    assert have == sorted(brute(rows), key=str)


def test_runs_stay_disjoint_and_levels_compact(spark):
    runs = line_dedup.SortedRuns(spark, line_dedup.Scratch(spark, "test"), 2)
    for i in range(5):
        runs.add(spark.createDataFrame([(k, k, i) for k in range(i * 10, i * 10 + 10)], "k1 bigint, k2 bigint, owner bigint"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.all().count() == 50 == runs.all().select("k1").distinct().count()


def test_stage_keeps_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a line of text\nother", 99, 7), (2, "A line of text", 99, 7)], "doc_id bigint, text string, n_chars bigint, n_lines int")
    out = dedup_lines_stage(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(1, "a line of text\nother", 20, 7), (2, "", 0, 7)]
    assert dedup_lines(docs.limit(0)).collect() == []
    assert hashlib.sha256(b"").hexdigest()
