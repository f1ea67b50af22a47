"""E3 by block digests: the same counts as the full join, and no join where nothing differs."""

import random

import pytest

from quayside.functions.scalars import comparable_number
from quayside.operators import audit as A


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed,share", [(1, 0.0), (2, 0.02), (3, 0.9)])
def test_equals_the_full_join(spark, seed, share):
    rng = random.Random(seed)
    left = [(k // 4, k % 4, rng.choice(["1.0", "x", "", None, " 7"]), rng.choice(["a", None, "0x1F"])) for k in range(400)]
    left += [(None, 1, "no", "key"), (3, None, "no", "key")]
    change = lambda v: rng.choice(["1", "7", "31", None, "y", v])
    right = [(a, b, change(x), change(y)) if rng.random() < share else (a, b, x, y) for a, b, x, y in left if rng.random() >= share / 4]
    right += [(900 + i, 0, "extra", None) for i in range(int(20 * share))]
    schema = "k1 int, k2 int, x string, y string"
    a, b = (spark.createDataFrame(x, schema).repartition(3) for x in (left, right))
    want = rows_of(A.joined_diff(a, b, ["k1", "k2"]))
    for blocks in (1, 16, 4096):
        assert rows_of(A.table_diff(a, b, ["k1", "k2"], blocks=blocks)) == want
    if not share:
        assert [tuple(r) for r in A.differing_blocks(a, b, ["k1", "k2"], ["x", "y"]).collect()] == [(-1,)]


def test_equal_tables_join_nothing(spark):
    df = spark.createDataFrame([(i, str(i), "v") for i in range(1000)], "id bigint, v string, block string")
    diff = A.table_diff(df.repartition(5), df.repartition(2), ["id"])
    assert "Join" not in diff._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(diff) == [(0, 0, 0, "block", 0, 0), (0, 0, 0, "v", 0, 0)]
    empty = df.limit(0)
    assert rows_of(A.table_diff(empty, empty, ["id"])) == [(0, 0, 0, "block", 0, 0), (0, 0, 0, "v", 0, 0)]
    assert rows_of(A.table_diff(df, empty, ["id"]))[0][:3] == (0, 1000, 1000)


def test_digest_sees_cells_that_move(spark):
    a = spark.createDataFrame([(1, "ab", "c")], "id int, x string, y string")
    for other in ([(1, "a", "bc")], [(1, "c", "ab")], [(2, "ab", "c")]):
        assert A.differing_blocks(a, spark.createDataFrame(other, a.schema), ["id"], ["x", "y"]).count() >= 1
    null, empty = (spark.createDataFrame([(1, v, "c")], a.schema) for v in (None, ""))
    assert A.differing_blocks(null, empty, ["id"], ["x", "y"]).isEmpty()


def test_radix_rounding_at_the_cut(spark):
    texts = ["0x" + "8" + "0" * 12 + "400", "0x80000000000004001", "0x8000000000000c000", "0b" + "1" * 54, "0b" + "1" * 61, "0o" + "4" + "0" * 16 + "2001",
             "0X00000000000000000000001", "0x" + "f" * 255, "0x" + "f" * 257, "0b0", "0o000", "0x", "1x5"]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, v string").orderBy("i").select(comparable_number("v")).collect()]

    def want(v):
        try:
            return float(int(v, 0)) if v[:2].lower() in ("0x", "0o", "0b") else None
        except (ValueError, OverflowError):
            return None
    assert got == [want(v) for v in texts]
