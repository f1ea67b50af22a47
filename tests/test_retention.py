"""J1 by a time histogram: the same entries as a plain window, at every spread of instants."""

import datetime as dt
import random

import pytest

from quayside.operators.telemetry import retain_last

T0 = dt.datetime(2024, 1, 1)


def brute(rows, n):
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or T0, r[2]), reverse=True)
        out += mine[:n]
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 7, 50])
def test_matches_brute_force(spark, n):
    rng = random.Random(n)
    rows = [("even", T0 + dt.timedelta(seconds=i), i) for i in range(300)]
    rows += [("one instant", T0, 1000 + i) for i in range(200)]
    rows += [("two ends", T0 + dt.timedelta(days=3650 * (i % 2), microseconds=i), 2000 + i) for i in range(200)]
    rows += [("hot", T0 + dt.timedelta(microseconds=rng.randrange(10**12)), 3000 + i) for i in range(2000)]
    rows += [(None, T0 + dt.timedelta(seconds=rng.randrange(9)), 6000 + i) for i in range(60)]
    rows += [("nulls", None if i % 2 else T0, 7000 + i) for i in range(20)] + [("few", T0, 8000)]
    rng.shuffle(rows)
    logs = spark.createDataFrame(rows, "job string, ts timestamp_ntz, id long").repartition(5)
    got = retain_last(logs, ["job"], n)
    assert got.columns == ["job", "ts", "id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, n)
    assert retain_last(logs.limit(0), ["job"], n).collect() == []


def test_older_entries_go_by_a_filter(spark):
    logs = spark.createDataFrame([("a", T0 + dt.timedelta(seconds=i), i) for i in range(5000)], "job string, ts timestamp, id long")
    plan = retain_last(logs, ["job"], 10)
    near = plan._jdf.queryExecution().optimizedPlan().toString()
    assert near.count("row_number") >= 1 and "_cut" in near
