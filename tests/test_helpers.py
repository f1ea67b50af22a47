"""Helpers added for speed must agree with the plain forms."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quayside.functions.quoting import encode_columns, encode_csv, split_fields, split_quoted
from quayside.functions.scalars import comparable, comparable_equal
from quayside.operators import tables as TB
from quayside.operators.sinks import publish, write_feed


def test_comparable_equal_matches_comparable_keys(spark):
    vals = [None, "", " ", "7", " 7 ", "007", "7.0", "1e3", "1000", "0x10", "16", "abc", " abc", "ABC", "nan",
            "Infinity", "-0", "0", "+5", "5.", ".5", "0.5", "1d", "1e400"]
    pairs = [(a, b) for a in vals for b in vals]
    df = spark.createDataFrame(pairs, "a string, b string")
    res = df.select((comparable("a") == comparable("b")).alias("k"), comparable_equal("a", "b").alias("e")).collect()
    assert all(r["k"] == r["e"] for r in res)


def test_encode_columns_matches_encode_csv(spark):
    rng = random.Random(3)
    alphabet = ["a", ";", '"', "\n", " ", ""]
    rows = [tuple("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 4))) for _ in range(3)) for _ in range(400)]
    rows += [("", "", ""), ("x", "", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    res = df.select(encode_columns([F.col("a"), F.col("b"), F.col("c")], ";").alias("x"),
                    encode_csv(F.array("a", "b", "c"), ";").alias("y")).collect()
    assert all(r["x"] == r["y"] for r in res)
    one = spark.createDataFrame([("",), ("a;b",)], "a string")
    got = [r[0] for r in one.select(encode_columns([F.col("a")], ";")).collect()]
    assert got == ['""', '"a;b"']


def test_split_fields_matches_split_quoted(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choice(['a', '"', ',', ' ']) for _ in range(rng.randint(0, 12))) for _ in range(800)]
    df = spark.createDataFrame([(x,) for x in lines], ["v"])
    for repair in (False, True):
        cells, count = split_fields("v", ",", repair, 4)
        res = df.select("v", split_quoted("v", ",", repair).alias("f"), count.alias("n"), *[c.alias(f"c{i}") for i, c in enumerate(cells)]).collect()
        for r in res:
            f = list(r["f"])
            assert r["n"] == len(f)
            assert [r[f"c{i}"] for i in range(4)] == (f + [None] * 4)[:4]


def test_type_bits():
    assert TB.type_from_bits(None) == "string"
    bits = {t: 1 << i for i, t in enumerate(TB.TYPE_LADDER)}
    assert TB.type_from_bits(bits["bigint"]) == "bigint"
    assert TB.type_from_bits(bits["bigint"] | bits["double"]) == "double"
    assert TB.type_from_bits(bits["bigint"] | bits["boolean"]) == "string"
    assert TB.type_from_bits(bits["time"]) == "string"
    assert TB.type_from_bits(bits["date"] | bits["timestamp_ntz"]) == "string"
    assert TB.type_from_bits(bits["bigint"] | (1 << len(TB.TYPE_LADDER))) == "string"


def test_publish_all_or_nothing_and_log(spark, tmp):
    target = os.path.join(tmp, "serving")
    os.makedirs(target)
    staged = os.path.join(tmp, "staged")
    write_feed(spark.createDataFrame([(1, "a")], "k int, v string"), target, feed="SCCT")
    write_feed(spark.createDataFrame([(2, 3)], "k int, v int"), staged, feed="CLOSING_STOCK")
    write_feed(spark.createDataFrame([(4, "b")], "k int, v string"), staged, feed="SCCT")
    with pytest.raises(FileNotFoundError):
        publish(spark, staged, target, ["SCCT", "30D_SALES"], mode="all_or_nothing")
    assert spark.read.parquet(f"{target}/feed=SCCT").collect()[0]["k"] == 1  # untouched
    publish(spark, staged, target, ["CLOSING_STOCK", "SCCT"], mode="all_or_nothing")
    assert spark.read.parquet(f"{target}/feed=SCCT").collect()[0]["k"] == 4
    assert spark.read.parquet(f"{target}/feed=CLOSING_STOCK").collect()[0]["v"] == 3  # its own schema
    log = spark.read.parquet(f"{target}/_publish").collect()
    assert sorted(r["feed"] for r in log) == ["CLOSING_STOCK", "SCCT"]
    with pytest.raises(FileNotFoundError):
        publish(spark, staged, os.path.join(tmp, "nowhere"), ["SCCT"])


def test_small_operator_helpers(spark, tmp):
    from quayside.operators.audit import numeric_equal
    from quayside.operators.selection import check_exists
    from quayside.sources.feeds import resolve_feed_strict
    from quayside.sources.lines import read_numbered_lines
    from tests.conftest import write_bytes

    df = spark.createDataFrame([("007", "7"), ("1e3", "1000"), ("a", "a"), ("7", "8")], "a string, b string")
    assert [r[0] for r in df.select(numeric_equal(F.col("a"), F.col("b"))).collect()] == [True, True, True, False]
    check_exists(spark, [tmp])
    with pytest.raises(FileNotFoundError):
        check_exists(spark, [os.path.join(tmp, "nope")])
    names = spark.createDataFrame([("scct",), ("",), ("zzz",)], ["n"])
    assert names.filter(F.col("n") == "scct").select(resolve_feed_strict("n")).collect()[0][0] == "SCCT"
    with pytest.raises(Exception, match="missing feed type"):
        names.filter(F.col("n") == "").select(resolve_feed_strict("n")).collect()
    with pytest.raises(Exception, match="unsupported feed type"):
        names.filter(F.col("n") == "zzz").select(resolve_feed_strict("n")).collect()
    p = write_bytes(tmp, "a.csv", b"a;b\nc;d;e\n")
    lines = TB.parse(read_numbered_lines(spark, p), ";")
    assert [r["expected"] for r in TB.file_arity(lines).collect()] == [2]
