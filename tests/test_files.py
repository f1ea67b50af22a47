"""File fixtures (FIXTURES.md section 3): real files in a temp folder."""

import os

import pytest
from pyspark.sql import functions as F

from quayside.operators import selection as S
from quayside.operators import tables as TB
from quayside.operators.sinks import publish, write_feed
from quayside.plans.convert import check, convert, profile_source, run_all, run_feed, run_selected
from quayside.sources.catalog import catalog
from quayside.sources.feeds import FEED_BY_KEY
from quayside.sources.lines import read_numbered_lines
from tests.conftest import write_bytes


def lines_of(spark, path):
    return [(r["line_no"], r["value"]) for r in read_numbered_lines(spark, path).orderBy("line_no").collect()]


def test_bom_crlf_and_lone_cr(spark, tmp):
    p = write_bytes(tmp, "a.csv", b"\xef\xbb\xbfa;b\r\nc;d\re;f\n")
    assert lines_of(spark, p) == [(1, "a;b"), (2, "c;d"), (3, "e;f")]


def test_bad_utf8_matches_python_replace(spark, tmp):
    raw = b"ok\xff\xc3(x;\xe2\x82;\xf0\x9f\x98\n"
    p = write_bytes(tmp, "bad.csv", raw)
    want = raw.decode("utf-8", errors="replace").rstrip("\n")
    assert lines_of(spark, p) == [(1, want)]


def test_line_numbers_across_blocks_and_files(spark, tmp):
    body = "".join(f"{i:06d};row\n" for i in range(1, 20001)).encode()
    write_bytes(tmp, "big/one.csv", body)
    write_bytes(tmp, "big/two.csv", b"x\ny\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows = read_numbered_lines(spark, os.path.join(tmp, "big")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    one = sorted((r["line_no"], r["value"]) for r in rows if r["file"].endswith("one.csv"))
    assert len(one) == 20000
    assert all(int(v.split(";")[0]) == n for n, v in one)
    two = sorted((r["line_no"], r["value"]) for r in rows if r["file"].endswith("two.csv"))
    assert two == [(1, "x"), (2, "y")]


def _parsed(spark, path, feed_key):
    return profile_source(spark, [path], FEED_BY_KEY[feed_key]).lines


def test_empties_to_null(spark, tmp):
    p = write_bytes(tmp, "e.csv", b'a;;c\n;"";z\n')
    t = TB.to_table_positional(_parsed(spark, p, "30D_SALES"), 3, keep=["line_no"]).orderBy("line_no").collect()
    assert [tuple(r)[1:] for r in t] == [("a", None, "c"), (None, None, "z")]


def test_quoted_newline_fails_arity(spark, tmp):
    p = write_bytes(tmp, "q.csv", b'"a\nb",c\n')
    parsed = _parsed(spark, p, "SCCT")
    with pytest.raises(Exception, match="wrong field count"):
        TB.to_table_positional(parsed, 1).collect()


@pytest.mark.parametrize("extra", [b"1;2\n", b"1;2;3;4\n"])
def test_ragged_fails_with_line_or_quarantines(spark, tmp, extra):
    p = write_bytes(tmp, "r.csv", b"a;b;c\nd;e;f\n" + extra + b"g;h;i\n")
    parsed = _parsed(spark, p, "30D_SALES")
    with pytest.raises(Exception, match="at line 3"):
        TB.to_table_positional(parsed, 3).collect()
    good, bad = TB.split_by_arity(parsed, 3)
    assert good.count() == 3
    assert [(r["line_no"], r["expected"]) for r in bad.collect()] == [(3, 3)]


def test_blank_middle_fails_conversion_but_audit_skips(spark, tmp):
    p = write_bytes(tmp, "30D_SALES_20240101000000.csv", b"a;b\n\nc;d\n")
    with pytest.raises(Exception, match="wrong field count"):
        convert(spark, p, os.path.join(tmp, "out")).collect()
    prof = profile_source(spark, [p], FEED_BY_KEY["30D_SALES"])
    r = prof.per_file.collect()[0]
    assert (r["rows_nonblank"], r["columns"]) == (2, 2)


def test_empty_file_is_an_error(spark, tmp):
    p = write_bytes(tmp, "30D_SALES_20240101000000.csv", b"")
    with pytest.raises(ValueError, match="no data"):
        convert(spark, p, os.path.join(tmp, "out"))


def test_dup_header_names(spark, tmp):
    assert TB.fix_header_names(["A", "b", "A", "", "x y"]) == ["A", "b", "A_1", "column3", "x y"]
    p = write_bytes(tmp, "SCCT_RAWDATA_LD_WMP_20240101.csv", b"A,b,A,,x y\n1,2,3,4,5\n")
    out = os.path.join(tmp, "out")
    audit = convert(spark, p, out).collect()[0]
    assert [s["name"] for s in audit["parquet"]["schema"]][:5] == ["A", "b", "A_1", "column3", "x y"]
    assert audit["csv"]["rows"] == 1 and audit["parquet"]["rows"] == 1


def test_types_and_leading_zero_and_late_string(spark, tmp):
    rows = [
        "2024-01-01,1,1.5,true,abc,2024-01-01 10:11:12,20240101,10:11:12,007",
        "2024-01-02,2,2,FALSE,def,2024-01-02 00:00:00,20240102,23:59:59,008",
    ]
    p = write_bytes(tmp, "CLOSING_STOCK_20240101000000.csv", ("\n".join(rows) + "\n").encode())
    out = os.path.join(tmp, "out")
    audit = convert(spark, p, out).collect()[0]
    types = [s["type"] for s in audit["parquet"]["schema"] if s["name"] != "feed"]
    assert types == ["date", "bigint", "double", "boolean", "string", "timestamp_ntz", "bigint", "string", "string"]
    names = [s["name"] for s in audit["parquet"]["schema"] if s["name"] != "feed"]
    assert names == [f"column{i}" for i in range(9)]
    ints = "\n".join(str(i) for i in range(3000)) + "\nabc\n"
    q = write_bytes(tmp, "late/CLOSING_STOCK_20240101000000.csv", ints.encode())
    a2 = convert(spark, q, os.path.join(tmp, "out2")).collect()[0]
    assert [s["type"] for s in a2["parquet"]["schema"] if s["name"] != "feed"] == ["string"]


def test_header_20plus_preview_and_check(spark, tmp):
    body = "h1,h2\n" + "".join(f"{i},v{i}\n" for i in range(25))
    p = write_bytes(tmp, "SCCT_RAWDATA_LD_WMP_20240101.csv", body.encode())
    out = os.path.join(tmp, "out")
    audit = convert(spark, p, out).collect()[0]
    assert len(audit["csv"]["preview"]) == 20 and len(audit["parquet"]["preview"]) == 20
    assert audit["csv"]["preview"][0] == ["0", "v0"] and audit["parquet"]["preview"][0] == ["0", "v0"]
    res = check(spark, p, os.path.join(out, "feed=SCCT"), "SCCT").collect()[0]
    assert res["rows_match"] and res["columns_match"] and res["rows_differ"] == 0 and res["rows_compared"] == 20


def test_nested_dirs_and_stamps(spark, tmp):
    root = os.path.join(tmp, "land")
    write_bytes(root, "30D_SALES_20240101000000.csv", b"a;b\n")
    write_bytes(root, "x/y/30D_SALES_20240301000000.csv", b"c;d\n")
    for bad in ["30D_SALES_20241301000000.csv", "30D_SALES_20240231000000.csv", "30D_SALES_2024010100000.csv",
                "30D_SALES_20240501000000_bak.csv"]:
        write_bytes(root, bad, b"z;z\n")
    write_bytes(root, "30D_SALES_20240201000000.CSV", b"e;f\n")
    deep = catalog(spark, root, recursive=True)
    flat = catalog(spark, root, recursive=False)
    assert deep.count() == 7 and flat.count() == 6
    c_flat = {r["name"] for r in S.candidates(flat).collect()}
    assert c_flat == {"30D_SALES_20240101000000.csv", "30D_SALES_20240201000000.CSV"}
    latest = S.latest_by_stamp(S.candidates(deep)).collect()
    assert [r["name"] for r in latest] == ["30D_SALES_20240301000000.csv"]
    with pytest.raises(FileNotFoundError):
        S.require_latest(S.latest_by_stamp(S.candidates(deep)), ["30D_SALES", "SCCT"])
    with pytest.raises(Exception):
        catalog(spark, os.path.join(tmp, "missing")).count()


def test_same_stamp_smallest_path(spark, tmp):
    root = os.path.join(tmp, "land")
    write_bytes(root, "b/SCCT_RAWDATA_LD_WMP_20240101.csv", b"h\n1\n")
    write_bytes(root, "a/SCCT_RAWDATA_LD_WMP_20240101.csv", b"h\n2\n")
    latest = S.latest_by_stamp(S.candidates(catalog(spark, root))).collect()
    assert latest[0]["path"].endswith("/a/SCCT_RAWDATA_LD_WMP_20240101.csv")


def test_other_feeds_and_stale_stamp(spark, tmp):
    target = os.path.join(tmp, "serving")
    a_old = spark.createDataFrame([(1, "old")], "k int, v string")
    write_feed(a_old.withColumn("stamp", F.lit("20240101")), target, feed="30D_SALES")
    write_feed(spark.createDataFrame([(2, "b")], "k int, v string").withColumn("stamp", F.lit("20240101")), target, feed="SCCT")
    write_feed(spark.createDataFrame([(3, "new")], "k int, v string").withColumn("stamp", F.lit("20240202")), target, feed="30D_SALES")
    got = sorted((r["feed"], r["k"], r["stamp"]) for r in spark.read.parquet(target).collect())
    assert got == [("30D_SALES", 3, "20240202"), ("SCCT", 2, "20240101")]
    staged = os.path.join(tmp, "staged")
    write_feed(spark.createDataFrame([(9, "s")], "k int, v string").withColumn("stamp", F.lit("x")), staged, feed="SCCT")
    publish(spark, staged, target, ["SCCT"], mode="per_feed")
    got = sorted((r["feed"], r["k"]) for r in spark.read.parquet(target).collect())
    assert got == [("30D_SALES", 3), ("SCCT", 9)]
    with pytest.raises(FileNotFoundError):
        publish(spark, staged, target, ["SCCT", "30D_SALES"], mode="all_or_nothing")


def test_run_feed_run_all_and_selected(spark, tmp):
    root = os.path.join(tmp, "land")
    write_bytes(root, "30D_SALES_20240101000000.csv", b"a;b\n")
    write_bytes(root, "30D_SALES_20240301000000.csv", b"c;d\ne;f\n")
    write_bytes(root, "CLOSING_STOCK_20240301000000.csv", b"1,x\n2,y\n")
    write_bytes(root, "STOCK_INTRANSIT_20240301000000.csv", b"p;q\n")
    write_bytes(root, "SCCT_RAWDATA_LD_WMP_20240301.csv", b"h1,h2\n1,2\n")
    out = os.path.join(tmp, "out")
    a = run_feed(spark, root, out, "30d_sales").collect()[0]
    assert a["csv"]["rows"] == 2 and a["input"].endswith("30D_SALES_20240301000000.csv")
    target = os.path.join(tmp, "target")
    os.makedirs(target)
    audits = run_all(spark, root, out, target).collect()
    assert sorted(r["feed"] for r in audits) == ["30D_SALES", "CLOSING_STOCK", "SCCT", "STOCK_INTRANSIT"]
    assert sorted(r["feed"] for r in spark.read.parquet(target).select("feed").distinct().collect()) == \
        ["30D_SALES", "CLOSING_STOCK", "SCCT", "STOCK_INTRANSIT"]
    bad = write_bytes(root, "bad/30D_SALES_20240401000000.csv", b"a;b\nc\n")
    states = run_selected(spark, [(os.path.join(root, "STOCK_INTRANSIT_20240301000000.csv"), "STOCK_INTRANSIT"),
                                  (bad, "30D_SALES"), (os.path.join(root, "SCCT_RAWDATA_LD_WMP_20240301.csv"), "SCCT")],
                          out, target)
    assert [s["status"] for s in states] == ["completed", "error", "pending"]


def test_a_changed_split_layout_raises_and_loses_no_line(spark, tmp):
    write_bytes(tmp, "n/one.csv", "".join(f"{i:06d};row\n" for i in range(1, 40001)).encode())
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1024")
        spark.conf.set("spark.sql.files.minPartitionNum", "4")
        lines = read_numbered_lines(spark, os.path.join(tmp, "n"))
        spark.conf.set("spark.sql.files.minPartitionNum", "7")
        with pytest.raises(Exception, match="changed between two scans"):
            lines.collect()
        assert read_numbered_lines(spark, os.path.join(tmp, "n")).agg(F.max("line_no"), F.count("*")).head() == (40000, 40000)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_column_feed_with_a_blank_line(spark, tmp):
    p = write_bytes(tmp, "30D_SALES_20240101000000.csv", b"a\n\nb\n")
    audit = convert(spark, p, os.path.join(tmp, "out")).collect()[0]
    assert (audit["csv"]["rows"], audit["parquet"]["rows"]) == (2, 3)


def test_publish_that_fails_midway_shows(spark, tmp, monkeypatch):
    from quayside.operators import sinks

    target, staged = os.path.join(tmp, "serving"), os.path.join(tmp, "staged")
    os.makedirs(target)
    for feed, v in (("SCCT", 1), ("CLOSING_STOCK", 2)):
        write_feed(spark.createDataFrame([(v,)], "k int"), staged, feed=feed)
        write_feed(spark.createDataFrame([(0,)], "k int"), target, feed=feed)
    real, done = sinks.swap_in, []

    def failing(spark, src, dst):
        if done:
            raise RuntimeError("no")
        done.append(dst)
        real(spark, src, dst)

    monkeypatch.setattr(sinks, "swap_in", failing)
    with pytest.raises(RuntimeError):
        publish(spark, staged, target, ["SCCT", "CLOSING_STOCK"], mode="all_or_nothing")
    assert [r["feed"] for r in sinks.unfinished(spark, target).collect()] == ["CLOSING_STOCK"]
    assert [spark.read.parquet(f"{target}/feed={f}").head()[0] for f in ("SCCT", "CLOSING_STOCK")] == [1, 0]
    assert not os.listdir(os.path.join(target, "_staging"))


def test_radix_numbers_of_any_length(spark):
    from quayside.functions.scalars import comparable_number

    values = ["0x1F", "0o17", "0b101", "0x" + "f" * 40, "0b1" + "0" * 70 + "1", "0x0", "0b" + "0" * 80 + "11", "0o7777777777777777777777777", "0x20000000000001", "0x1fffffffffffff8", "0xg", "0b2"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(comparable_number("v")).collect()]
    assert got == [float(int(v, 0)) if v[2:] not in ("g", "2") else None for v in values]
