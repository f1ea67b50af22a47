"""B5-B13 vectors."""

from pyspark.sql import functions as F

from quayside.functions.scalars import comparable, compression_ratio, file_stamp, severity, size_label
from quayside.sources.feeds import resolve_feed, resolve_feed_name


def test_size_label(spark):
    cases = [(0, "0.0 B"), (1023, "1023.0 B"), (1024, "1.0 KB"), (1280, "1.2 KB"), (1536, "1.5 KB"),
             (1048576, "1.0 MB"), (1024 ** 5, "1.0 PB"), (3 * 1024 ** 4, "3.0 TB"), (2048 * 1024 ** 5, "2048.0 PB")]
    df = spark.createDataFrame([(float(b),) for b, _ in cases], ["b"])
    got = [r[0] for r in df.select(size_label("b")).collect()]
    assert got == [want for _, want in cases]


def test_compression_ratio(spark):
    df = spark.createDataFrame([(50, 100), (100, 0), (120, 100), (1, 3)], ["p", "c"])
    got = [r[0] for r in df.select(compression_ratio("p", "c")).collect()]
    assert got == [50.0, 0.0, -20.0, 66.7]


def test_comparable(spark):
    pairs = [(None, "", True), (" 7 ", "7", True), ("007", "7", True), ("1e3", "1000", True), ("nan", "nan", True),
             ("1d", "1", False), ("abc", "abc", True), ("0x1F", "31", True), ("Infinity", "Infinity", True),
             ("Infinity", "1e400", False), ("-0", "0", True), ("1.50", "1.5", True), (".5", "0.5", True),
             (" 7\t", "7", True), ("a", "A", False)]
    df = spark.createDataFrame([(a, b) for a, b, _ in pairs], "a string, b string")
    got = [r[0] for r in df.select(comparable("a") == comparable("b")).collect()]
    assert got == [eq for _, _, eq in pairs]


def test_file_stamp(spark):
    names = ["30D_SALES_20240101123045.csv", "30D_SALES_20241301123045.csv", "30D_SALES_20240231000000.csv",
             "30D_SALES_2024010112304.csv", "30D_SALES_20240101123045_bak.csv", "30D_SALES_20240101123045.CSV",
             "30d_sales_20240101123045.csv", "30D_SALES_20240101240000.csv"]
    df = spark.createDataFrame([(n,) for n in names], ["name"])
    got = [r[0] for r in df.select(file_stamp("name", "30D_SALES_", 14, "yyyyMMddHHmmss").isNotNull()).collect()]
    assert got == [True, False, False, False, False, True, True, False]


def test_severity(spark):
    msgs = ["Convert FAILED", "Lỗi tại dòng 3", "Hoàn tất 30D", "job complete", "Warning: slow", "Đã dừng",
            "started", "error then success"]
    df = spark.createDataFrame([(m,) for m in msgs], ["m"])
    got = [r[0] for r in df.select(severity("m")).collect()]
    assert got == ["error", "error", "success", "success", "warning", "warning", "info", "error"]


def test_resolve_feed(spark):
    vals = ["30d_sales", " scct ", "SCCT_RAWDATA_LD_WMP", "closing_stock_2024.csv", "STOCK_INTRANSIT_x", "nope", ""]
    df = spark.createDataFrame([(v,) for v in vals], ["v"])
    got = [r[0] for r in df.select(resolve_feed("v")).collect()]
    assert got == ["30D_SALES", "SCCT", "SCCT", "CLOSING_STOCK", "STOCK_INTRANSIT", None, None]
    assert resolve_feed_name("scct").key == "SCCT"
    import pytest

    with pytest.raises(ValueError):
        resolve_feed_name("")
    with pytest.raises(ValueError):
        resolve_feed_name("unknown")


def test_times_ignore_the_session_zone(spark):
    from quayside.functions.scalars import display_stamp, format_time
    from quayside.operators.selection import candidates, latest_by_stamp

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        names = ["30D_SALES_19970406023028.csv", "30D_SALES_19970406031000.csv"]  # 02:30 is in a DST gap there
        df = spark.createDataFrame([(f"/l/{n}", n, 1, None) for n in names], "path string, name string, size long, mtime timestamp")
        c = candidates(df)
        got = sorted(r[0] for r in c.select(display_stamp("stamp")).collect())
        assert got == ["06/04/1997 02:30:28", "06/04/1997 03:10:00"]
        assert latest_by_stamp(c).collect()[0]["name"] == "30D_SALES_19970406031000.csv"
        ntz = spark.createDataFrame([("1997-04-06 02:30:28.5",)], ["s"]).select(F.col("s").cast("timestamp_ntz").alias("t"))
        assert ntz.select(format_time("t", "yyyyMMddHHmmss.SSSSSS")).collect()[0][0] == "19970406023028.500000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
