"""I1 with one read of the text: line numbers resolved on read, types guessed and checked, heads of files."""

import importlib

import pytest
from pyspark.sql import functions as F

from quayside.operators.origin import first_rows, with_line_numbers
from quayside.sources.heads import file_heads, first_records, listed_files

C = importlib.import_module("quayside.plans.convert")  # the package exports its function under the same name


def numbered(spark, out, feed, *cols):
    rows = with_line_numbers(spark, f"{out}/feed={feed}")
    return sorted((r["_file"].rsplit("/", 1)[-1], r["_line_no"], *(r[c] for c in cols)) for r in rows.collect())


@pytest.fixture()
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lines_of_many_splits(spark, tmp, writer, small_splits):
    for k in range(3):
        writer(tmp, f"in/30D_SALES_2024010100000{k}.csv", "".join(f"{k};row {i};{'x' * (i % 37)}\n" for i in range(200)).encode())
    audit = C.convert(spark, f"{tmp}/in", f"{tmp}/out", "30D_SALES").collect()[0]
    assert audit.csv["rows"] == audit.parquet["rows"] == audit.rows_written == 600
    assert [r[1] for r in audit.csv["preview"]] == [f"row {i}" for i in range(20)] == [r[1] for r in audit.parquet["preview"]]
    want = [(f"30D_SALES_2024010100000{k}.csv", i + 1, f"row {i}") for k in range(3) for i in range(200)]
    assert numbered(spark, f"{tmp}/out", "30D_SALES", "column2") == want
    # the numbered way gives the same rows and numbers
    C.write_numbered(spark, [f"{tmp}/in"], C.FEED_BY_KEY["30D_SALES"], f"{tmp}/old/feed=30D_SALES", True, None)
    assert numbered(spark, f"{tmp}/old", "30D_SALES", "column2") == want


def test_header_in_every_file_and_once_as_data(spark, tmp, writer, small_splits, monkeypatch):
    body = lambda k: "".join(f"{k},v{i}\n" for i in range(120))
    for k in range(2):
        writer(tmp, f"in/SCCT_RAWDATA_LD_WMP_2024010{k + 1}.csv", f"key,name\n{body(k)}".encode())
    writer(tmp, "in/SCCT_RAWDATA_LD_WMP_20240109.csv", b"key,name\n1,only\n")
    calls = []
    monkeypatch.setattr(C, "write_numbered", lambda *a, f=C.write_numbered: calls.append(1) or f(*a))
    want = [(f"SCCT_RAWDATA_LD_WMP_2024010{k + 1}.csv", i + 2, f"v{i}") for k in range(2) for i in range(120)] + [("SCCT_RAWDATA_LD_WMP_20240109.csv", 2, "only")]
    audit = C.convert(spark, f"{tmp}/in", f"{tmp}/out", "SCCT").collect()[0]
    assert numbered(spark, f"{tmp}/out", "SCCT", "name") == want and not calls
    assert audit.csv["rows"] == 241 and audit.parquet["preview"][0] == ["0", "v0"] == audit.csv["preview"][0]
    writer(tmp, "in/SCCT_RAWDATA_LD_WMP_20240109.csv", b"key,name\n1,only\nkey,name\n")  # a data line like the header
    C.convert(spark, f"{tmp}/in", f"{tmp}/out", "SCCT").collect()
    assert numbered(spark, f"{tmp}/out", "SCCT", "name") == [*want, ("SCCT_RAWDATA_LD_WMP_20240109.csv", 3, "name")] and calls


def reads(spark, monkeypatch):
    """Counts the writes of a conversion: one per read of the whole text."""
    made = []
    monkeypatch.setattr(C, "write_staged", lambda *a, f=C.write_staged, **k: made.append(a[1]) or f(*a, **k))
    return made


def test_types_guessed_from_heads(spark, tmp, writer, monkeypatch):
    made = reads(spark, monkeypatch)
    lines = [f"{i},1.5,,2024-01-0{i % 9 + 1}" for i in range(300)]
    writer(tmp, "CLOSING_STOCK_20240101000000.csv", "\n".join(lines).encode())
    row = C.convert(spark, f"{tmp}/CLOSING_STOCK_20240101000000.csv", f"{tmp}/out", "CLOSING_STOCK").collect()[0]
    assert [s["type"] for s in row.parquet["schema"]] == ["bigint", "double", "string", "date"] and len(made) == 1
    lines[250] = "late,7,x,"
    writer(tmp, "CLOSING_STOCK_20240101000000.csv", "\n".join(lines).encode())
    row = C.convert(spark, f"{tmp}/CLOSING_STOCK_20240101000000.csv", f"{tmp}/out", "CLOSING_STOCK").collect()[0]
    assert [s["type"] for s in row.parquet["schema"]] == ["string", "double", "string", "date"] and len(made) == 3
    got = spark.read.parquet(f"{tmp}/out/feed=CLOSING_STOCK").filter(F.col("column0") == "late").collect()
    assert [(r.column1, r.column2, r.column3) for r in got] == [(7.0, "x", None)]


def test_misfits_are_named_by_line_and_leave_nothing(spark, tmp, writer):
    writer(tmp, "30D_SALES_20240101000000.csv", b"a;b\nc;d\ne;f;g\n")
    with pytest.raises(Exception, match="at line 3: expected 2, found 3"):
        C.convert(spark, f"{tmp}/30D_SALES_20240101000000.csv", f"{tmp}/out", "30D_SALES")
    import os

    assert not os.path.exists(f"{tmp}/out/feed=30D_SALES")
    assert not any(os.scandir(f"{tmp}/out/_staging")) if os.path.exists(f"{tmp}/out/_staging") else True


def test_heads_and_first_rows(spark, tmp, writer):
    for k, text in enumerate([b"a\n\nb\n", b"", b"\xef\xbb\xbfc\xff\r\nd"]):
        writer(tmp, f"in x/f{k}.csv", text)
    files = listed_files(spark, [f"{tmp}/in x"])
    heads = file_heads(spark, files, 3)
    assert [h.lines for h in heads] == [["a", "", "b"], [], ["c�", "d"]] and [h.whole for h in heads] == [False, True, True]
    blank = lambda v: v == ""
    assert first_records(heads, 2, blank) == [(files[0], 1, "a"), (files[0], 3, "b")]
    assert first_records(heads, 3, blank) is None  # the first file may go on
    assert [x[2] for x in first_records(file_heads(spark, files, 9), 9, blank, 1)] == ["b", "d"]
    writer(tmp, "30D_SALES_20240101000000.csv", b"".join(b"%d;x\n" % i for i in range(50)))
    C.convert(spark, f"{tmp}/30D_SALES_20240101000000.csv", f"{tmp}/out", "30D_SALES")
    top = first_rows(spark, f"{tmp}/out/feed=30D_SALES", 7)
    assert [r.column1 for r in top.collect()] == [str(i) for i in range(7)]
    assert "_rid" in top._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
