"""A1 flat listings and their differences, D3 progress."""

import os
import time

import pytest
from pyspark.sql import functions as F

from quayside.plans import progress as P
from quayside.plans.convert import convert
from quayside.session import materialize
from quayside.sources.catalog import catalog, catalog_changes
from quayside.sources.feeds import FEED_BY_KEY
from quayside.streaming.ingest import ingest_progress, start_ingest


def test_flat_listing_is_one_folder(spark, tmp, writer):
    for name in ("a.csv", "b [1].csv", "c.txt", "_hidden.csv", ".dot.csv", "sub.csv/d.csv", "sub/deep/e.csv"):
        writer(tmp, name, b"x\n")
    os.chmod(f"{tmp}/sub", 0o700)
    flat = {r["name"]: r for r in catalog(spark, tmp, recursive=False).collect()}
    assert set(flat) == {"a.csv", "b [1].csv", "c.txt"}
    deep = {r["path"]: r for r in catalog(spark, tmp).collect()}
    assert all(deep[r["path"]] == r for r in flat.values())  # the same rows, to the millisecond
    assert {r["name"] for r in catalog(spark, tmp, False, glob="*.csv").collect()} == {"a.csv", "b [1].csv"}
    os.makedirs(f"{tmp}/none")
    assert catalog(spark, f"{tmp}/none", recursive=False).collect() == []
    with pytest.raises(FileNotFoundError, match="PATH_NOT_FOUND"):
        catalog(spark, f"{tmp}/missing", recursive=False)


def test_changes_between_listings(spark, tmp, writer):
    for name in ("same.csv", "size.csv", "time.csv", "gone.csv"):
        writer(tmp, name, b"x\n")
    before = materialize(catalog(spark, tmp), "before")
    writer(tmp, "size.csv", b"xy\n")
    writer(tmp, "new.csv", b"x\n")
    os.utime(f"{tmp}/time.csv", (1, 1))
    os.unlink(f"{tmp}/gone.csv")
    after = catalog(spark, tmp, recursive=False)
    got = {r["name"]: (r["change"], r["size_before"], r["size_after"]) for r in catalog_changes(before, after).collect()}
    assert got == {"size.csv": ("changed", 2, 3), "time.csv": ("changed", 2, 2), "gone.csv": ("gone", 2, None), "new.csv": ("new", None, 2)}
    assert catalog_changes(before, before).collect() == [] and catalog_changes(before, before.limit(0)).count() == 4


def test_rows_are_reported_while_a_job_runs(spark, tmp, monkeypatch):
    monkeypatch.setattr(P, "EVERY", 0.05)
    steps = P.Progress(spark, tmp, "SCCT", step=100)
    slow = F.udf(lambda x: time.sleep(0.01) or x, "bigint")
    spark.sparkContext.setJobGroup("mine", "my job")
    with steps.watch(1000):
        spark.range(0, 400, 1, 40).select(slow("id")).write.mode("overwrite").format("noop").save()
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == "mine"
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    steps.done(1003)
    rows = P.read_progress(spark, tmp).orderBy("seq").collect()
    assert len(rows) > 2 and [r["seq"] for r in rows] == list(range(1, len(rows) + 1))
    assert all(a["rows"] // 100 < b["rows"] // 100 for a, b in zip(rows, rows[1:-1]))
    assert (rows[-1]["state"], rows[-1]["rows"]) == ("done", 1003) and rows[0]["tasks"] == 40
    assert P.latest_progress(P.read_progress(spark, tmp)).collect()[0]["rows"] == 1003


def test_conversion_reports(spark, tmp, writer):
    good = writer(tmp, "in/30D_SALES_20240101000000.csv", b"a;b\n" * 500)
    bad = writer(tmp, "in/STOCK_INTRANSIT_20240101000000.csv", b"a;b\na;b;c\n")
    convert(spark, good, f"{tmp}/out", progress=f"{tmp}/steps")
    with pytest.raises(Exception):
        convert(spark, bad, f"{tmp}/out", progress=f"{tmp}/steps")
    convert(spark, bad, f"{tmp}/out", strict=False, quarantine=f"{tmp}/aside", progress=f"{tmp}/steps")
    last = P.latest_progress(P.read_progress(spark, f"{tmp}/steps"))
    assert sorted((r["feed"], r["state"], r["rows"]) for r in last.collect() if r["state"] == "done") == [
        ("30D_SALES", "done", 500), ("STOCK_INTRANSIT", "done", 1)]
    assert last.where("state = 'failed'").count() == 1
    assert P.read_progress(spark, f"{tmp}/nothing").collect() == []


def test_marks(spark):
    totals = spark.createDataFrame([("a", 250), ("b", 99), ("c", 100), ("d", None), ("e", 0)], "k string, rows bigint")
    assert sorted((r["k"], r["mark"]) for r in P.marks(totals, step=100).collect()) == [("a", 100), ("a", 200), ("c", 100)]
    assert P.STEP == 100_000


def test_stream_totals_grow_with_the_commits(spark, tmp, writer):
    feed = FEED_BY_KEY["30D_SALES"]
    args = (spark, f"{tmp}/in", feed, f"{tmp}/out", f"{tmp}/aside", f"{tmp}/ckpt")
    os.makedirs(f"{tmp}/in")
    assert ingest_progress(spark, f"{tmp}/out", feed).collect() == []
    seen = []
    for day, body in (("01", b"a;b\n" * 3), ("02", b"a;b\na;b;c\n")):
        writer(tmp, f"in/30D_SALES_202401{day}000000.csv", body)
        start_ingest(*args).awaitTermination()
        seen.append([tuple(r) for r in ingest_progress(spark, f"{tmp}/out", feed).orderBy("ingest_batch").collect()])
    assert seen == [[(0, 1, 3, 0, 3)], [(0, 1, 3, 0, 3), (1, 1, 1, 1, 5)]]
