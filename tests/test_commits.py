"""F3 and K1 by commits: what is read is whole, at every moment."""

import threading

import pytest
from pyspark.sql import functions as F

from quayside.operators import commits
from quayside.operators.commits import commit, commit_numbers, current, publish_version, read_published, vacuum
from quayside.sources.catalog import ensure_dir
from quayside.sources.feeds import FEED_BY_KEY
from quayside.streaming import ingest


def stage(spark, tmp, name, **feeds):
    for feed, value in feeds.items():
        spark.range(5).select("id", F.lit(value).alias("v")).write.parquet(f"{tmp}/{name}/feed={feed}")
    return f"{tmp}/{name}"


def values(spark, target, feed):
    return {r["v"] for r in read_published(spark, target, feed).collect()}


def test_reader_meets_no_gap(spark, tmp):
    target = ensure_dir(spark, f"{tmp}/serving")
    staged = [stage(spark, tmp, f"s{k}", SCCT=k, CLOSING_STOCK=k) for k in range(4)]
    publish_version(spark, staged[0], target, ["SCCT", "CLOSING_STOCK"])
    stop, met, failed = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                folders = current(spark, target)
                both = [{r["v"] for r in spark.read.parquet(f"{target}/{folders[f]}").collect()} for f in ("SCCT", "CLOSING_STOCK")]
                met.append(both)
            except Exception as exc:  # noqa: BLE001 - the test reports it
                failed.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    for k in (1, 2, 3):
        publish_version(spark, staged[k], target, ["SCCT", "CLOSING_STOCK"], move=k == 2)
    stop.set()
    reader.join()
    assert not failed and met and all(a == b and len(a) == 1 for a, b in met)
    assert values(spark, target, "SCCT") == {3}
    assert len(vacuum(spark, target, keep=1)) == 6 and commit_numbers(spark, target) == [4]
    assert values(spark, target, "CLOSING_STOCK") == {3} and vacuum(spark, target, keep=1) == []


def test_failures_publish_nothing(spark, tmp, monkeypatch):
    target = ensure_dir(spark, f"{tmp}/serving")
    staged = stage(spark, tmp, "s", SCCT=1)
    publish_version(spark, staged, target, ["SCCT"])
    with pytest.raises(FileNotFoundError, match="missing for: 30D_SALES"):
        publish_version(spark, staged, target, ["SCCT", "30D_SALES"])
    with pytest.raises(FileNotFoundError, match="target not reachable"):
        publish_version(spark, staged, f"{tmp}/nowhere", ["SCCT"])
    with pytest.raises(FileNotFoundError, match="not published"):
        read_published(spark, target, "30D_SALES")
    monkeypatch.setattr(commits, "commit_numbers", lambda *a: [])  # another writer that read the log before the first publish
    with pytest.raises(FileExistsError):
        publish_version(spark, stage(spark, tmp, "late", SCCT=9), target, ["SCCT"])
    monkeypatch.undo()
    assert commit_numbers(spark, target) == [1] and values(spark, target, "SCCT") == {1}
    with pytest.raises(FileExistsError):
        commit(spark, target, 1, {})


def test_killed_batch_shows_nothing_and_replay_is_found(spark, tmp, writer, monkeypatch):
    feed = FEED_BY_KEY["STOCK_INTRANSIT"]
    files = ["file://" + writer(tmp, f"in/STOCK_INTRANSIT_2024010100000{k}.csv", text) for k, text in enumerate([b"a;b\nc;d\nx\n", b"1;2;3\n"])]
    out, aside = f"{tmp}/out", f"{tmp}/aside"
    real, calls = ingest.write_staged, []

    def dies(df, folder, *more):
        calls.append(folder)
        if len(calls) == 3:  # the first shape and its quarantine are written, the second shape is not
            raise RuntimeError("killed")
        return real(df, folder, *more)

    monkeypatch.setattr(ingest, "write_staged", dies)
    with pytest.raises(RuntimeError, match="killed"):
        ingest.ingest_batch(spark, files, feed, out, aside, 0)
    assert ingest.ingested_shapes(spark, out, feed) == []
    monkeypatch.setattr(ingest, "write_staged", real)
    ingest.ingest_batch(spark, files, feed, out, aside, 0)
    shapes = ingest.ingested_shapes(spark, out, feed)
    assert [s.split("/")[0] for s in shapes] == ["n=2", "n=3"]
    got = sorted((r["column1"], r["ingest_batch"], r["feed"]) for s in shapes for r in ingest.read_ingested(spark, out, feed, s).collect())
    assert got == [("1", 0, feed.key), ("a", 0, feed.key), ("c", 0, feed.key)]
    assert [r["value"] for r in ingest.read_quarantined(spark, out, aside, feed).collect()] == ["x"]
    monkeypatch.setattr(ingest, "write_staged", lambda *a: pytest.fail("a committed batch was written again"))
    ingest.ingest_batch(spark, files, feed, out, aside, 0)
    with pytest.raises(ValueError, match="other files"):
        ingest.ingest_batch(spark, files[:1], feed, out, aside, 0)
