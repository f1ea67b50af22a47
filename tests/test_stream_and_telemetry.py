"""J1-J6 semantics on small logs, and stream = batch for K1 and K2."""

import datetime as dt
import os

from pyspark.sql import functions as F

from quayside.operators import tables as TB
from quayside.operators import telemetry as TL
from quayside.plans.convert import profile_source
from quayside.sources.feeds import FEED_BY_KEY
from quayside.streaming import read_liveness, start_ingest, start_liveness
from tests.conftest import write_bytes

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(sec):
    return T0 + dt.timedelta(seconds=sec)


def test_retain_last_keeps_newest_per_key(spark):
    rows = [("d", "j1", f"{i:05d}", ts(i), f"m{i}") for i in range(1500)] + [("d", "j2", "x", ts(5), "only")]
    logs = spark.createDataFrame(rows, "device string, job string, id string, ts timestamp, message string")
    kept = TL.retain_last(logs, ["device", "job"])
    got = {r["job"]: r["n"] for r in kept.groupBy("job").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"j1": 1000, "j2": 1}
    assert kept.filter(F.col("job") == "j1").agg(F.min("id")).collect()[0][0] == "00500"


def test_expire_keys_uses_last_write(spark):
    logs = spark.createDataFrame(
        [("a", ts(0)), ("a", ts(150000)), ("b", ts(0)), ("b", ts(10)), ("c", ts(200000))], "job string, ts timestamp")
    kept = TL.expire_keys(logs, ["job"]).collect()
    assert sorted(r["job"] for r in kept) == ["a", "a", "c"]  # a's old entry stays: the key lives on


def test_since_last_run(spark):
    logs = spark.createDataFrame([("j1", ts(1)), ("j1", ts(5)), ("j1", ts(9)), ("j2", ts(3))], "job string, ts timestamp")
    cmds = spark.createDataFrame([("RUN", "j1", ts(4)), ("STOP", "j1", ts(8)), ("RUN", "j1", ts(2))],
                                 "command string, job string, created_at timestamp")
    kept = sorted((r["job"], r["ts"]) for r in TL.since_last_run(logs, cmds).collect())
    assert kept == [("j1", ts(5)), ("j1", ts(9)), ("j2", ts(3))]


def test_liveness_ttl(spark):
    hb = spark.createDataFrame([("d1", "RUNNING", "SCCT", ts(0)), ("d1", "IDLE", None, ts(1000)),
                                ("d2", "RUNNING", "30D", ts(500))],
                               "device_id string, status string, current_job string, last_seen timestamp")
    got = {r["device_id"]: (r["status"], r["current_job"], r["online"]) for r in TL.liveness(hb).collect()}
    assert got == {"d1": ("IDLE", None, True), "d2": ("OFFLINE", None, False)}


def test_file_state_fold_and_rollup(spark):
    ev = spark.createDataFrame([
        ("job1", "a", "pending", 0, None, ts(0)), ("job1", "a", "completed", 100, "/o/a", ts(5)),
        ("job1", "b", "converting", 10, None, ts(6)), ("job1", "c", "error", 10, None, ts(7)),
        ("job2", "d", "converting", 10, None, ts(1)), ("job2", "e", "stopped", 0, None, ts(2)),
    ], "job string, file string, status string, progress int, output string, ts timestamp")
    st = TL.fold_file_state(ev)
    got = {(r["job"], r["file"]): r["status"] for r in st.collect()}
    assert got == {("job1", "a"): "completed", ("job1", "b"): "error", ("job1", "c"): "error",
                   ("job2", "d"): "converting", ("job2", "e"): "stopped"}
    roll = {r["job"]: r for r in TL.job_rollup(st).collect()}
    assert roll["job1"]["success"] is False and roll["job1"]["first_error_file"] == "b"
    assert roll["job2"]["running"] is True and roll["job2"]["success"] is True
    sel = st.withColumn("selected", F.lit(True))
    assert sorted(r["file"] for r in TL.runnable(sel).collect()) == ["b", "c", "e"]


def test_log_view(spark):
    logs = spark.createDataFrame([("f1", "Lỗi tại dòng 3"), ("f1", "ok"), ("f2", "Convert FAILED")], "file string, message string")
    assert [r["severity"] for r in TL.log_view(logs, keyword="  LỖI ").collect()] == ["error"]
    assert TL.log_view(logs, file="f1").count() == 2
    assert TL.log_view(logs, keyword="").count() == 3


def test_stream_ingest_equals_batch(spark, tmp):
    landing = os.path.join(tmp, "landing")
    write_bytes(landing, "STOCK_INTRANSIT_20240101000000.csv", b"a;b;c\nd;e;f\ng;h\ni;j;k\n")
    write_bytes(landing, "sub/STOCK_INTRANSIT_20240102000000.csv", b'x;"y;z";w\n1;2;3\n')
    write_bytes(landing, "STOCK_INTRANSIT_20240103000000.csv", b"p;q\nr;s\n")
    out, quar, ckpt = (os.path.join(tmp, n) for n in ("out", "quar", "ckpt"))
    feed = FEED_BY_KEY["STOCK_INTRANSIT"]
    q = start_ingest(spark, landing, feed, out, quar, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    streamed = sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "n=3"))
                      .select("column1", "column2", "column3").collect())
    prof = profile_source(spark, [landing + "/STOCK_INTRANSIT_20240101000000.csv",
                                  landing + "/sub/STOCK_INTRANSIT_20240102000000.csv"], feed)
    good, bad = TB.split_by_arity(prof.lines, 3)
    batch = sorted(tuple(r) for r in TB.to_table_positional(good, 3, strict=False).collect())
    assert streamed == batch
    assert [(r["line_no"], r["found"]) for r in spark.read.parquet(quar).collect()] == [(3, 2)]
    assert spark.read.parquet(os.path.join(out, "n=2")).count() == 2
    # a restart sees no new file and writes nothing new
    q2 = start_ingest(spark, landing, feed, out, quar, ckpt)
    q2.awaitTermination()
    assert spark.read.parquet(os.path.join(out, "n=3")).count() == len(batch)


def test_stream_liveness_equals_batch(spark, tmp):
    hb = spark.createDataFrame([("d1", "RUNNING", "SCCT", ts(0)), ("d1", "IDLE", None, ts(1000)),
                                ("d2", "RUNNING", "30D", ts(950)), ("d3", "RUNNING", "x", ts(10))],
                               "device_id string, status string, current_job string, last_seen timestamp")
    landing = os.path.join(tmp, "hb")
    hb.repartition(3).write.parquet(landing)
    table, ckpt = os.path.join(tmp, "state"), os.path.join(tmp, "ckpt")
    start_liveness(spark, landing, table, ckpt).awaitTermination()
    streamed = sorted(tuple(r) for r in read_liveness(spark, table).collect())
    batch = sorted(tuple(r) for r in TL.liveness(hb).collect())
    assert streamed == batch
