"""

Inputs are landed once as delimited text (and, for the encode and diff
operators, as string-typed Parquet) in a scratch folder (not timed); each
query is then run ``BENCH_RUNS`` times (default 3) after one warm-up run and
the median is reported. Full evaluation is forced with the ``noop`` sink or a
small aggregate, never by collecting rows.

Prints one JSON line:
{"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from quayside.functions.quoting import encode_columns, split_fields  # noqa: E402
from quayside.operators import audit as A  # noqa: E402
from quayside.operators import selection as S  # noqa: E402
from quayside.operators import tables as TB  # noqa: E402
from quayside.operators import telemetry as TL  # noqa: E402
from quayside.plans.convert import convert  # noqa: E402
from quayside.plans.landing import land_named_files, land_ranges  # noqa: E402
from quayside.plans.registry import manifest  # noqa: E402
from quayside.session import get_session, scratch_path  # noqa: E402
from quayside.sources.feeds import FEED_BY_KEY  # noqa: E402
from quayside.sources.lines import read_numbered_lines  # noqa: E402
from quayside.streaming.ingest import start_ingest  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(f"local[{cpus}]", int(cpus) * 2, app="quayside-bench")
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    li = t("lineitem")
    li_fields = (F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
                        F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"),
                        F.format_string("%.2f", "l_quantity"), F.format_string("%.2f", "l_extendedprice"),
                        F.concat(F.col("l_returnflag"), F.lit('"x;')), F.col("l_linestatus"),
                        F.date_format("l_shipdate", "yyyy-MM-dd"))
    li_text = li.withColumn("value", encode_columns(list(li_fields), ";"))
    files = max(4, int(cpus))
    lineitem_txt = land_ranges(spark, li_text, "value", ["l_orderkey", "l_linenumber"], "bench-lineitem", files)
    lineitem_zone = land_named_files(  # the same lines as files of a feed: a stream takes no others
        spark, li_text.withColumn("bucket", F.pmod("l_orderkey", F.lit(files))), "value", "bucket",
        ["l_orderkey", "l_linenumber"], "bench-zone", lambda k: f"STOCK_INTRANSIT_2024010100{int(k):02d}00.csv")
    ev = t("events")
    ev_fields = (F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
                        F.col("user_id").cast("string"), F.col("event_type"), F.format_string("%.2f", "value"),
                        F.lpad(F.col("user_id").cast("string"), 5, "0"), F.date_format("ts", "yyyy-MM-dd"))
    events_txt = land_ranges(spark, ev.withColumn("value", encode_columns(list(ev_fields), ",")), "value", ["event_id"],
                             "bench-events", files)
    # string inputs for the encode and diff operators, staged once in several
    # files (formatting doubles with format_string is input preparation, not
    # the operator; the driver's tables are single row groups, one scan task)
    li_strings = scratch_path(spark, "bench-lineitem-strings")
    li.select("l_orderkey", "l_linenumber", *[c.alias(f"f{i}") for i, c in enumerate(li_fields)]) \
        .repartition(files).write.parquet(li_strings)
    right_strings = scratch_path(spark, "bench-lineitem-changed")
    li.filter((F.col("l_orderkey") % 97) != 5).select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 3 == 0, F.format_string("%.3f", "l_extendedprice"))
        .otherwise(F.format_string("%.2f", "l_extendedprice")).alias("price"),
        F.lower("l_returnflag").alias("l_returnflag"), "l_linestatus").repartition(files).write.parquet(right_strings)
    left_strings = scratch_path(spark, "bench-lineitem-base")
    li.select("l_orderkey", "l_linenumber", F.format_string("%.2f", "l_extendedprice").alias("price"),
              "l_returnflag", "l_linestatus").repartition(files).write.parquet(left_strings)
    text_bytes = sum(os.path.getsize(os.path.join(lineitem_txt, f)) for f in os.listdir(lineitem_txt)
                     if not f.startswith((".", "_"))) if os.path.isdir(lineitem_txt) else None

    def q_split():
        lines = spark.read.text(lineitem_txt)
        cells, count = split_fields("value", ";", True, 9)
        noop(lines.select(*cells, count))

    def q_encode():
        staged = spark.read.parquet(li_strings)
        noop(staged.select(encode_columns([F.col(f"f{i}") for i in range(len(li_fields))], ";").alias("v")))

    def q_line_numbers():
        noop(read_numbered_lines(spark, lineitem_txt).select("file", "line_no"))

    def q_infer_types():
        lines = spark.read.text(events_txt)
        table = TB.to_table_positional(TB.parse(lines, ","), 7, base=0, pad=True, strict=False)
        TB.infer_types(table)

    def q_convert():
        convert(spark, lineitem_txt, scratch_path(spark, "bench-out"), "30D_SALES").collect()

    def q_table_diff():
        left, right = spark.read.parquet(left_strings), spark.read.parquet(right_strings)
        A.table_diff(left, right, ["l_orderkey", "l_linenumber"]).collect()

    def q_retain_last():
        logs = li.select(F.col("l_returnflag").alias("job"), F.col("l_shipdate").alias("ts"),
                         (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))
        noop(TL.retain_last(logs, ["job"]))

    def q_latest_and_day_scan():
        m = manifest(spark, sf_dir)
        S.latest_by_stamp(S.candidates(m)).collect()
        days = t("orders").select(F.col("o_orderdate").cast("date").alias("day"))
        noop(S.day_scan(spark, m, days))

    def q_stream_ingest():
        out, quar, ckpt = (scratch_path(spark, n) for n in ("bench-ingest", "bench-quar", "bench-ckpt"))
        start_ingest(spark, lineitem_zone, FEED_BY_KEY["STOCK_INTRANSIT"], out, quar, ckpt).awaitTermination()

    queries = {
        "split_quoted": q_split,
        "encode_csv": q_encode,
        "line_numbers": q_line_numbers,
        "infer_types": q_infer_types,
        "convert_feed": q_convert,
        "table_diff": q_table_diff,
        "retain_last_1000": q_retain_last,
        "latest_and_day_scan": q_latest_and_day_scan,
        "stream_ingest": q_stream_ingest,
    }
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    results = {}
    for name, fn in queries.items():
        if only and name not in only:
            continue
        fn()  # warm-up
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_median_sec", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus), "runs": runs, "lineitem_text_bytes": text_bytes,
    }))


if __name__ == "__main__":
    main()
