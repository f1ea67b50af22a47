"""Landed files: one file from ranges sorted side by side, sound first lines, triggers that follow the files."""

import glob

from pyspark.sql import functions as F

from quayside.plans import landing, registry


def test_one_file_is_made_of_sorted_ranges(spark, tmp, monkeypatch):
    parts = []
    monkeypatch.setattr(landing, "remove", lambda spark, ranges, staged: parts.extend(glob.glob(f"{ranges}/part-*")))
    df = spark.range(0, 3000, 1, 4).select((F.lit(2999) - F.col("id")).alias("k"), F.concat(F.lit("a\r"), F.col("id")).alias("line"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        root = landing.land_file(spark, df, "line", ["k"], "one", "one.csv", header="h;k")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 1 and glob.glob(f"{root}/*.csv") == [f"{root}/one.csv"]
    with open(f"{root}/one.csv", newline="") as fh:
        assert fh.read().split("\n") == ["h;k", *[f"a\r{2999 - k}" for k in range(3000)], ""]
    empty = landing.land_file(spark, df.limit(0), "line", ["k"], "none", "none.csv", header="h;k")
    assert glob.glob(f"{empty}/*.csv") == []


def _lineitem(spark, folder, rows):
    li = spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int").withColumns(
        {"l_returnflag": F.lit("N"), "l_linestatus": F.lit("O"), "l_shipdate": F.lit("2024-01-01").cast("date")})
    li.write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, "bolt", "Brand#1")], "p_partkey bigint, p_name string, p_brand string").write.parquet(f"{folder}/part.parquet")


def test_a_file_whose_smallest_line_is_ragged(spark, tmp):
    _lineitem(spark, tmp, [(7, 4), (8, 1), (8, 2), (15000, 1), (15001, 2)])  # (7, 4) is ragged, and first by key
    assert sorted(r["column1"] for r in registry.q_stream_ingest(spark, tmp).collect()) == ["15000", "15001", "8", "8"]
    for rejected in (registry.q_stream_quarantine, registry.q_arity_quarantine):
        assert [(r["orderkey"], r["expected"], r["found"]) for r in rejected(spark, tmp).collect()] == [("7", 5, 4)]


def test_triggers_do_not_grow_with_the_files(spark, tmp, monkeypatch):
    from quayside.streaming import ingest

    seen, batch = [], ingest.ingest_batch
    monkeypatch.setattr(ingest, "ingest_batch", lambda spark, files, *rest: seen.append(files) or batch(spark, files, *rest))
    _lineitem(spark, tmp, [(15000 * i, 1) for i in range(15)])
    monkeypatch.setattr("quayside.plans.progress.marks", lambda whole, *_: whole.withColumn("mark", F.lit(0)))
    (row,) = registry.q_ingest_progress(spark, tmp).collect()
    assert (row["total"], row["rejected"], row["rising"]) == (15, 0, True)
    assert len(seen) <= registry._TRIGGERS and sum(map(len, seen)) == 15  # 18 files with the three of others


def test_ranges_of_one_file_follow_the_rows_whatever_the_session_merges(spark, tmp, monkeypatch):
    parts = []
    monkeypatch.setattr(landing, "remove", lambda spark, ranges, staged: parts.extend(glob.glob(f"{ranges}/part-*")))
    monkeypatch.setattr(landing, "RANGE_ROWS", 50)
    df = spark.range(2000).select("id", F.col("id").cast("string").alias("value"))
    merging = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1g"}
    for k, v in merging.items():
        spark.conf.set(k, v)
    try:
        root = landing.land_file(spark, df, "value", ["id"], "whatever", "a.csv")
    finally:
        for k in merging:
            spark.conf.unset(k)
    assert [r.value for r in spark.read.text(f"{root}/a.csv").collect()] == [str(i) for i in range(2000)]
    assert len(parts) >= 30
