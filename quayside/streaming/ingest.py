"""K1 incremental landing ingest with Structured Streaming.

The stream tracks *which* files are new (a ``binaryFile`` stream with the
content column pruned: only paths, sizes and times are read), so each landed
file is processed exactly once across restarts (the checkpoint records the
consumed files). Every micro-batch runs the batch operators over its new files
of the feed (C1: other names in the folder are left alone): numbered lines,
quote repair, the table builder of the conversion, quarantine, and an idempotent
write.

Files of one shape - field count, header and column types - form one table:
``n=<fields>/shape=<digest>/feed=<key>/ingest_batch=<id>``, written in overwrite
mode, so a replayed batch replaces its own output and nothing else. Every line
of a batch must be in its tables, its quarantine or a header, or the batch fails.

A batch ends with one commit (``operators.commits``) that lists its folders.
``read_ingested`` and ``read_quarantined`` take committed batches only, so all shapes and
the quarantine of a batch appear together, and one that died between two shapes
shows nothing; a replay of a committed batch finds its commit and does nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import tables as TB
from quayside.operators.commits import LOG, commit, commit_numbers, read_commit
from quayside.operators.selection import stamp_files
from quayside.operators.sinks import write_staged
from quayside.plans.convert import profile_source, shaped_table, stamp_of
from quayside.session import remove
from quayside.sources.feeds import Feed

MAX_FILES = 1000

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def shape_digest(table: DataFrame) -> str:
    """Names and types of a table's columns, as a folder name."""
    return hashlib.sha256(repr([(f.name, f.dataType.simpleString()) for f in table.schema.fields]).encode()).hexdigest()[:12]


def ingest_batch(spark: SparkSession, files: list[str], feed: Feed, out: str, quarantine: str, batch_id: int) -> None:
    """One micro-batch: the new files of ``feed``, grouped by first-line shape."""
    log = _log(out, feed)
    if not files:
        return
    if batch_id in commit_numbers(spark, log):
        if read_commit(spark, log, batch_id)["files"] != files:
            raise ValueError(f"{out} holds a batch {batch_id} of other files: go on with its checkpoint, or write elsewhere")
        return
    made: dict = {"files": files, "tables": [], "quarantine": [], "rows": 0, "rejected": 0}
    prof = profile_source(spark, files, feed, widest=False)
    try:
        groups: dict[tuple, list] = {}
        for r in prof.per_file.select("file", "first", "lines").collect():  # one row per new file (<= MAX_FILES)
            groups.setdefault((len(r["first"]), tuple(r["first"]) if feed.has_header else None), []).append(r)
        stamps = prof.per_file.select("file", stamp_of(feed).alias("_stamp"))  # a row per new file (<= MAX_FILES)
        for (n, header), rows in groups.items():
            mine = F.col("file").isin(*[r["file"] for r in rows]) if len(groups) > 1 else F.lit(True)
            good, bad = TB.split_by_arity(prof.lines.filter(mine), n)  # every file of the group has n fields on line 1
            good = good.join(F.broadcast(stamps), "file", "left")
            keep = [F.col("file"), F.col("line_no"), F.col("_stamp")]
            table = shaped_table(good, prof.unnumbered.filter(mine), feed, n, list(header) if header else None, False, keep)
            shape = shape_digest(table)
            seen = [Observation(), Observation()]
            counted = [df.observe(o, F.count(F.lit(1)).alias("rows")) for df, o in zip((table, bad), seen)]
            # one folder per (shape, feed, batch): a replayed batch overwrites its own folder only
            made["tables"].append(f"n={n}/shape={shape}/feed={feed.key}/ingest_batch={batch_id}")
            made["quarantine"].append(f"feed={feed.key}/ingest_batch={batch_id}/n={n}/shape={shape}")
            write_staged(counted[0], f"{out}/{made['tables'][-1]}", feed.row_group_bytes)
            write_staged(counted[1], f"{quarantine}/{made['quarantine'][-1]}")
            want = sum(r["lines"] for r in rows) - (len(rows) if feed.has_header else 0)
            good_rows, bad_rows = (o.get["rows"] for o in seen)
            got = good_rows + bad_rows
            made["rows"], made["rejected"] = made["rows"] + good_rows, made["rejected"] + bad_rows
            if got != want:
                raise RuntimeError(f"batch {batch_id} of {feed.key}: {want} lines in the source, {got} written")
        commit(spark, log, batch_id, made)
    finally:
        remove(spark, *prof.written)


def _log(out: str, feed: Feed) -> str:
    return f"{out}/_log/{feed.key}"


def _committed(spark: SparkSession, out: str, feed: Feed, kind: str) -> list[str]:
    log = _log(out, feed)
    return [folder for n in commit_numbers(spark, log) for folder in read_commit(spark, log, n)[kind]]


def ingested_shapes(spark: SparkSession, out: str, feed: Feed) -> list[str]:
    """The tables of a feed (``n=<fields>/shape=<digest>``) that committed batches have written to."""
    return sorted({folder.split("/feed=")[0] for folder in _committed(spark, out, feed, "tables")})


def read_ingested(spark: SparkSession, out: str, feed: Feed, shape: str) -> DataFrame:
    """One table of a feed, committed batches only, with ``feed`` and ``ingest_batch``."""
    folders = [f for f in _committed(spark, out, feed, "tables") if f.startswith(f"{shape}/")]
    return spark.read.option("basePath", f"{out}/{shape}").parquet(*[f"{out}/{f}" for f in folders])


def read_quarantined(spark: SparkSession, out: str, quarantine: str, feed: Feed) -> DataFrame:
    """What committed batches of a feed put aside, with ``feed``, ``ingest_batch``, ``n`` and ``shape``."""
    return spark.read.option("basePath", quarantine).parquet(*[f"{quarantine}/{f}" for f in _committed(spark, out, feed, "quarantine")])


def ingest_progress(spark: SparkSession, out: str, feed: Feed) -> DataFrame:
    """D3 of a stream: ``DF[ingest_batch, files, rows, rejected, total]``, a row per committed batch;
    ``total`` counts the rows and rejected lines up to it. It grows while the stream runs, and
    what it counts can be read: both come from the commits."""
    log, schema = _log(out, feed), "files array<string>, rows bigint, rejected bigint"
    if not commit_numbers(spark, log):
        return spark.createDataFrame([], "ingest_batch bigint, files int, rows bigint, rejected bigint, total bigint")
    batches = spark.read.schema(schema).json(f"{log}/{LOG}/*.json").select(
        F.regexp_extract("_metadata.file_name", r"\d+", 0).cast("bigint").alias("ingest_batch"),
        F.size("files").alias("files"), "rows", "rejected")
    upto = Window.orderBy("ingest_batch").rowsBetween(Window.unboundedPreceding, 0)  # a row per batch
    return batches.withColumn("total", F.sum(F.col("rows") + F.col("rejected")).over(upto))


def start_ingest(spark: SparkSession, landing: str, feed: Feed, out: str, quarantine: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start K1 over ``landing``; returns the StreamingQuery. Each micro-batch
    takes at most ``max_files_per_trigger`` new files (default ``MAX_FILES``: bounds the
    per-batch file list and the first lines the driver sees). A file's age never
    hides it: one with an old modification time is taken when it is first seen."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("recursiveFileLookup", "true")
              .option("maxFileAge", "36500d").option("maxFilesPerTrigger", str(max_files_per_trigger or MAX_FILES)))
    new_files = reader.load(landing).select("path", "length")

    def _batch(df: DataFrame, batch_id: int) -> None:
        named = stamp_files(df.withColumn("name", F.regexp_extract("path", "[^/]*$", 0)))
        paths = [r["path"] for r in named.filter((F.col("feed") == feed.key) & (F.col("length") > 0)).select("path").collect()]
        ingest_batch(spark, sorted(paths), feed, out, quarantine, batch_id)

    writer = new_files.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
