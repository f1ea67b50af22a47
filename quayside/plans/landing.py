"""Land tables as delimited text in the shared scratch folder.

The driver's tables are Parquet; the feed operators read landed text. These
helpers write lines derived from a table so that every check runs the real
scan -> parse -> table path over the whole table. Files are cut by a bucket
column (one folder and one file per bucket) or by key range.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import FILE_THREADS, remove, scratch_path


#: Rows that a task sorts at most, but for rows of one key: some 56 MB of short lines.
RANGE_ROWS = 500_000


def land_buckets(spark: SparkSession, df: DataFrame, value: str, bucket: str, order: list[str], name: str,
                 header: str | None = None) -> str:
    """One text file per ``bucket`` value (folder ``bucket=<v>``), lines in
    ``order``; with ``header`` every file starts with that line."""
    path = scratch_path(spark, name)
    body = df.select(F.col(bucket), *[F.col(c) for c in order], F.col(value).alias("value"), F.lit(1).alias("_h"))
    if header is not None:
        heads = df.select(F.col(bucket)).distinct().select(
            F.col(bucket), *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order],
            F.lit(header).alias("value"), F.lit(0).alias("_h"))
        body = body.unionByName(heads)
    # tasks put their files in place side by side; the driver would move them one by one when the job ends
    (body.repartition(F.col(bucket)).sortWithinPartitions(bucket, "_h", *order)
     .select(bucket, "value").write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy(bucket).text(path))
    return path


def land_ranges(spark: SparkSession, df: DataFrame, value: str, order: list[str], name: str, files: int | None = None) -> str:
    """Text files cut by ranges of ``order[0]``, as many as the session's shuffle makes of the
    input (or ``files``); lines sorted by ``order``."""
    path = scratch_path(spark, name)
    cut = [files, F.col(order[0])] if files else [F.col(order[0])]
    (df.repartitionByRange(*cut).sortWithinPartitions(*order)
     .select(F.col(value).alias("value")).write.mode("overwrite").text(path))
    return path


def land_named_files(spark: SparkSession, df: DataFrame, value: str, bucket: str, order: list[str], name: str,
                     file_name, header: str | None = None, root: str | None = None) -> str:
    """Like ``land_buckets``, then each bucket's file is renamed to
    ``file_name(bucket_value)`` directly under the returned root (a landing
    zone of feed files). Renames are metadata operations, one per bucket."""
    staged = land_buckets(spark, df, value, bucket, order, name, header)
    root = root or scratch_path(spark, f"{name}-zone")
    jvm = spark.sparkContext._jvm
    path_of = jvm.org.apache.hadoop.fs.Path  # looked up once: each look is several calls
    fs = path_of(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path_of(root))
    found = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.globStatus(path_of(f"{staged}/*=*/part-*")))
    parts: dict[str, list[str]] = {}
    for part in sorted(p.toString() for p in found):
        parts.setdefault(part.rsplit("/", 2)[1].split("=", 1)[1], []).append(part)

    def place(bucket_parts: tuple[str, list[str]]) -> None:
        key, mine = bucket_parts
        for i, part in enumerate(mine):
            target = file_name(key) if i == 0 else file_name(key).replace(".csv", f"_{i}.csv")
            fs.rename(path_of(part), path_of(f"{root}/{target}"))

    with ThreadPoolExecutor(FILE_THREADS) as pool:
        list(pool.map(place, parts.items()))
    return root


def land_file(spark: SparkSession, df: DataFrame, value: str, order: list[str], name: str, file_name: str,
              header: str | None = None, root: str | None = None) -> str:
    """All of ``df`` as one file ``file_name`` directly under the returned root, lines in ``order``.

    The lines are cut by ranges of ``order`` of some ``RANGE_ROWS`` rows, at least one a core, and
    sorted range by range, side by side; their number is given, so no setting merges them. The task that
    writes the file reads the sorted ranges one after the other: it sorts nothing and holds a batch
    of rows, whatever the size of the table. An empty table lands no file."""
    ranges, staged = scratch_path(spark, f"{name}-ranges"), scratch_path(spark, name)
    body = df.select(*[F.col(c) for c in order], F.col(value).alias("value"), F.lit(1).alias("_h"))
    if header is not None:  # NULLs come first, so the header is in the first range
        head = df.limit(1).select(*[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order],
                                  F.lit(header).alias("value"), F.lit(0).alias("_h"))
        body = body.unionByName(head)
    cuts = max(spark.sparkContext.defaultParallelism, -(-df.count() // RANGE_ROWS))
    body.repartitionByRange(cuts, *[F.col(c) for c in order]).sortWithinPartitions("_h", *order).select("value").write.parquet(ranges)
    jvm = spark.sparkContext._jvm
    src = jvm.org.apache.hadoop.fs.Path(ranges)
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = root or scratch_path(spark, f"{name}-zone")
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(root))
    parts = sorted(p.getPath().toString() for p in fs.listStatus(src) if p.getPath().getName().startswith("part-"))
    sorted_ranges = [spark.read.schema("value string").parquet(p) for p in parts]
    reduce(DataFrame.unionAll, sorted_ranges).coalesce(1).write.text(staged)
    for i, part in enumerate(sorted((p.getPath() for p in fs.listStatus(jvm.org.apache.hadoop.fs.Path(staged))
                                     if p.getPath().getName().startswith("part-") and p.getLen()), key=lambda p: p.getName())):
        target = file_name if i == 0 else file_name.replace(".csv", f"_{i}.csv")
        fs.rename(part, jvm.org.apache.hadoop.fs.Path(f"{root}/{target}"))
    remove(spark, ranges, staged)
    return root
