"""A2 tolerant raw-line scan and A3 line numbers.

``spark.read.text`` is splittable: a 100 GB file is read by hundreds of tasks.
Each line ends at CR, LF or CRLF; a leading UTF-8 BOM is dropped by the line
reader; invalid bytes become U+FFFD with ``make_valid_utf8``.

Line numbers (1-based, per file) are computed without moving the lines:

1. the scan tags each line with ``monotonically_increasing_id()`` directly on
   top of the scan, so ids are consecutive inside one (file, block) split;
2. a small aggregate of fixed-width columns (a hash aggregate: nothing is
   sorted) gives, per (file, block), the line count and the first id; a window
   over that table (one row per split, not per line) gives the number of lines
   in the earlier blocks of the same file;
3. that table is written to the shared checkpoint folder and joined back.

Both scans must cut the same splits. Split sizes follow session settings, one
of which follows the live parallelism unless it is set; ``pin_layout`` sets it.
The join is a left join, and a line whose split is unknown, or has other lines
than were counted, raises: no line can be lost by a change between the scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import materialize

# one row per split; ~50 bytes a row. Beyond it the join is a shuffle, with the same result.
BLOCK_BROADCAST_MAX_ROWS = 200_000


def pin_layout(spark: SparkSession) -> None:
    """Fix the part of the split layout that would follow executors that come and go."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(max(1, spark.sparkContext.defaultParallelism)))


def _paths(paths: str | list[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _text(spark: SparkSession, paths: str | list[str], recursive: bool) -> DataFrame:
    reader = spark.read.format("text")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(_paths(paths))


def read_lines(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> DataFrame:
    """A2: ``DF[file, file_size, mtime, block, value]``, value decoded leniently."""
    return _text(spark, paths, recursive).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("_metadata.file_block_start").alias("block"),
        F.make_valid_utf8(F.col("value")).alias("value"),
    )


def tagged_lines(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> DataFrame:
    """``read_lines`` with the id of each line and the key of its file."""
    pin_layout(spark)
    raw = read_lines(spark, paths, recursive).withColumn("_rid", F.monotonically_increasing_id())
    return raw.withColumn("_fkey", F.xxhash64("file"))


def split_table(raw: DataFrame, **counts: Column) -> DataFrame:
    """One written row per (file, block): lines, first id, lines before it in its file, and
    ``counts`` (fixed-width aggregates)."""
    blocks = raw.groupBy("_fkey", "block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_rid").alias("_rid0"), *[c.alias(k) for k, c in counts.items()])
    earlier = Window.partitionBy("_fkey").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "split-table")


def number_lines(raw: DataFrame, blocks: DataFrame) -> DataFrame:
    """Adds ``line_no``; raises on a split that ``blocks`` does not describe."""
    offsets = blocks.select("_fkey", "block", "_n", "_rid0", "_before")
    if blocks.count() <= BLOCK_BROADCAST_MAX_ROWS:
        offsets = F.broadcast(offsets)
    at = F.col("_rid") - F.col("_rid0")
    known = F.col("_n").isNotNull() & (at >= 0) & (at < F.col("_n"))
    changed = F.raise_error(F.concat(F.lit("splits of "), F.col("file"), F.lit(" changed between two scans (at byte "),
                                     F.col("block").cast("string"), F.lit("); run again")))
    line_no = F.when(known, at + F.col("_before") + F.lit(1)).otherwise(changed.cast("bigint"))
    return raw.join(offsets, ["_fkey", "block"], "left").withColumn("line_no", line_no)


def read_numbered_lines(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> DataFrame:
    """A2 + A3: ``DF[file, file_size, mtime, line_no, value]`` with the 1-based
    line number of each line inside its file."""
    raw = tagged_lines(spark, paths, recursive)
    return number_lines(raw, split_table(raw)).select("file", "file_size", "mtime", "line_no", "value")
