"""A3 for converted rows: line numbers that are resolved when they are read.

A row is written with its file, its split (byte offset of the split in the file) and its
place ``_rid``, which the scan gives out without knowing how many lines earlier splits have.
Beside the rows, in a folder that readers of the table skip, lies one row per split: the
``_rid`` of its first line, the lines before it in its file, and the stamp in the file's
name. ``with_line_numbers`` joins the two. So numbering needs no pass over the source, and a
name is taken apart once a split, not once a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.sources.catalog import path_exists

#: Where a row of an output comes from; no part of the data.
ORIGIN = ["_file", "_split", "_rid"]
OFFSETS = "_offsets"
# a row per split, about 150 bytes with its path; beyond it the join is a shuffle, with the same result
OFFSETS_BROADCAST_MAX_ROWS = 50_000


def split_facts(rows: DataFrame) -> DataFrame:
    """``DF[file, split, rows, low, high]``: what was written of each split."""
    return rows.groupBy(F.col("_file").alias("file"), F.col("_split").alias("split")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_rid").alias("low"), F.max("_rid").alias("high"))


def offsets_of(facts: DataFrame, header: bool) -> DataFrame:
    """``DF[file, split, first, before]`` from splits of which every line but a header was written."""
    head = F.lit(1 if header else 0)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.col("split") == 0
    return facts.select("file", "split", F.when(starts, F.col("low") - head).otherwise(F.col("low")).alias("first"),
                        F.when(starts, F.lit(0)).otherwise(F.coalesce(F.sum("rows").over(earlier), F.lit(0)) + head).cast("bigint").alias("before"))


def write_offsets(offsets: DataFrame, folder: str, stamp: Column) -> None:
    """``stamp``: the stamp in the name of ``file``."""
    offsets.withColumn("stamp", stamp).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{OFFSETS}")


def read_offsets(spark: SparkSession, folder: str) -> DataFrame:
    if not path_exists(spark, f"{folder}/{OFFSETS}"):
        raise FileNotFoundError(f"{folder} has no {OFFSETS}: not the output of a conversion")
    return spark.read.parquet(f"{folder}/{OFFSETS}")


def with_line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """The converted table in ``folder`` with ``_line_no`` and ``_stamp`` in place of ``_split`` and ``_rid``."""
    table, offsets = spark.read.parquet(folder), read_offsets(spark, folder)
    offsets = offsets.withColumnsRenamed({"file": "_file", "split": "_split"})
    if offsets.count() <= OFFSETS_BROADCAST_MAX_ROWS:
        offsets = F.broadcast(offsets)
    unknown = F.raise_error(F.concat(F.lit("no offset of a split of "), F.col("_file"))).cast("bigint")
    number = F.when(F.col("first").isNotNull(), F.col("_rid") - F.col("first") + F.col("before") + 1).otherwise(unknown)
    out = table.join(offsets, ["_file", "_split"], "left").withColumn("_line_no", number)
    data = [c for c in table.columns if c not in ORIGIN]
    return out.select(*data, "_file", "_line_no", F.col("stamp").alias("_stamp"))


def first_rows(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """The first ``n`` rows by file and line, read from where they are: the first splits that
    hold so many (``n`` at most) become a filter on file, split and place."""
    table = spark.read.parquet(folder)
    wanted, left = None, n
    for r in read_offsets(spark, folder).orderBy("file", "split").limit(n).collect():
        # places are consecutive but for a header and lines in quarantine, so n rows may need more than n places:
        # a split is asked for n places at first, and for all of it if that gives too few
        part = (F.col("_file") == r["file"]) & (F.col("_split") == r["split"])
        near = part & (F.col("_rid") <= r["first"] + n)
        got = table.filter(near).limit(n).count()
        if got < min(left, n):
            near, got = part, table.filter(part).limit(n).count()
        wanted = near if wanted is None else wanted | near
        left -= got
        if left <= 0:
            break
    if wanted is None:
        return table.limit(0)
    return table.filter(wanted).orderBy("_file", "_split", "_rid").limit(n)
