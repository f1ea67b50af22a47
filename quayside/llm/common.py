"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_path

#: Ids sort with NULL after every number, as if it were this one.
LAST_ID = 2**63 - 1
#: The white space of every word and line rule here.
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


class Scratch:
    """Written tables of one operator run, below the shared checkpoint folder.

    Each table cuts the lineage and survives a lost executor. ``drop`` removes
    what no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def save(self, df: DataFrame, *partition_by: str) -> DataFrame:
        """Write ``df`` and return it as read back; its folder is ``df.path_``."""
        path = scratch_path(self.spark, self.name)
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.path_ = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t.path_)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
