"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

A store of seen lines is a list of levels, each a list of *runs*: tables of
``(k1, k2, owner)`` sorted by the 128-bit line hash, with no key in two runs. A
batch of documents is reduced to its distinct hashes, merge-joined with the
runs, and the hashes found in none of them become a new run of level 0. When a
level holds ``fanout`` runs they are merged into one run of the next level, so
each hash is rewritten once per level.

Batches are ranges of doc_id in ascending order, so the document that first
brings a key, its *owner*, is the smallest id that holds it. A key lies in many
documents without harm: its rows are combined per task before the shuffle, and
the join that carries the decision back is a sort-merge join between the line
rows and one row per key, which adaptive execution may split.

Defined results: a NULL or empty text is one empty line; a NULL doc_id is one
document that comes after all others; rows that repeat a doc_id are the same
document, each row keeping its own text; an empty table gives an empty table.
Other columns are carried or ignored by name, never matched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import LAST_ID, SPACE_CHARS, Scratch, ascii_lower

MIN_KEY_CHARS = 10
BATCHES = 4
FANOUT = 2

_RUN = "k1 bigint, k2 bigint, owner bigint"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


class SortedRuns:
    """The levelled store of line hashes."""

    def __init__(self, spark: SparkSession, scratch: Scratch, fanout: int = FANOUT):
        self.spark, self.scratch, self.fanout = spark, scratch, fanout
        self.levels: list[list[DataFrame]] = []

    def all(self) -> DataFrame:
        runs = [r for level in self.levels for r in level]
        out = runs[0] if runs else self.spark.createDataFrame([], _RUN)
        for r in runs[1:]:
            out = out.unionAll(r)
        return out

    def _sorted(self, rows: DataFrame) -> DataFrame:
        return rows.select("k1", "k2", "owner").repartition("k1", "k2").sortWithinPartitions("k1", "k2")

    def add(self, fresh: DataFrame) -> None:
        """Add a run of keys that no run holds, then compact full levels."""
        run, level = self.scratch.save(self._sorted(fresh)), 0
        while True:
            if len(self.levels) == level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            full, self.levels[level] = self.levels[level], []
            merged = full[0]
            for r in full[1:]:
                merged = merged.unionAll(r)
            run = self.scratch.save(self._sorted(merged))
            self.scratch.drop(*full)
            level += 1

    def probe(self, keys: DataFrame) -> DataFrame:
        """``keys`` (k1, k2, first, last) with the owner: the run's, else the batch's first."""
        runs = self.all().withColumnRenamed("owner", "held_by").hint("merge")
        return keys.join(runs, ["k1", "k2"], "left").select(
            "k1", "k2", "last", F.coalesce("held_by", "first").alias("owner"), F.col("held_by").isNull().alias("fresh"))


def _bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ids that part the documents into ``batches`` ranges; where they lie changes no result."""
    cuts = docs.select(F.percentile_approx("__did", [i / batches for i in range(1, batches)], 1000)).head()[0]
    return sorted(set(cuts or []))


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT,
                min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """``docs`` with its repeated lines removed from all but the smallest doc_id.

    Returns the columns of ``docs``, ``text`` replaced, plus ``n_lines`` (before)
    and ``n_dropped``.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "line-dedup")
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    docs = docs.select(*own, "text").withColumns({
        "__did": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)),
        "__row": F.xxhash64(F.coalesce("text", F.lit("")))})
    bounds = _bounds(docs, batches)
    batch = F.lit(0)
    for b in bounds:
        batch = batch + (F.col("__did") > b).cast("int")

    lines = (docs.select("__did", "__row", batch.alias("batch"),
                         F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("idx", "line"))
             .select("__did", "__row", "batch", "idx", line_key(F.col("line")).alias("key"))
             .where(F.length("key") >= min_chars)
             .select("__did", "__row", "idx", F.xxhash64("key").alias("k1"),
                     F.xxhash64(F.lit("second"), "key").alias("k2"), "batch"))
    lines = scratch.save(lines, "batch")

    runs, drops = SortedRuns(spark, scratch, fanout), None
    for b in range(len(bounds) + 1):
        mine = lines.where(F.col("batch") == b)
        keys = mine.groupBy("k1", "k2").agg(F.min("__did").alias("first"), F.max("__did").alias("last"))
        probed = scratch.save(runs.probe(keys))
        late = probed.where("owner < last").select("k1", "k2", "owner").hint("merge")
        part = mine.join(late, ["k1", "k2"]).where("__did > owner").select("__did", "__row", "idx")
        drops = part if drops is None else drops.unionAll(part)
        runs.add(probed.where("fresh"))
    drops = drops.distinct().groupBy("__did", "__row").agg(F.collect_list("idx").alias("__drop"))

    out = docs.join(drops, ["__did", "__row"], "left").withColumn("__lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    n = F.size("__lines")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), "__drop"), lambda i: F.get("__lines", i))
    return out.select(*own, F.when(F.col("__drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
                      n.cast("bigint").alias("n_lines"),
                      F.coalesce(F.size("__drop"), F.lit(0)).cast("bigint").alias("n_dropped"))


def dedup_lines_stage(docs: DataFrame) -> DataFrame:
    """The columns of documents, ``text`` and ``n_chars`` as they are after dropping lines."""
    columns, clash = docs.columns, {c: f"__{c}" for c in ("n_lines", "n_dropped") if c in docs.columns}
    out = dedup_lines(docs.withColumnsRenamed(clash)).drop("n_lines", "n_dropped").withColumnsRenamed({v: k for k, v in clash.items()})
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("bigint"))
    return out.select(*columns)
