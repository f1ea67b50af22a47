"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Every source is a queue of its documents in a shuffled order that depends on
doc_id alone, read twice (two passes). A document that ends at position p of its
queue has the virtual finish time p / target. The schedule is all documents and
passes of all sources, range-sorted by finish time, and is cut where their words
reach the budget, the sum of the targets: what finishes before is taken whole, the
one document that straddles the cut gives the words that are left, the rest nothing.
All queues reach their targets at virtual time 1, so each source is cut within a
document of its target.

A queue's running sum is built from sums of hash buckets, so that a source that
holds most of all rows is spread over ``BUCKETS`` groups: a window over bucket
sums per source gives each bucket its offset, a window inside each bucket the
rest. The sorted schedule is written without texts; sums of its ranges find the
range with the cut, a window inside that range the cut itself, one row. Targets come
from one row per source: the only single-task step, as long as the list of sources.

Defined results: a NULL or empty text has size 0 and gives nothing; NULL is a
source of its own, last in order; equal rows of one doc_id are queued one after
the other; a table without words has targets 0; an empty table gives an empty
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import WORD, Scratch

WEIGHTS = (5, 2, 1)
PASSES = 2
#: Hash buckets of a source's queue: the first hexadecimal digits of the order key.
BUCKET_DIGITS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS) -> DataFrame:
    """(__skey, source_size, weight, target) from (__skey, size): shares by weight of 150 % of all
    sizes, none above twice its source's size, the excess reshared by weight.

    Sources in order of the level at which they are full: the water level is found at the first
    that is not full when those before it are. Whole numbers until one last division.
    """
    per = sizes.groupBy("__skey").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(Window.orderBy("__skey")) - 1) % len(weights) + 1)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "__skey")
    per = per.withColumn("weight", weight.cast("bigint")).withColumns({
        "_total": F.sum("source_size").over(Window.partitionBy()),
        "_full": F.coalesce(F.sum(F.lit(PASSES) * F.col("source_size")).over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_weights": F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))})
    per = per.withColumns({"_left": F.col("_total") * 3 - F.col("_full") * 2,
                           "_open": F.col("source_size") * F.col("_weights") * (2 * PASSES) >= F.col("weight") * (F.col("_total") * 3 - F.col("_full") * 2)})
    level = F.max(F.when(F.col("_open"), F.struct(F.col("_weights"), F.col("_left")))).over(Window.partitionBy())
    per = per.withColumn("_at", level).withColumns({"_w": F.col("_at._weights"), "_l": F.col("_at._left")})
    share = (F.col("weight") * F.col("_l")).cast("double") / (F.col("_w") * 2).cast("double")
    return per.select(
        "__skey", "source_size", "weight",
        F.least((F.lit(PASSES) * F.col("source_size")).cast("double"), share).alias("target"))


def _queue(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and ``__start``, their place in the queue of their source."""
    inside = Window.partitionBy("__skey", "__bucket").orderBy("__order", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("__inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(offsets, ["__skey", "__bucket"]).withColumn("__start", F.col("__offset") + F.col("__inside")))


def _finish(i: int):
    """Virtual finish time of the document in pass ``i``."""
    return F.try_divide((F.col("__start") + F.col("size") + F.col("source_size") * i).cast("double"), F.col("target"))


def _cut(queued: DataFrame, scratch: Scratch):
    """The place in the schedule where the budget ends, as (finish, order, pass, source, words left
    there); None if it never does."""
    order = ["finish", "__order", "pass", "__skey"]
    passes = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("pass"), _finish(i).alias("finish")) for i in range(PASSES)]))
    packets = queued.where("size > 0").select("__order", "__skey", "size", passes.alias("p")).select("p.finish", "__order", "p.pass", "__skey", "size")
    ranged = packets.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    ranged = scratch.save(ranged)
    budget = F.floor(F.sum("size").over(Window.partitionBy()) * 3 / (2 * PASSES))  # 150 % of all words; each stands here PASSES times
    parts = ranged.groupBy("part").agg(F.sum("size").alias("size"))
    ends = F.sum("size").over(Window.orderBy("part"))
    found = parts.select("part", "size", ends.alias("end"), budget.cast("bigint").alias("budget")).where("end >= budget").orderBy("part").head()
    if found is None:
        return None
    left = found["budget"] - (found["end"] - found["size"])
    inside = F.sum("size").over(Window.orderBy(*order))
    at = ranged.where(F.col("part") == found["part"]).withColumn("end", inside).where(F.col("end") >= left).orderBy("end").head()
    scratch.drop(ranged)
    return at["finish"], at["__order"], at["pass"], at["__skey"], left - (at["end"] - at["size"])


def fair_queue(docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """``docs`` with size, source_size, target, taken and ``packets``: one struct per pass
    (pass, finish, words), the document's virtual finish time and the words taken."""
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "packets")]
    rows = docs.select(*own, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
                       F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source")).alias("__skey"),
                       F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("__order"))
    rows = rows.withColumn("__bucket", F.substring("__order", 1, BUCKET_DIGITS))
    # written once: targets, offsets and the schedule read it, and the texts are counted no third time
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.save(rows.select("__skey", "__bucket", "__order", "size"))
    sums = scratch.save(sizes.groupBy("__skey", "__bucket").agg(F.sum("size").alias("size")))
    before = Window.partitionBy("__skey").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__skey", "__bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("__offset"))
    offsets = offsets.join(source_targets(sums, weights), "__skey")
    cut = _cut(_queue(sizes, offsets), scratch)

    def packet(i):
        if cut is None:
            words = F.col("size")
        else:
            place = F.struct(_finish(i).alias("a"), F.col("__order").alias("b"), F.lit(i + 1).alias("c"), F.col("__skey").alias("d"))
            end = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcd", cut[:4], strict=True)])
            words = F.when(F.col("size") == 0, 0).when(place < end, F.col("size")).when(place == end, F.lit(cut[4])).otherwise(0)
        return F.struct(F.lit(i + 1).alias("pass"), _finish(i).alias("finish"), words.cast("bigint").alias("words"))

    queued = _queue(rows, offsets).withColumn("packets", F.array(*[packet(i) for i in range(PASSES)]))
    return queued.select(*own, "size", "source_size", "target",
                         F.aggregate("packets", F.lit(0).cast("bigint"), lambda a, p: a + p["words"]).alias("taken"), "packets")


def schedule(docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """The mix itself: one row per document and pass that gives words, range-sorted by virtual finish time."""
    queued = fair_queue(docs, weights)
    own = [c for c in queued.columns if c != "packets"]
    return (queued.select(*own, F.explode("packets").alias("__p")).where("__p.words > 0")
            .select(*own, F.col("__p.pass").alias("pass"), F.col("__p.finish").alias("finish"), F.col("__p.words").alias("words"))
            .orderBy("finish", "doc_id", "pass"))
