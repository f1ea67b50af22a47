"""The corpus pipeline: five stages from raw documents to the training mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``.

1. language ID: learns from the labelled documents it is given (all but fold 2 of
   4, as the query does) and rejects documents without a language: NULL, empty
   or letterless text, or no language with ``MIN_SHARE`` of its words.
2. line dedup: repeated lines go from all but the smallest doc_id.
3. near-dedup: one document of each group of near copies stays.
4. decontamination: documents that contain a benchmark item go.
5. mixing: documents outside the mix go; the rest carry how many of their words
   the mix takes.

Language ID and decontamination are not expressible in SQL, so ``ORACLE_SQL`` is
None; the pipeline is tested on planted cases stage by stage, and its operators
each against brute force, SQL or held-out accuracy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import Scratch, table
from quayside.llm.decontam import decontaminate
from quayside.llm.langid import fold, identify, train
from quayside.llm.line_dedup import dedup_lines_stage
from quayside.llm.mixing import fair_queue
from quayside.llm.near_dup import one_of_each

#: Least share of a document's words that its main language has.
MIN_SHARE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(docs.where(fold(docs, 4) != 2).select("text", "lang"))
    found = identify(docs, model, prefix="__")
    return found.where((F.col("__lang_pred") != "und") & (F.col("__score") >= MIN_SHARE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines_stage(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fair_queue(docs).where("taken > 0").drop("packets")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a written table."""
    scratch, docs, old = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
        if old is not None:
            scratch.drop(old)
        old = docs
    return docs
