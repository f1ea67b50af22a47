"""D3: progress of conversions as a table.

A running conversion appends a row whenever another ``STEP`` rows are written, and one when it is
done or has failed. While it runs, rows are estimated: the share of the job's tasks that are finished (Spark's
status tracker) of the rows that the size of the text makes likely. The last row is exact. A row is
one small file, made under a name that readers skip and then moved: readers see whole rows.

An ingest needs no such log: its commits hold the rows of every micro-batch
(``streaming.ingest.ingest_progress``).
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.commits import LOG, commit
from quayside.sources.catalog import path_exists

# --- fixed values (must equal the reference's) -----------------------------
STEP = 100_000  # rows between two reports
# ---------------------------------------------------------------------------

#: Seconds between two looks at the status of a job.
EVERY = 0.5
_SCHEMA = "run string, feed string, seq bigint, state string, rows bigint, tasks_done bigint, tasks bigint, at timestamp"


class Progress:
    """Progress of one run of a feed, in ``root``."""

    def __init__(self, spark: SparkSession, root: str, feed: str, step: int = STEP):
        self.spark, self.feed, self.step = spark, feed, step
        self.run = uuid.uuid4().hex
        self.folder = f"{root.rstrip('/')}/feed={feed}/run={self.run}"
        self.seq, self.rows, self.tasks = 0, 0, (0, 0)

    def report(self, state: str, rows: int) -> None:
        self.seq, self.rows = self.seq + 1, rows
        commit(self.spark, self.folder, self.seq, {
            "run": self.run, "feed": self.feed, "seq": self.seq, "state": state, "rows": rows, "tasks_done": self.tasks[0],
            "tasks": self.tasks[1], "at": dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds")})

    def reached(self, rows: int) -> None:
        """Report ``rows`` if they pass another step."""
        if rows // self.step > self.rows // self.step:
            self.report("running", rows)

    def done(self, rows: int) -> None:
        self.report("done", rows)

    def failed(self) -> None:
        self.report("failed", self.rows)

    def _look(self, group: str, expected: int) -> None:
        tracker = self.spark.sparkContext.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
        stages = [s for s in stages if s]
        self.tasks = sum(s.numCompletedTasks for s in stages), sum(s.numTasks for s in stages)
        if self.tasks[1]:
            self.reached(expected * self.tasks[0] // self.tasks[1])

    @contextmanager
    def watch(self, expected: int) -> Iterator[None]:
        """Follow the jobs that the caller's thread starts inside; ``expected`` rows will be written.
        The caller's job group is put back."""
        sc, stop, group = self.spark.sparkContext, threading.Event(), f"progress-{self.run}"
        before = {k: sc.getLocalProperty(k) for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")}

        def follow() -> None:
            while not stop.wait(EVERY):
                self._look(group, expected)

        sc.setJobGroup(group, f"convert {self.feed}")
        follower = threading.Thread(target=follow, daemon=True)
        follower.start()
        try:
            yield
        finally:
            stop.set()
            follower.join()
            for key, value in before.items():
                sc.setLocalProperty(key, value)


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """All rows of all runs: ``DF[run, feed, seq, state, rows, tasks_done, tasks, at]``."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).json(f"{root.rstrip('/')}/feed=*/run=*/{LOG}/*.json")


def latest_progress(progress: DataFrame) -> DataFrame:
    """The last row of every run."""
    cols = [c for c in progress.columns if c != "run"]
    return progress.groupBy("run").agg(F.max_by(F.struct(*cols), "seq").alias("last")).select("run", "last.*")


def marks(totals: DataFrame, rows: str = "rows", step: int = STEP) -> DataFrame:
    """``totals`` with a row for every multiple of ``step`` that ``rows`` has passed, as ``mark``."""
    passed = F.when(F.col(rows) >= step, F.sequence(F.lit(step).cast("bigint"), F.col(rows), F.lit(step).cast("bigint")))
    return totals.withColumn("mark", F.explode(passed))
