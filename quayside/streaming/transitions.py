"""K2 with timers: device transitions from heartbeats, with OFFLINE found by event time.

Each device is a keyed state of one row: its newest heartbeat and whether it is offline. A
heartbeat newer than the state comes out as a transition and sets a timer; when the newest
instant of the whole stream is more than the TTL after it, the timer comes out as an OFFLINE
transition, also if nothing more is heard of that device. The watermark trails the newest instant by
``lateness``: heartbeats up to so late are still taken, and timers are set that much earlier, so
they run by the newest instant (to the millisecond) and not by the watermark.

Every trigger appends its transitions in a folder of its own and commits it
(``operators.commits``); readers meet whole triggers, and a replayed trigger is found by its commit.
The newest transition of each device is the answer that J3 gives for the heartbeats seen so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quayside.operators.commits import commit, commit_numbers, read_commit
from quayside.operators.telemetry import DEVICE_TTL_SECONDS
from quayside.streaming.liveness import HEARTBEAT_SCHEMA

LATENESS_SECONDS = 86400
_OUT = "device_id string, last_seen timestamp, status string, current_job string, online boolean"
# instants as microseconds: the same in any session zone
_MADE = "device_id string, at bigint, status string, current_job string, online boolean"
_STATE = "at bigint, status string, current_job string, online boolean"


def _step(ttl: int, lateness: int):
    def rank(at, status, job):
        """Newest first, then the larger texts, NULL the smallest (as the batch operator orders ties)."""
        return at, status is not None, status or "", job is not None, job or ""

    def timed(state: GroupState, beat: tuple) -> bool:
        """Keep ``beat`` with its timer; False where the device is offline already."""
        fires = beat[0] // 1000 + (ttl - lateness) * 1000
        online = fires > state.getCurrentWatermarkMs()
        state.update((*beat, online))
        if online:
            state.setTimeoutTimestamp(fires)
        return online

    def step(key: tuple, beats: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows, old = [], state.get[:3] if state.exists else None
        was_online = old is not None and state.get[3]
        best = old
        for batch in beats if not state.hasTimedOut else ():
            for r in batch.itertuples(index=False):
                beat = (int(r.at), r.status, r.current_job)
                best = beat if best is None or rank(*beat) > rank(*best) else best
        if state.hasTimedOut:
            state.update((*old, False))
            rows.append((key[0], old[0], "OFFLINE", None, False))
        elif best != old or was_online:  # a call without a new beat must set the timer again
            if best != old:
                rows.append((key[0], *best, True))
            if not timed(state, best):
                rows.append((key[0], best[0], "OFFLINE", None, False))
        yield pd.DataFrame(rows, columns=["device_id", "at", "status", "current_job", "online"])
    return step


def transitions(beats: DataFrame, ttl_seconds: int = DEVICE_TTL_SECONDS, lateness_seconds: int = LATENESS_SECONDS) -> DataFrame:
    """Streaming heartbeats -> streaming transitions (update mode). NULL devices and instants are left out."""
    known = beats.filter(F.col("device_id").isNotNull() & F.col("last_seen").isNotNull()).select(
        "device_id", F.col("last_seen").cast("timestamp").alias("last_seen"), "status", "current_job")
    known = known.withColumn("at", F.unix_micros("last_seen")).withWatermark("last_seen", f"{lateness_seconds} seconds")
    made = known.groupBy("device_id").applyInPandasWithState(
        _step(ttl_seconds, lateness_seconds), _MADE, _STATE, "update", GroupStateTimeout.EventTimeTimeout)
    return made.select("device_id", F.timestamp_micros("at").alias("last_seen"), "status", "current_job", "online")


def start_transitions(spark: SparkSession, landing: str, table: str, checkpoint: str, ttl_seconds: int = DEVICE_TTL_SECONDS,
                      lateness_seconds: int = LATENESS_SECONDS, max_files_per_trigger: int = 1000, available_now: bool = True,
                      schema: T.StructType = HEARTBEAT_SCHEMA):
    """Follow the heartbeat files of ``landing``; transitions are appended to ``table``."""
    beats = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing)

    def write(df: DataFrame, batch_id: int) -> None:
        if batch_id in commit_numbers(spark, table):
            return
        folder = f"batch={batch_id}"
        df.write.mode("overwrite").parquet(f"{table}/{folder}")
        commit(spark, table, batch_id, {"folder": folder})

    writer = (transitions(beats, ttl_seconds, lateness_seconds).writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def read_transitions(spark: SparkSession, table: str) -> DataFrame:
    """All transitions of committed triggers."""
    folders = [f"{table}/{read_commit(spark, table, n)['folder']}" for n in commit_numbers(spark, table)]
    return spark.read.schema(_OUT).parquet(*folders) if folders else spark.createDataFrame([], _OUT)


def device_states(transitions: DataFrame) -> DataFrame:
    """The newest transition of each device."""
    newest = F.max(F.struct("last_seen", (~F.col("online")).alias("offline"), "status", "current_job")).alias("s")
    return transitions.groupBy("device_id").agg(newest).select(
        "device_id", "s.last_seen", (~F.col("s.offline")).alias("online"), "s.status", "s.current_job")
