"""K2 streaming device liveness.

Heartbeats arrive as files; a streaming aggregate keeps the latest heartbeat
per device in the state store (one row per device, independent of how many
heartbeats a device sends). Each trigger writes the complete per-device table
(its size is the number of devices) with an overwrite, so a replayed batch is
idempotent. The TTL is applied when the table is read (``read_liveness``), so
the answer at any ``asof`` equals the batch operator J3 on the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.telemetry import DEVICE_TTL_SECONDS, apply_device_ttl, latest_heartbeat

HEARTBEAT_SCHEMA = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("current_job", T.StringType()),
    T.StructField("last_seen", T.TimestampType()),
])


def start_liveness(spark: SparkSession, landing: str, table: str, checkpoint: str, available_now: bool = True,
                   schema: T.StructType | None = None):
    """Start K2. ``schema`` defaults to the schema of the files already landed
    (a metadata read), else ``HEARTBEAT_SCHEMA``."""
    if schema is None:
        try:
            schema = spark.read.parquet(landing).schema
        except Exception:  # noqa: BLE001 - nothing landed yet
            schema = HEARTBEAT_SCHEMA
    beats = spark.readStream.schema(schema).parquet(landing)
    latest = latest_heartbeat(beats)

    def _batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(table)

    writer = latest.writeStream.outputMode("complete").foreachBatch(_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_liveness(spark: SparkSession, table: str, asof=None, ttl_seconds: int = DEVICE_TTL_SECONDS) -> DataFrame:
    """Device states at ``asof`` (default: the newest heartbeat in the table)."""
    return apply_device_ttl(spark.read.parquet(table), asof, ttl_seconds)
