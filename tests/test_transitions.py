"""K2 with timers: the newest transitions equal the batch operator, trigger by trigger."""

import datetime as dt
import random

from quayside.operators.commits import commit_numbers
from quayside.operators.telemetry import liveness
from quayside.streaming.liveness import HEARTBEAT_SCHEMA
from quayside.streaming.transitions import device_states, read_transitions, start_transitions

T0 = dt.datetime(2024, 1, 1)


def states(df):
    return sorted((r["device_id"], r["last_seen"], r["online"], r["status"], r["current_job"]) for r in df.collect())


def test_equals_liveness_over_triggers_with_late_beats(spark, tmp):
    rng = random.Random(7)
    seen, clock = [], 0
    for trigger in range(4):
        rows = []
        for _ in range(60):
            clock += rng.randrange(0, 9)
            at = clock - rng.choice([0, 0, 0, rng.randrange(0, 900)])  # some come late, by far more than the TTL
            rows.append((f"d{rng.randrange(25)}", rng.choice(["RUNNING", "IDLE", None]), rng.choice(["SCCT", None]), T0 + dt.timedelta(seconds=at)))
        rows.append((f"late{trigger}", "RUNNING", "x", T0 + dt.timedelta(seconds=trigger)))
        rows += [(None, "RUNNING", None, T0), ("no instant", "IDLE", None, None)]
        df = spark.createDataFrame(rows, HEARTBEAT_SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{tmp}/in")
        seen += rows
        start_transitions(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ckpt", max_files_per_trigger=1).awaitTermination()
        known = spark.createDataFrame([r for r in seen if r[0] and r[3]], HEARTBEAT_SCHEMA)
        assert states(device_states(read_transitions(spark, f"{tmp}/out"))) == states(liveness(known)), trigger
    moves = read_transitions(spark, f"{tmp}/out").collect()
    assert {m["status"] for m in moves if not m["online"]} == {"OFFLINE"} and len(moves) > 30
    assert len(commit_numbers(spark, f"{tmp}/out")) >= 4


def test_nothing_seen(spark, tmp):
    assert device_states(read_transitions(spark, f"{tmp}/none")).collect() == []
