"""Run logs, file states and device heartbeats as tables: J1-J6, D5, C10,
B11/B12 log views.

Tables (see FIXTURES.md): ``log(id, device, job, ts, message)``,
``file_event(job, file, status, progress, output, ts)``,
``command(id, command, job, created_at)``,
``heartbeat(device_id, status, current_job, last_seen)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.scalars import keyword_match, severity

# --- fixed values (must equal the reference's) -----------------------------
LOG_KEEP_LAST = 1000          # entries kept per (device, job)
LOG_TTL_SECONDS = 86400       # a key's log expires this long after its last write
DEVICE_TTL_SECONDS = 120      # a device reads OFFLINE this long after last_seen
RUNNABLE_STATUSES = ["pending", "stopped", "error"]
# ---------------------------------------------------------------------------

#: Parts of a key that are cut to their newest entries in tasks of their own.
SALTS = 32
#: Cells of a key's time histogram; each task sends at most so many rows a key.
TIME_CELLS = 1024


def retain_last(logs: DataFrame, keys: list[str], n: int = LOG_KEEP_LAST, ts: str = "ts", tiebreak: str = "id") -> DataFrame:
    """The newest ``n`` entries per key.

    A histogram of the instants of each key (``TIME_CELLS`` cells between its first and last; hash
    aggregates of fixed-width rows) gives the start of the cell that holds the ``n``-th newest entry.
    Older entries go by a filter, before anything is sorted: what is sorted is the newest ``n``
    entries of a key and the rest of one cell. Time cannot part the entries of one instant, so what is
    left is cut in ``SALTS`` parts of a key first. NULL instants are the oldest."""
    at = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-(1 << 62)))
    keyed = logs.withColumn("_at", at)
    span = keyed.groupBy(*keys).agg(F.min("_at").alias("_low"), F.max("_at").alias("_high"), F.count(F.lit(1)).alias("_n"))
    # a NULL key is a key: it is matched by a struct, which is never NULL
    of_key = F.struct(*keys)
    long = span.filter(F.col("_n") > n).select(of_key.alias("_key"), "_low", (F.col("_high") / TIME_CELLS - F.col("_low") / TIME_CELLS).alias("_step"))
    keyed = keyed.withColumn("_key", of_key)
    cell = F.when(F.col("_step") > 0, F.least(F.floor((F.col("_at") - F.col("_low")) / F.col("_step")), F.lit(TIME_CELLS))).otherwise(F.lit(0))
    placed = keyed.select("_key", "_at").join(long, "_key").select("_key", cell.alias("_cell"))
    counts = placed.groupBy("_key", "_cell").count()
    newer = Window.partitionBy("_key").orderBy(F.desc("_cell")).rowsBetween(Window.unboundedPreceding, -1)
    cut = (counts.withColumn("_newer", F.coalesce(F.sum("count").over(newer), F.lit(0))).filter(F.col("_newer") < n)
           .groupBy("_key").agg(F.min("_cell").alias("_cut")))
    bounds = long.join(cut, "_key")
    near = keyed.join(bounds, "_key", "left").filter(F.col("_cut").isNull() | (cell >= F.col("_cut")))
    newest = [F.col(ts).desc(), F.col(tiebreak).desc()]
    part = Window.partitionBy(*keys, "_salt").orderBy(*newest)
    near = near.select(*logs.columns, F.pmod(F.xxhash64(tiebreak), F.lit(SALTS)).alias("_salt"))
    near = near.withColumn("_rn", F.row_number().over(part)).filter(F.col("_rn") <= n).drop("_rn", "_salt")
    return near.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))).filter(F.col("_rn") <= n).drop("_rn")


def _with_asof(df: DataFrame, asof, ts: str) -> DataFrame:
    """Attach ``_asof``: a given instant, or the newest ``ts`` of ``df`` itself
    (a scalar subquery: computed once, no join)."""
    if asof is None:
        return df.withColumn("_asof", df.agg(F.max(ts)).scalar())
    return df.withColumn("_asof", asof if isinstance(asof, F.Column) else F.lit(asof))


def expire_keys(logs: DataFrame, keys: list[str], asof=None, ttl_seconds: int = LOG_TTL_SECONDS, ts: str = "ts") -> DataFrame:
    """A key's whole log is gone ``ttl`` seconds after its *last* write.
    Keeps the entries of keys whose newest ``ts`` is within ``ttl`` of ``asof``
    (default: the newest entry of the whole log)."""
    last = logs.groupBy(*keys).agg(F.max(ts).alias("_last"))
    if asof is None:
        # the newest entry of all is the newest of the keys: a scalar subquery that reuses their aggregate
        last = last.withColumn("_asof", last.agg(F.max("_last")).scalar())
    else:
        last = last.withColumn("_asof", asof if isinstance(asof, F.Column) else F.lit(asof))
    alive = last.filter(F.col("_last") >= F.col("_asof") - F.make_dt_interval(secs=F.lit(ttl_seconds))).select(*keys)
    return logs.join(alive, keys, "left_semi")


def _latest(rows: DataFrame, keys: list[str], ts: str, then: list[str]) -> DataFrame:
    """Per key the row with the newest ``ts``, ties by the largest ``then`` values. The instants are
    reduced first (a hash aggregate of numbers); only rows at their key's instant are compared."""
    last = rows.groupBy(*keys).agg(F.max(ts).alias("_last"))
    named = last.select(*[F.col(k).alias(f"_{k}") for k in keys], "_last")
    same = [rows[k].eqNullSafe(named[f"_{k}"]) for k in keys] + [rows[ts].eqNullSafe(named["_last"])]
    tied = rows.join(named, same, "left_semi").groupBy(*keys).agg(F.max(F.struct(ts, *then)).alias("s"))
    return tied.select(*keys, *[f"s.{c}" for c in (ts, *then)])


def latest_heartbeat(heartbeats: DataFrame) -> DataFrame:
    """Newest heartbeat per device (a chatty device still ships one row per task)."""
    if not heartbeats.isStreaming:
        return _latest(heartbeats, ["device_id"], "last_seen", ["status", "current_job"])
    latest = heartbeats.groupBy("device_id").agg(F.max(F.struct("last_seen", "status", "current_job")).alias("s"))
    return latest.select("device_id", "s.last_seen", "s.status", "s.current_job")


def apply_device_ttl(latest: DataFrame, asof=None, ttl_seconds: int = DEVICE_TTL_SECONDS) -> DataFrame:
    """J3 read side: OFFLINE with no current job ``ttl`` after ``last_seen``
    (``asof`` defaults to the newest heartbeat seen)."""
    j = _with_asof(latest, asof, "last_seen")
    online = F.col("last_seen") >= F.col("_asof") - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return j.select(
        "device_id", "last_seen", online.alias("online"),
        F.when(online, F.col("status")).otherwise(F.lit("OFFLINE")).alias("status"),
        F.when(online, F.col("current_job")).alias("current_job"),
    )


def liveness(heartbeats: DataFrame, asof=None, ttl_seconds: int = DEVICE_TTL_SECONDS) -> DataFrame:
    """Latest state per device; ``ttl`` after ``last_seen`` it reads
    OFFLINE with no current job."""
    return apply_device_ttl(latest_heartbeat(heartbeats), asof, ttl_seconds)


def fold_file_state(events: DataFrame, job_results: DataFrame | None = None) -> DataFrame:
    """Latest status/progress/output per (job, file) by (ts, then the
    larger status text for ties). A job has failed when one of its files is in
    ``error`` or ``job_results`` (job, failed) says so; then every file still
    ``converting`` in it becomes ``error``."""
    latest = _latest(events, ["job", "file"], "ts", ["status", "progress", "output"])
    failed = latest.groupBy("job").agg(F.bool_or(F.col("status") == F.lit("error")).alias("failed"))
    if job_results is not None:
        failed = failed.unionByName(job_results.select("job", "failed"))
    failed = failed.groupBy("job").agg(F.coalesce(F.bool_or("failed"), F.lit(False)).alias("_job_failed"))
    return latest.join(failed, "job").select(
        "job", "file",
        F.when(F.col("_job_failed") & (F.col("status") == F.lit("converting")), F.lit("error"))
        .otherwise(F.col("status")).alias("status"),
        "progress", "output", "ts",
    )


def job_rollup(file_state: DataFrame, selected_col: str | None = None) -> DataFrame:
    """Per job: running (any converting), success (no error), the first
    error file by time, files per status and the number selected."""
    aggs = [
        F.bool_or(F.col("status") == F.lit("converting")).alias("running"),
        (~F.bool_or(F.col("status") == F.lit("error"))).alias("success"),
        F.min_by(F.when(F.col("status") == F.lit("error"), F.col("file")),
                 F.when(F.col("status") == F.lit("error"), F.col("ts"))).alias("first_error_file"),
        F.count(F.lit(1)).alias("files"),
    ]
    for s in ["pending", "converting", "completed", "error", "stopped", "missing"]:
        aggs.append(F.count_if(F.col("status") == F.lit(s)).alias(f"n_{s}"))
    if selected_col:
        aggs.append(F.count_if(F.col(selected_col)).alias("n_selected"))
    return file_state.groupBy("job").agg(*aggs)


def runnable(file_state: DataFrame, selected_col: str = "selected") -> DataFrame:
    """Selected, not missing, and in a state a run may (re)start."""
    return file_state.filter(F.col(selected_col) & F.col("status").isin(*RUNNABLE_STATUSES))


def since_last_run(logs: DataFrame, commands: DataFrame, job_col: str = "job") -> DataFrame:
    """A RUN clears the job's log and a RUN_ALL every job's: keep entries at
    or after the latest of both; jobs never run keep everything."""
    runs = commands.filter(F.col("command") == F.lit("RUN")).groupBy(job_col).agg(F.max("created_at").alias("_started"))
    whole = commands.filter(F.col("command") == F.lit("RUN_ALL")).agg(F.max("created_at")).scalar()
    j = logs.join(runs, job_col, "left_outer").withColumn("_started", F.greatest("_started", whole))
    return j.filter(F.col("_started").isNull() | (F.col("ts") >= F.col("_started"))).drop("_started")


def log_view(logs: DataFrame, keyword: str | None = None, file: str | None = None, file_col: str = "file") -> DataFrame:
    """All entries or one file's, with severity, keyword-filtered."""
    out = logs if file is None else logs.filter(F.col(file_col) == F.lit(file))
    return out.filter(keyword_match("message", keyword)).withColumn("severity", severity("message"))
