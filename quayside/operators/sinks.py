"""Sinks: F1 Parquet write, F2 replace one feed, F3 publish, F4 staged
write with clean-up, F5 canonical CSV text.

A feed's folder is replaced by moves: the new data is written beside the target
(``_staging``, which readers of the feed folders skip), the old folder is moved
aside, the new one moved in, the old one deleted. Readers between the two moves
find no folder; a failed move puts the old one back. Task retries after a lost
executor write to fresh attempt folders and never leak into the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.quoting import encode_csv
from quayside.session import remove
from quayside.sources.catalog import path_exists
from quayside.sources.feeds import FEED_BY_KEY

def _writer(df: DataFrame, row_group_bytes: int | None):
    w = df.write.option("compression", "snappy")
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes))
    return w


def staging_path(target_dir: str) -> str:
    """A fresh folder on the target's own file system, where a move is a rename."""
    import uuid

    parent, _, name = target_dir.rstrip("/").rpartition("/")
    return f"{parent}/_staging/{name}-{uuid.uuid4().hex[:12]}"


def write_staged(df: DataFrame, folder: str, row_group_bytes: int | None = None) -> None:
    """F1 into one folder (no partition columns, so no per-task sort): Snappy
    Parquet with the feed's row-group size. Used for staged outputs."""
    _writer(df, row_group_bytes).mode("overwrite").parquet(folder)


def write_feed(df: DataFrame, path: str, feed: str | None = None, stamp=None,
               partition_by: list[str] | None = None, row_group_bytes: int | None = None) -> None:
    """write ``df`` as Snappy Parquet under ``path``, partitioned by
    feed (and more keys if asked), replacing only the partitions written.

    One feed given as ``feed``: the data is written to a staged folder beside
    the target and moved into ``path/feed=<feed>`` afterwards
    (the same stage-then-rename a dynamic overwrite does at commit, without
    sorting every task's rows by a constant partition value). A frame that
    carries a ``feed`` column (several feeds) uses dynamic partition overwrite.
    The published table is partitioned by ``feed`` alone, so an older stamp of
    the same feed is replaced too; an archive can use ``["feed", "stamp"]``.
    """
    out = df
    if stamp is not None and "stamp" not in df.columns:
        out = out.withColumn("stamp", F.lit(stamp))
    parts = partition_by or ["feed"]
    if row_group_bytes is None and feed is not None and feed in FEED_BY_KEY:
        row_group_bytes = FEED_BY_KEY[feed].row_group_bytes
    if feed is not None and "feed" not in df.columns and parts == ["feed"]:
        target = f"{path.rstrip('/')}/feed={feed}"
        staged = staging_path(target)
        try:
            write_staged(out, staged, row_group_bytes)
            swap_in(out.sparkSession, staged, target)
        finally:
            remove(out.sparkSession, staged)
        return
    if feed is not None and "feed" not in df.columns:
        out = out.withColumn("feed", F.lit(feed))
    (
        _writer(out, row_group_bytes)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def replace_feed(spark: SparkSession, df: DataFrame, path: str, feed: str, **kw) -> None:
    """replace one feed's data, leave every other feed's untouched."""
    write_feed(df, path, feed=feed, **kw)


def publish(spark: SparkSession, staged: str, target: str, feeds: list[str], mode: str = "per_feed") -> list[str]:
    """copy the converted feeds to the serving location, replacing the
    same feeds only. Each feed folder is its own dataset (feeds have different
    schemas), read and written on its own.

    ``per_feed``: copy and swap feed by feed; a failure leaves earlier feeds
    published. ``all_or_nothing``: every staged feed must exist (G3), all are
    copied into staged folders first, and only then swapped in, so a failed
    copy publishes nothing. Two logs (ignored by readers of the feed folders)
    record each run: ``target/_publish_started`` a row per feed before the first
    swap, ``target/_publish`` one after each swap; ``unfinished`` is their
    difference, so a run that stopped midway shows.
    """
    if not path_exists(spark, staged):
        raise FileNotFoundError(f"staged output not found: {staged}")
    if not path_exists(spark, target):
        raise FileNotFoundError(f"publish target not reachable: {target}")
    missing = [f for f in feeds if not path_exists(spark, f"{staged}/feed={f}")]
    if missing:
        raise FileNotFoundError(f"staged output missing for: {', '.join(missing)}")
    if mode not in ("per_feed", "all_or_nothing"):
        raise ValueError(f"unknown publish mode: {mode}")
    import uuid

    target, run = target.rstrip("/"), uuid.uuid4().hex
    place = {f: f"{target}/feed={f}" for f in feeds}
    copies = {f: staging_path(place[f]) for f in feeds}

    def copy(f: str) -> None:
        write_staged(spark.read.parquet(f"{staged}/feed={f}"), copies[f], FEED_BY_KEY[f].row_group_bytes if f in FEED_BY_KEY else None)

    try:
        if mode == "all_or_nothing":
            for f in feeds:
                copy(f)
        _record(spark, f"{target}/_publish_started", run, mode, feeds)
        for f in feeds:
            if mode == "per_feed":
                copy(f)
            swap_in(spark, copies[f], place[f])
            _record(spark, f"{target}/_publish", run, mode, [f])
    finally:
        remove(spark, *copies.values())
    return feeds


def _record(spark: SparkSession, log: str, run: str, mode: str, feeds: list[str]) -> None:
    import datetime as dt

    at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = spark.createDataFrame([(run, f, mode, at) for f in feeds], "run string, feed string, mode string, published_at timestamp_ntz")
    rows.coalesce(1).write.mode("append").parquet(log)


def unfinished(spark: SparkSession, target: str) -> DataFrame:
    """Feeds of publish runs that were started and not done."""
    target = target.rstrip("/")
    started = spark.read.parquet(f"{target}/_publish_started").select("run", "feed", "published_at")
    if not path_exists(spark, f"{target}/_publish"):
        return started
    return started.join(spark.read.parquet(f"{target}/_publish").select("run", "feed"), ["run", "feed"], "left_anti")


def swap_in(spark: SparkSession, staged_dir: str, target_dir: str) -> None:
    """move a checked, staged folder into place: old aside, new in, old deleted; the old one
    is put back if the new one cannot be moved. Moves are metadata operations on one file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = (jvm.org.apache.hadoop.fs.Path(x) for x in (staged_dir, target_dir))
    fs = dst.getFileSystem(conf)
    if not fs.exists(src):
        raise FileNotFoundError(f"staged output not found: {staged_dir}")
    fs.mkdirs(dst.getParent())
    old = None
    if fs.exists(dst):
        old = jvm.org.apache.hadoop.fs.Path(staging_path(target_dir) + "-old")
        fs.mkdirs(old.getParent())
        if not fs.rename(dst, old):
            raise RuntimeError(f"could not move {target_dir} aside")
    try:
        moved = fs.rename(src, dst)
    except Exception:
        moved = False
    if not moved:
        if old is not None:
            fs.rename(old, dst)
        raise RuntimeError(f"could not move {staged_dir} to {target_dir}")
    if old is not None:
        fs.delete(old, True)


def write_canonical_csv(parsed: DataFrame, path: str, delim: str, n: int | None = None) -> None:
    """the normalised CSV (canonical quoting, LF line ends) as text files.
    With the field count ``n`` known (a strict table), each line is encoded
    from its cells without building the fields array."""
    if n is not None:
        from quayside.functions.quoting import encode_columns, field

        line = encode_columns([field(i) for i in range(n)], delim)
    else:
        line = encode_csv("fields", delim)
    parsed.select(line.alias("value")).write.mode("overwrite").text(path)
