"""Choosing files: C1 candidates, C2 latest by stamp, C3/C4 day scan,
C5 latest by modification time, D4 found count, D6 old outputs, E4/G3
expected x found.

"Latest per feed" is an aggregate, not a window: feeds are few and a feed may
own most of the files, so a partial ``min(struct)`` per task keeps the
shuffle at (#tasks x #feeds) rows. Ties go to the smallest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from quayside.functions.scalars import display_mtime, display_stamp, file_stamp, ntz_micros, size_mb_label
from quayside.sources.feeds import FEEDS, Feed, expected


def time_micros(df: DataFrame, col: str) -> F.Column:
    """Ordering key of a time column by its type: instants by their epoch
    micros, zone-less times by their wall clock read as UTC (never bent by the
    session zone), dates by their day."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(F.col(col))
    if isinstance(dtype, T.DateType):
        return F.unix_date(F.col(col)).cast("bigint") * F.lit(86_400_000_000)
    return F.unix_micros(F.col(col).cast("timestamp"))


def stamp_files(catalog: DataFrame, profiles: list[Feed] | None = None) -> DataFrame:
    """Adds ``feed`` and ``stamp`` to every file; both NULL when the
    name is not ``prefix + stamp + .csv`` (any case) with a real stamp.
    Prefixes do not overlap, so at most one profile matches a name."""
    table = profiles or FEEDS
    feed = None
    stamp = None
    for f in table:
        # a plain prefix test gates the regex and the date parse
        hit = F.upper(F.substring(F.col("name"), 1, len(f.prefix))) == F.lit(f.prefix.upper())
        st = F.when(hit, file_stamp("name", f.prefix, f.stamp_digits, f.stamp_format))
        feed = F.when(st.isNotNull(), F.lit(f.key)) if feed is None else feed.when(st.isNotNull(), F.lit(f.key))
        stamp = st if stamp is None else F.coalesce(stamp, st)
    return catalog.withColumn("feed", feed).withColumn("stamp", stamp)


def candidates(catalog: DataFrame, profiles: list[Feed] | None = None) -> DataFrame:
    """Only the files that are candidates of a feed."""
    return stamp_files(catalog, profiles).filter(F.col("stamp").isNotNull())


def latest_by_stamp(cands: DataFrame) -> DataFrame:
    """Newest stamp per feed; ties -> smallest path."""
    best = cands.groupBy("feed").agg(
        F.min(F.struct((-time_micros(cands, "stamp")).alias("k"), "path", "name", "size", "mtime", "stamp")).alias("b")
    )
    return best.select("feed", "b.path", "b.name", "b.size", "b.mtime", "b.stamp")


def require_latest(latest: DataFrame, feed_keys: list[str]) -> DataFrame:
    """C2 strictness: a feed with no candidate is an error (checked on the
    per-feed result, at most one row per feed)."""
    found = {r["feed"] for r in latest.select("feed").collect()}
    missing = [k for k in feed_keys if k not in found]
    if missing:
        raise FileNotFoundError(f"no file in the expected format for: {', '.join(missing)}")
    return latest


def output_feed(name_col: str = "name", profiles: list[Feed] | None = None, ext: str = ".parquet") -> F.Column:
    """Feed of an output file: its name starts with the feed prefix."""
    table = profiles or FEEDS
    expr = None
    for f in table:
        cond = F.col(name_col).startswith(f.prefix) & F.col(name_col).endswith(ext)
        expr = F.when(cond, F.lit(f.key)) if expr is None else expr.when(cond, F.lit(f.key))
    return expr


def latest_by_mtime(catalog: DataFrame, profiles: list[Feed] | None = None, ext: str = ".parquet") -> DataFrame:
    """Newest output file per feed by modification time (ties: smallest path)."""
    tagged = catalog.withColumn("feed", output_feed("name", profiles, ext)).filter(F.col("feed").isNotNull())
    best = tagged.groupBy("feed").agg(
        F.min(F.struct((-time_micros(tagged, "mtime")).alias("k"), "path", "name", "size", "mtime")).alias("b")
    )
    return best.select("feed", "b.path", "b.name", "b.size", "b.mtime")


def old_output_count(catalog: DataFrame, profiles: list[Feed] | None = None, ext: str = ".parquet") -> DataFrame:
    """Outputs per feed that a replace would remove."""
    tagged = catalog.withColumn("feed", output_feed("name", profiles, ext)).filter(F.col("feed").isNotNull())
    return tagged.groupBy("feed").agg(F.count(F.lit(1)).alias("old_outputs"))


def day_scan(spark: SparkSession, catalog: DataFrame, days: DataFrame, day_col: str = "day",
             profiles: list[Feed] | None = None) -> DataFrame:
    """For every (day, feed), the newest file by modification time
    among ``prefix + yyyyMMdd*.csv`` (date-only feeds: exactly
    ``prefix + yyyyMMdd.csv``), or a ``missing`` placeholder row.

    The per-(day, feed) winner is a partial aggregate keyed by (feed, day);
    the expected pairs are then left-outer joined to it on equality keys.
    """
    exp = expected(spark, days, day_col, profiles)
    table = profiles or FEEDS
    # A name belongs to (feed, day) when it starts with prefix + 8 digits of a day.
    feed_col = None
    day_text = None
    for f in table:
        starts = F.col("name").startswith(f.prefix)
        m = starts & F.col("name").rlike(f"^\\Q{f.prefix}\\E[0-9]{{8}}.*\\.csv$")
        if f.stamp_digits == 8:
            m = starts & F.col("name").rlike(f"^\\Q{f.prefix}\\E[0-9]{{8}}\\.csv$")
        d = F.substring(F.col("name"), len(f.prefix) + 1, 8)
        feed_col = F.when(m, F.lit(f.key)) if feed_col is None else feed_col.when(m, F.lit(f.key))
        day_text = F.when(m, d) if day_text is None else day_text.when(m, d)
    found = (
        catalog.withColumn("feed", feed_col)
        .withColumn("day", F.try_to_date(day_text, "yyyyMMdd"))
        .filter(F.col("day").isNotNull())
        .groupBy("feed", "day")
        .agg(F.min(F.struct((-time_micros(catalog, "mtime")).alias("k"), "path", "name", "size", "mtime")).alias("b"))
    )
    j = exp.join(found, ["feed", "day"], "left_outer")
    hit = F.col("b").isNotNull()
    return j.select(
        "day", "feed",
        F.when(hit, F.col("b.name")).otherwise(F.concat(F.col("day_prefix"), F.lit("*.csv"))).alias("name"),
        F.when(hit, F.col("b.path")).otherwise(F.lit("")).alias("path"),
        F.when(hit, F.col("b.size")).otherwise(F.lit(0)).cast("bigint").alias("size"),
        F.when(hit, size_mb_label(F.col("b.size"))).otherwise(F.lit("-")).alias("size_label"),
        F.when(hit, display_mtime(F.col("b.mtime"))).otherwise(F.lit("-")).alias("date_modified"),
        F.when(hit, F.lit("pending")).otherwise(F.lit("missing")).alias("status"),
    )


def found_count(scan: DataFrame) -> DataFrame:
    """Found files per day."""
    return scan.groupBy("day").agg(F.count_if(F.col("status") != F.lit("missing")).alias("found_count"))


def missing_feeds(spark: SparkSession, catalog: DataFrame, days: DataFrame, day_col: str = "day",
                  profiles: list[Feed] | None = None) -> DataFrame:
    """Expected (day, feed) pairs without any file: the scan's placeholders."""
    return day_scan(spark, catalog, days, day_col, profiles).filter(F.col("status") == F.lit("missing")).select("day", "feed")


def published_outputs(spark: SparkSession, root: str) -> DataFrame:
    """The outputs of this engine below ``root`` as a catalogue: one row per feed folder and source
    file in it, named ``<stem>.parquet`` after that file, so that C5 and D6 read it like any other."""
    from quayside.sources.catalog import catalog

    files = catalog(spark, root).filter(F.col("path").rlike("/feed=[^/]+/[^/]*\\.parquet$"))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    times = files.groupBy(folder.alias("path")).agg(F.max("mtime").alias("mtime"), F.sum("size").alias("size"))
    parts = spark.read.option("recursiveFileLookup", "true").schema("_file string").parquet(root)
    rows = parts.select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("path"), "_file")
    stems = rows.filter(F.col("path").rlike("/feed=[^/]+$")).distinct().select(
        F.regexp_extract("path", "/feed=([^/]+)$", 0).alias("_k"),
        F.concat(F.regexp_replace(F.regexp_extract("_file", "[^/]*$", 0), r"(?i)\.csv$", ""), F.lit(".parquet")).alias("name"))
    return times.withColumn("_k", F.regexp_extract("path", "/feed=([^/]+)$", 0)).join(stems, "_k").select("path", "name", "size", "mtime")


def with_display(cands: DataFrame) -> DataFrame:
    """Stamp and modification time as displayed."""
    return cands.withColumn("stamp_display", display_stamp("stamp")).withColumn("mtime_display", display_mtime("mtime"))


def check_exists(spark: SparkSession, paths: list[str]) -> None:
    """Every path must exist (source folder, input, output, target)."""
    from quayside.sources.catalog import path_exists

    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"not found: {', '.join(missing)}")
