"""A8 feed dimension and B6 feed resolution.

The four feed profiles are fixed configuration. They are exposed as a small
literal DataFrame, as literal arrays expanded per row (no join), and as Python
records for driver-side planning decisions such as the delimiter of a parse or
the write options of a sink.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.scalars import format_time


@dataclass(frozen=True)
class Feed:
    key: str
    title: str
    prefix: str
    delimiter: str
    stamp_format: str  # Spark datetime pattern of the stamp in the file name
    stamp_digits: int
    all_string: bool
    has_header: bool
    row_group_bytes: int | None = None
    repair_dangling_quote: bool = True


# --- fixed values (must equal the reference's) -----------------------------
FEEDS: list[Feed] = [
    Feed("30D_SALES", "30D SALES", "30D_SALES_", ";", "yyyyMMddHHmmss", 14, True, False, 134217728),
    Feed("CLOSING_STOCK", "CLOSING STOCK", "CLOSING_STOCK_", ",", "yyyyMMddHHmmss", 14, False, False),
    Feed("STOCK_INTRANSIT", "STOCK INTRANSIT", "STOCK_INTRANSIT_", ";", "yyyyMMddHHmmss", 14, True, False, 134217728),
    Feed("SCCT", "SCCT", "SCCT_RAWDATA_LD_WMP_", ",", "yyyyMMdd", 8, True, True),
]
# ---------------------------------------------------------------------------

FEED_BY_KEY = {f.key: f for f in FEEDS}

FEED_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("prefix", T.StringType(), False),
    T.StructField("delimiter", T.StringType(), False),
    T.StructField("stamp_format", T.StringType(), False),
    T.StructField("stamp_digits", T.IntegerType(), False),
    T.StructField("all_string", T.BooleanType(), False),
    T.StructField("has_header", T.BooleanType(), False),
    T.StructField("row_group_bytes", T.LongType(), True),
    T.StructField("repair_dangling_quote", T.BooleanType(), False),
])


def feeds(spark: SparkSession, profiles: list[Feed] | None = None) -> DataFrame:
    """The feed dimension as a DataFrame."""
    rows = [
        (f.key, f.title, f.prefix, f.delimiter, f.stamp_format, f.stamp_digits, f.all_string,
         f.has_header, f.row_group_bytes, f.repair_dangling_quote)
        for f in (profiles or FEEDS)
    ]
    return spark.createDataFrame(rows, FEED_SCHEMA)


def expected(spark: SparkSession, days: DataFrame, day_col: str = "day",
             profiles: list[Feed] | None = None) -> DataFrame:
    """The (feed, day) pairs expected for each day of ``days``, with the
    name prefix a landed file of that day carries (``prefix + yyyyMMdd``).
    The fixed profiles are generated per day with ``explode`` (no join)."""
    table = profiles or FEEDS
    dim = F.array(*[F.struct(F.lit(f.key).alias("key"), F.lit(f.prefix).alias("prefix"),
                             F.lit(f.stamp_digits == 8).alias("date_only")) for f in table])
    per_day = days.select(F.col(day_col).cast("date").alias("day")).distinct()
    return per_day.select("day", F.explode(dim).alias("f")).select(
        F.col("f.key").alias("feed"),
        "day",
        F.concat(F.col("f.prefix"), format_time(F.col("day"), "yyyyMMdd")).alias("day_prefix"),
        F.col("f.date_only").alias("date_only"),
    )


# B6 as data: rules in order of precedence, each (kind, text, feed key). A feed's key or bare prefix
# names it exactly, a file name starts with its prefix; every key is tried before any prefix.
def feed_rules(profiles: list[Feed] | None = None) -> list[tuple[str, str, str]]:
    table = profiles or FEEDS
    by_prefix = [(kind, text, f.key) for f in table for kind, text in (("is", f.prefix.rstrip("_")), ("starts", f.prefix))]
    return [("is", f.key, f.key) for f in table] + by_prefix


def resolve_feed(name: Column | str, profiles: list[Feed] | None = None) -> Column:
    """B6/E5 as one column expression: the first rule that holds; NULL when none does
    (``raise_error`` it for strict use).

    The attachment of a name to the (constant) feed dimension is a CASE, which
    is what a broadcast nested-loop join with ``startswith`` on a 4-row table
    reduces to, without the join.
    """
    col = F.col(name) if isinstance(name, str) else name
    n = F.upper(F.regexp_replace(col, r"(?U)^\s+|\s+$", ""))
    hits = [F.when(n == F.lit(text) if kind == "is" else n.startswith(text), F.lit(key)) for kind, text, key in feed_rules(profiles)]
    return F.coalesce(*hits)


def resolve_feed_name(value: str | None, profiles: list[Feed] | None = None) -> Feed:
    """B6 for one name on the driver (used to plan a single conversion): the same rules."""
    name = (value or "").strip().upper()
    if not name:
        raise ValueError("missing feed type")
    holds = {"is": name.__eq__, "starts": name.startswith}
    key = next((key for kind, text, key in feed_rules(profiles) if holds[kind](text)), None)
    if key is None:
        raise ValueError(f"unsupported feed type: {value}")
    return {f.key: f for f in profiles or FEEDS}[key]


def resolve_feed_strict(name: Column | str, profiles: list[Feed] | None = None) -> Column:
    col = F.col(name) if isinstance(name, str) else name
    resolved = resolve_feed(col, profiles)
    return (
        F.when(F.coalesce(F.trim(col), F.lit("")) == F.lit(""), F.raise_error(F.lit("missing feed type")))
        .when(resolved.isNull(), F.raise_error(F.concat(F.lit("unsupported feed type: "), col)))
        .otherwise(resolved)
    )
