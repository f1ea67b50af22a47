"""Checks of every operator on the driver's tables, each paired with the SQL
that states the same answer from the original columns (run by DuckDB).

Feeds are derived from the tables: lines are built with expressions (or landed
as text files in the shared scratch folder), the operator runs over the whole
table, and the SQL states the expected result from the source columns, so it
never re-implements the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.quoting import encode_columns, encode_csv, quote_all, split_fields
from quayside.functions.scalars import (
    compression_ratio, display_mtime, display_stamp, file_stamp, keyword_match, severity, size_label,
)
from quayside.operators import audit as A
from quayside.operators import selection as S
from quayside.operators import tables as TB
from quayside.operators import telemetry as TL
from quayside.operators.origin import ORIGIN, with_line_numbers
from quayside.operators.sinks import publish, write_feed
from quayside.plans.landing import land_buckets, land_ranges
from quayside.session import scratch_path
from quayside.sources.catalog import catalog, catalog_changes
from quayside.sources.feeds import FEED_BY_KEY, FEEDS, resolve_feed
from quayside.sources.lines import read_numbered_lines


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def money(c: str) -> F.Column:
    return F.format_string("%.2f", F.col(c))


def ts_text(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> F.Column:
    from quayside.functions.scalars import format_time

    return format_time(F.col(c) if isinstance(c, str) else c, fmt)


# ------------------------------------------------------------- B1 / B2 ---

@query("split_base", """
SELECT CAST(p_partkey AS VARCHAR) AS f_key, p_name || '";' || p_brand AS f_name, p_brand AS f_brand,
       p_type AS f_type, CAST(p_size AS VARCHAR) AS f_size, CAST(5 AS BIGINT) AS n_fields
FROM part""")
def q_split_base(spark, sf):
    p = t(spark, sf, "part")
    fields = F.array(s("p_partkey"), F.concat("p_name", F.lit('";'), "p_brand"), F.col("p_brand"), F.col("p_type"), s("p_size"))
    cells, n = split_fields(quote_all(fields, ";"), ";", False, 5)
    names = ["f_key", "f_name", "f_brand", "f_type", "f_size"]
    return p.select(*[c.alias(nm) for c, nm in zip(cells, names)], n.cast("bigint").alias("n_fields"))


@query("split_repair", """
SELECT p_partkey,
       CAST(p_size AS VARCHAR) || '"' AS r_size, p_brand AS r_brand, p_type AS r_type, CAST(3 AS BIGINT) AS r_n,
       CAST(p_size AS VARCHAR) || '";' || p_brand || ';"' || p_type AS b_field, CAST(1 AS BIGINT) AS b_n
FROM part""")
def q_split_repair(spark, sf):
    p = t(spark, sf, "part")
    line = F.concat(F.lit('"'), s("p_size"), F.lit('"";'), F.col("p_brand"), F.lit(';"'), F.col("p_type"), F.lit('"'))
    (r_size, r_brand, r_type), r_n = split_fields(line, ";", True, 3)
    (b_field,), b_n = split_fields(line, ";", False, 1)
    return p.select("p_partkey", r_size.alias("r_size"), r_brand.alias("r_brand"), r_type.alias("r_type"),
                    r_n.cast("bigint").alias("r_n"), b_field.alias("b_field"), b_n.cast("bigint").alias("b_n"))


@query("split_inner_quotes", """
SELECT CAST(page_id AS VARCHAR) AS f_id, translate(html, ';' || chr(10) || chr(13), '') AS f_html,
       translate(url, ';', '') AS f_url, CAST(3 AS BIGINT) AS n_fields,
       CAST(length(translate(html, ';' || chr(10) || chr(13), '')) - length(replace(translate(html, ';' || chr(10) || chr(13), ''), '"', '')) AS BIGINT) AS quotes
FROM pages""")
def q_split_inner_quotes(spark, sf):
    pg = t(spark, sf, "pages")
    line = F.concat_ws(";", s("page_id"), F.translate("html", ";\n\r", ""), F.translate("url", ";", ""))
    (f_id, f_html, f_url), n = split_fields(line, ";", False, 3)
    out = pg.select(f_id.alias("f_id"), f_html.alias("f_html"), f_url.alias("f_url"), n.cast("bigint").alias("n_fields"))
    return out.withColumn("quotes", (F.length("f_html") - F.length(F.replace("f_html", F.lit('"'), F.lit("")))).cast("bigint"))


@query("split_unclosed", """
SELECT CAST(o_orderkey AS VARCHAR) AS f_key, o_orderpriority || ';' || o_orderstatus AS f_rest,
       CAST(2 AS BIGINT) AS n_base, CAST(2 AS BIGINT) AS n_repair
FROM orders""")
def q_split_unclosed(spark, sf):
    o = t(spark, sf, "orders")
    line = F.concat(s("o_orderkey"), F.lit(';"'), F.col("o_orderpriority"), F.lit(";"), F.col("o_orderstatus"))
    (f_key, f_rest), n_base = split_fields(line, ";", False, 2)
    _, n_repair = split_fields(line, ";", True, 0)
    return o.select(f_key.alias("f_key"), f_rest.alias("f_rest"), n_base.cast("bigint").alias("n_base"),
                    n_repair.cast("bigint").alias("n_repair"))


# ------------------------------------------------------------------ B3 ---

_ENC = "CASE WHEN regexp_matches({f}, '[;\"\\r\\n]') THEN '\"' || replace({f}, '\"', '\"\"') || '\"' ELSE {f} END"


def _enc(f: str) -> str:
    return _ENC.format(f=f)


@query("encode_csv", f"""
SELECT l_orderkey, l_linenumber,
       CAST(l_orderkey AS VARCHAR) || ';' || CAST(l_linenumber AS VARCHAR) || ';' ||
       {_enc("(l_returnflag || '\"' || l_linestatus)")} || ';' || {_enc("(l_linestatus || ';' || l_returnflag)")} || ';' ||
       '' || ';' || printf('%.2f', l_extendedprice) AS line,
       CASE WHEN l_linenumber = 1 THEN '""' ELSE l_returnflag END AS solo
FROM lineitem""")
def q_encode_csv(spark, sf):
    li = t(spark, sf, "lineitem")
    fields = [s("l_orderkey"), s("l_linenumber"), F.concat("l_returnflag", F.lit('"'), "l_linestatus"),
              F.concat("l_linestatus", F.lit(";"), "l_returnflag"), F.lit(""), money("l_extendedprice")]
    solo = [F.when(F.col("l_linenumber") == 1, F.lit("")).otherwise(F.col("l_returnflag"))]
    return li.select("l_orderkey", "l_linenumber", encode_columns(fields, ";").alias("line"),
                     encode_columns(solo, ";").alias("solo"))


# ------------------------------------------------------ A5 + B3 + B1 + B4 ---

@query("roundtrip_table", """
SELECT CAST(o_orderkey AS VARCHAR) AS column1, CAST(o_custkey AS VARCHAR) AS column2,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus || '";x' END AS column3,
       printf('%.2f', o_totalprice) AS column4, strftime(o_orderdate, '%Y-%m-%d') AS column5, o_orderpriority AS column6
FROM orders""")
def q_roundtrip_table(spark, sf):
    o = t(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.concat("o_orderstatus", F.lit('";x')))
    fields = F.array(s("o_orderkey"), s("o_custkey"), status, money("o_totalprice"),
                     ts_text("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority"))
    lines = o.select(F.lit("orders").alias("file"), F.col("o_orderkey").alias("line_no"), encode_csv(fields, ";").alias("value"))
    parsed = TB.parse(lines, ";", repair=False)
    return TB.to_table_positional(parsed, 6)


@query("empty_to_null", """
SELECT CAST(p_partkey AS VARCHAR) AS column1, p_name AS column2,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS column3,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS column4
FROM part""")
def q_empty_to_null(spark, sf):
    p = t(spark, sf, "part")
    line = F.concat_ws(";", s("p_partkey"), F.col("p_name"),
                       F.when(F.col("p_partkey") % 7 == 0, F.lit("")).otherwise(F.col("p_type")),
                       F.when(F.col("p_partkey") % 11 == 0, F.lit('""')).otherwise(F.col("p_brand")))
    parsed = TB.parse(p.select(F.lit("part").alias("file"), F.col("p_partkey").alias("line_no"), line.alias("value")), ";")
    return TB.to_table_positional(parsed, 4)


# ---------------------------------------------------------- A1, A2, A3 ---

def _land_part(spark, sf) -> str:
    p = t(spark, sf, "part").withColumn("bucket", (F.col("p_partkey") / 500).cast("bigint"))
    p = p.withColumn("value", F.concat(F.lpad(s("p_partkey"), 8, "0"), F.lit(";"), F.col("p_name")))
    return land_buckets(spark, p, "value", "bucket", ["p_partkey"], "part-lines")


@query("line_numbers", """
SELECT p_partkey // 500 AS bucket, p_partkey AS key,
       row_number() OVER (PARTITION BY p_partkey // 500 ORDER BY p_partkey) AS line_no,
       lpad(CAST(p_partkey AS VARCHAR), 8, '0') || ';' || p_name AS value
FROM part""")
def q_line_numbers(spark, sf):
    root = _land_part(spark, sf)
    lines = read_numbered_lines(spark, root, recursive=True)
    return lines.select(
        F.regexp_extract("file", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket"),
        F.split("value", ";")[0].cast("bigint").alias("key"),
        F.col("line_no").cast("bigint").alias("line_no"), "value")


@query("catalog", """
SELECT p_partkey // 500 AS bucket, CAST(1 AS BIGINT) AS files,
       CAST(sum(strlen(lpad(CAST(p_partkey AS VARCHAR), 8, '0') || ';' || p_name) + 1) AS BIGINT) AS bytes,
       CAST(0 AS BIGINT) AS flat_files
FROM part GROUP BY 1""")
def q_catalog(spark, sf):
    root = _land_part(spark, sf)
    deep = catalog(spark, root, recursive=True)
    flat = catalog(spark, root, recursive=False).agg(F.count(F.lit(1)))
    per = deep.groupBy(F.regexp_extract("path", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").cast("bigint").alias("bytes"))
    return per.withColumn("flat_files", flat.scalar())


@query("catalog_changes", """
WITH f AS (SELECT p_partkey // 50 AS b, p_partkey, p_name FROM part),
v AS (SELECT b, sum(strlen(CAST(p_partkey AS VARCHAR) || ';' || p_name) + 1) AS size, count(*) AS n FROM f GROUP BY b)
SELECT 'part_' || CAST(b AS VARCHAR) || '.csv' AS name,
       CASE b % 4 WHEN 1 THEN 'gone' WHEN 2 THEN 'new' ELSE 'changed' END AS change,
       CAST(CASE WHEN b % 4 <> 2 THEN size END AS BIGINT) AS size_before,
       CAST(CASE b % 4 WHEN 2 THEN size WHEN 3 THEN size + n END AS BIGINT) AS size_after
FROM v WHERE b % 4 <> 0""")
def q_catalog_changes(spark, sf):
    """A1 twice, by flat listings of a folder in which files come, go and change; a file in a subfolder is not met."""
    from quayside.plans.landing import land_named_files
    from quayside.session import materialize, remove

    p = t(spark, sf, "part").withColumn("b", (F.col("p_partkey") / 50).cast("bigint"))
    kind = F.col("b") % 4  # 0 stays, 1 goes, 2 comes, 3 changes
    line = F.concat(s("p_partkey"), F.lit(";"), F.col("p_name"))
    name = lambda k: f"part_{k}.csv"
    root = land_named_files(spark, p.where(kind != 2).withColumn("value", line), "value", "b", ["p_partkey"], "files-before", name)
    before = materialize(catalog(spark, root, recursive=False), "catalog-before")
    listed = before.select("path", "name").collect()  # the files of the landing zone
    remove(spark, *[row["path"] for row in listed if int(row["name"][5:-4]) % 4 in (1, 3)])
    later = p.where(kind.isin(2, 3)).withColumn("value", F.when(kind == 3, F.concat(line, F.lit("+"))).otherwise(line))
    land_named_files(spark, later, "value", "b", ["p_partkey"], "files-after", name, root=root)
    land_named_files(spark, later, "value", "b", ["p_partkey"], "files-below", name, root=f"{root}/below")
    return catalog_changes(before, catalog(spark, root, recursive=False)).select("name", "change", "size_before", "size_after")


# ------------------------------------------------- B5, B6, C1-C5, D4, E4 ---

_MANIFEST_SQL = """
WITH base AS (
  SELECT o_orderkey, o_custkey, o_totalprice,
         o_orderkey % 4 AS fi,
         o_orderdate + to_seconds(CAST((o_custkey * 37) % 86400 AS BIGINT)) AS ts
  FROM orders),
d AS (
  SELECT *,
         CASE fi WHEN 0 THEN '30D_SALES_' WHEN 1 THEN 'CLOSING_STOCK_' WHEN 2 THEN 'STOCK_INTRANSIT_' ELSE 'SCCT_RAWDATA_LD_WMP_' END AS prefix,
         CASE WHEN fi = 3 THEN strftime(ts, '%Y%m%d') ELSE strftime(ts, '%Y%m%d%H%M%S') END AS digits
  FROM base),
m AS (
  SELECT o_orderkey, o_custkey, o_totalprice, fi, ts,
         (CASE WHEN o_orderkey % 29 = 10 THEN lower(prefix) ELSE prefix END) ||
         (CASE WHEN o_orderkey % 11 = 5 THEN substr(digits, 1, 4) || '13' || substr(digits, 7)
               WHEN o_orderkey % 23 = 9 THEN substr(digits, 1, 6) || '31' || substr(digits, 9)
               WHEN o_orderkey % 13 = 6 THEN substr(digits, 1, length(digits) - 1)
               ELSE digits END) ||
         (CASE WHEN o_orderkey % 17 = 7 THEN '_bak.csv' WHEN o_orderkey % 19 = 8 THEN '.CSV' ELSE '.csv' END) AS name
  FROM d),
manifest AS (
  SELECT '/land/b' || CAST(o_orderkey % 5 AS VARCHAR) || '/' || name AS path, name,
         CAST(floor(o_totalprice) AS BIGINT) AS size,
         ts + to_minutes(CAST(o_orderkey % 1000 AS BIGINT)) AS mtime, fi, ts
  FROM m)"""


_MANIFESTS: dict[tuple[int, str], str] = {}


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """A landing-zone listing (path, name, size, mtime) derived from orders:
    feed by key, stamp from the order date, and broken names (month 13,
    day 31, a digit short, lower-case prefix, ``_bak``, upper-case ``.CSV``).

    Written once per session to the shared scratch folder and read back, as a
    real catalogue listing is a table: the derived names are then plain
    columns for the operators instead of an expression inlined everywhere."""
    key = (id(spark), sf)
    if key not in _MANIFESTS:
        path = scratch_path(spark, "manifest")
        _manifest_rows(spark, sf).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
        _MANIFESTS[key] = path
    return spark.read.parquet(_MANIFESTS[key])


def _manifest_rows(spark: SparkSession, sf: str) -> DataFrame:
    o = t(spark, sf, "orders")
    ts = F.col("o_orderdate") + F.make_dt_interval(secs=((F.col("o_custkey") * 37) % 86400).cast("bigint"))
    prefixes = [f.prefix for f in FEEDS]
    fi = F.col("o_orderkey") % 4
    prefix = F.when(fi == 0, prefixes[0]).when(fi == 1, prefixes[1]).when(fi == 2, prefixes[2]).otherwise(prefixes[3])
    d = o.select("o_orderkey", "o_custkey", "o_totalprice", fi.alias("fi"), ts.alias("ts"), prefix.alias("prefix"))
    digits = F.when(F.col("fi") == 3, ts_text("ts", "yyyyMMdd")).otherwise(ts_text("ts", "yyyyMMddHHmmss"))
    d = d.withColumn("digits", digits)
    k = F.col("o_orderkey")
    dg = F.col("digits")
    broken = (F.when(k % 11 == 5, F.concat(F.substring(dg, 1, 4), F.lit("13"), F.expr("substr(digits, 7)")))
              .when(k % 23 == 9, F.concat(F.substring(dg, 1, 6), F.lit("31"), F.expr("substr(digits, 9)")))
              .when(k % 13 == 6, F.expr("substr(digits, 1, length(digits) - 1)"))
              .otherwise(dg))
    suffix = F.when(k % 17 == 7, "_bak.csv").when(k % 19 == 8, ".CSV").otherwise(".csv")
    name = F.concat(F.when(k % 29 == 10, F.lower("prefix")).otherwise(F.col("prefix")), broken, suffix)
    m = d.select("o_orderkey", "o_totalprice", "fi", "ts", name.alias("name"))
    return m.select(
        F.concat(F.lit("/land/b"), s(F.col("o_orderkey") % 5), F.lit("/"), "name").alias("path"), "name",
        F.floor("o_totalprice").cast("bigint").alias("size"),
        (F.col("ts") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1000).cast("int"))).alias("mtime"),
        "fi", "ts",
    )


_STAMP_SQL = """
  CASE WHEN regexp_full_match(name, '(?i)30D_SALES_[0-9]{14}\\.csv') THEN '30D_SALES'
       WHEN regexp_full_match(name, '(?i)CLOSING_STOCK_[0-9]{14}\\.csv') THEN 'CLOSING_STOCK'
       WHEN regexp_full_match(name, '(?i)STOCK_INTRANSIT_[0-9]{14}\\.csv') THEN 'STOCK_INTRANSIT'
       WHEN regexp_full_match(name, '(?i)SCCT_RAWDATA_LD_WMP_[0-9]{8}\\.csv') THEN 'SCCT' END AS shape_feed,
  CASE WHEN regexp_full_match(name, '(?i)(30D_SALES_|CLOSING_STOCK_|STOCK_INTRANSIT_)[0-9]{14}\\.csv')
         THEN try_strptime(regexp_extract(name, '([0-9]{14})', 1), '%Y%m%d%H%M%S')
       WHEN regexp_full_match(name, '(?i)SCCT_RAWDATA_LD_WMP_[0-9]{8}\\.csv')
         THEN try_strptime(regexp_extract(name, '([0-9]{8})', 1), '%Y%m%d') END AS stamp"""

_CANDS_SQL = _MANIFEST_SQL + f""",
stamped AS (SELECT *, {_STAMP_SQL} FROM manifest),
cands AS (SELECT path, name, size, mtime, shape_feed AS feed, stamp FROM stamped WHERE stamp IS NOT NULL)"""


@query("file_stamp", _MANIFEST_SQL + f""",
stamped AS (SELECT *, {_STAMP_SQL} FROM manifest)
SELECT path, CASE WHEN stamp IS NOT NULL THEN shape_feed END AS feed,
       strftime(stamp, '%Y-%m-%d %H:%M:%S') AS stamp_text
FROM stamped""")
def q_file_stamp(spark, sf):
    c = S.stamp_files(manifest(spark, sf))
    return c.select("path", "feed", ts_text("stamp").alias("stamp_text"))


@query("candidates", _CANDS_SQL + """
SELECT path, feed, strftime(stamp, '%d/%m/%Y %H:%M:%S') AS stamp_display,
       strftime(mtime, '%Y-%m-%d %H:%M:%S') AS mtime_display
FROM cands""")
def q_candidates(spark, sf):
    c = S.with_display(S.candidates(manifest(spark, sf)))
    return c.select("path", "feed", "stamp_display", "mtime_display")


@query("latest_by_stamp", _CANDS_SQL + """
SELECT feed, path, name, size, strftime(stamp, '%Y-%m-%d %H:%M:%S') AS stamp_text,
       strftime(mtime, '%Y-%m-%d %H:%M:%S') AS mtime_text
FROM cands
QUALIFY row_number() OVER (PARTITION BY feed ORDER BY stamp DESC, path, name, size, mtime) = 1""")
def q_latest_by_stamp(spark, sf):
    latest = S.latest_by_stamp(S.candidates(manifest(spark, sf)))
    return latest.select("feed", "path", "name", "size", ts_text("stamp").alias("stamp_text"), ts_text("mtime").alias("mtime_text"))


@query("latest_by_mtime", _MANIFEST_SQL + """,
outs AS (
  SELECT replace(path, '.csv', '.parquet') AS path, replace(name, '.csv', '.parquet') AS name, size, mtime,
         CASE WHEN starts_with(name, '30D_SALES_') THEN '30D_SALES'
              WHEN starts_with(name, 'CLOSING_STOCK_') THEN 'CLOSING_STOCK'
              WHEN starts_with(name, 'STOCK_INTRANSIT_') THEN 'STOCK_INTRANSIT'
              WHEN starts_with(name, 'SCCT_RAWDATA_LD_WMP_') THEN 'SCCT' END AS feed
  FROM manifest WHERE ends_with(name, '.csv'))
SELECT feed, path, strftime(mtime, '%Y-%m-%d %H:%M:%S') AS mtime_text, CAST(count(*) OVER (PARTITION BY feed) AS BIGINT) AS old_outputs
FROM outs WHERE feed IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY feed ORDER BY mtime DESC, path, name, size) = 1""")
def q_latest_by_mtime(spark, sf):
    m = manifest(spark, sf).filter(F.col("name").endswith(".csv"))
    outs = m.select(F.replace("path", F.lit(".csv"), F.lit(".parquet")).alias("path"),
                    F.replace("name", F.lit(".csv"), F.lit(".parquet")).alias("name"), "size", "mtime")
    latest = S.latest_by_mtime(outs)
    counts = S.old_output_count(outs)
    return latest.join(counts, "feed").select("feed", "path", ts_text("mtime").alias("mtime_text"),
                                              F.col("old_outputs").cast("bigint").alias("old_outputs"))


@query("resolve_feed", _MANIFEST_SQL + """,
v AS (
  SELECT path,
         CASE fi WHEN 0 THEN '30D_SALES' WHEN 1 THEN 'CLOSING_STOCK' WHEN 2 THEN 'STOCK_INTRANSIT' ELSE 'SCCT' END AS k,
         CASE fi WHEN 0 THEN '30D_SALES_' WHEN 1 THEN 'CLOSING_STOCK_' WHEN 2 THEN 'STOCK_INTRANSIT_' ELSE 'SCCT_RAWDATA_LD_WMP_' END AS p,
         CAST(regexp_extract(path, '/land/b([0-9])/', 1) AS INTEGER) AS r, name, fi
  FROM manifest),
w AS (
  SELECT path,
         CASE (r + fi) % 6 WHEN 0 THEN k WHEN 1 THEN '  ' || lower(rtrim(p, '_')) || ' ' WHEN 2 THEN name
              WHEN 3 THEN lower(k) WHEN 4 THEN 'X' || name ELSE '' END AS value
  FROM v)
SELECT path, value,
  CASE WHEN upper(trim(value)) IN ('30D_SALES', 'CLOSING_STOCK', 'STOCK_INTRANSIT', 'SCCT') THEN upper(trim(value))
       WHEN upper(trim(value)) = '30D_SALES' OR starts_with(upper(trim(value)), '30D_SALES_') THEN '30D_SALES'
       WHEN upper(trim(value)) = 'CLOSING_STOCK' OR starts_with(upper(trim(value)), 'CLOSING_STOCK_') THEN 'CLOSING_STOCK'
       WHEN upper(trim(value)) = 'STOCK_INTRANSIT' OR starts_with(upper(trim(value)), 'STOCK_INTRANSIT_') THEN 'STOCK_INTRANSIT'
       WHEN upper(trim(value)) = 'SCCT_RAWDATA_LD_WMP' OR starts_with(upper(trim(value)), 'SCCT_RAWDATA_LD_WMP_') THEN 'SCCT'
  END AS feed
FROM w""")
def q_resolve_feed(spark, sf):
    m = manifest(spark, sf)
    keys = [f.key for f in FEEDS]
    prefixes = [f.prefix for f in FEEDS]
    fi = F.col("fi")
    k = F.when(fi == 0, keys[0]).when(fi == 1, keys[1]).when(fi == 2, keys[2]).otherwise(keys[3])
    p = F.when(fi == 0, prefixes[0]).when(fi == 1, prefixes[1]).when(fi == 2, prefixes[2]).otherwise(prefixes[3])
    r = F.regexp_extract("path", "/land/b([0-9])/", 1).cast("int")
    sel = (r + fi) % 6
    value = (F.when(sel == 0, k)
             .when(sel == 1, F.concat(F.lit("  "), F.lower(F.regexp_replace(p, "_+$", "")), F.lit(" ")))
             .when(sel == 2, F.col("name")).when(sel == 3, F.lower(k))
             .when(sel == 4, F.concat(F.lit("X"), F.col("name"))).otherwise(F.lit("")))
    w = m.select("path", value.alias("value"))
    return w.select("path", "value", resolve_feed("value").alias("feed"))


_DAY_SQL = _MANIFEST_SQL + """,
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
feeds(feed, prefix, date_only) AS (VALUES ('30D_SALES', '30D_SALES_', false), ('CLOSING_STOCK', 'CLOSING_STOCK_', false),
                          ('STOCK_INTRANSIT', 'STOCK_INTRANSIT_', false), ('SCCT', 'SCCT_RAWDATA_LD_WMP_', true)),
exp AS (SELECT day, feed, prefix || strftime(day, '%Y%m%d') AS day_prefix, date_only FROM days CROSS JOIN feeds),
named AS (
  -- at most one feed's prefix starts a name; its 8-digit day is the equality key
  SELECT name, path, size, mtime, CASE WHEN starts_with(name, '30D_SALES_') THEN '30D_SALES' WHEN starts_with(name, 'CLOSING_STOCK_') THEN 'CLOSING_STOCK'
              WHEN starts_with(name, 'STOCK_INTRANSIT_') THEN 'STOCK_INTRANSIT' WHEN starts_with(name, 'SCCT_RAWDATA_LD_WMP_') THEN 'SCCT' END AS feed
  FROM manifest WHERE ends_with(name, '.csv')),
dated AS (
  SELECT n.*, substr(name, 1, length(f.prefix) + 8) AS day_prefix FROM named n JOIN feeds f USING (feed)),
hits AS (
  SELECT e.day, e.feed, m.name, m.path, m.size, m.mtime,
         row_number() OVER (PARTITION BY e.day, e.feed ORDER BY m.mtime DESC, m.path, m.name, m.size) AS rn
  FROM exp e JOIN dated m ON m.feed = e.feed AND m.day_prefix = e.day_prefix
  WHERE NOT e.date_only OR m.name = e.day_prefix || '.csv'),
scan AS (
  SELECT e.day, e.feed,
         CASE WHEN h.name IS NULL THEN e.day_prefix || '*.csv' ELSE h.name END AS name,
         coalesce(h.path, '') AS path, CAST(coalesce(h.size, 0) AS BIGINT) AS size,
         CASE WHEN h.name IS NULL THEN '-' ELSE printf('%.1f MB', h.size / 1048576.0) END AS size_label,
         CASE WHEN h.name IS NULL THEN '-' ELSE strftime(h.mtime, '%Y-%m-%d %H:%M:%S') END AS date_modified,
         CASE WHEN h.name IS NULL THEN 'missing' ELSE 'pending' END AS status
  FROM exp e LEFT JOIN (SELECT * FROM hits WHERE rn = 1) h ON h.day = e.day AND h.feed = e.feed)"""


def _days(spark, sf) -> DataFrame:
    return t(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))


@query("day_scan", _DAY_SQL + """
SELECT strftime(day, '%Y-%m-%d') AS day, feed, name, path, size, size_label, date_modified, status FROM scan""")
def q_day_scan(spark, sf):
    scan = S.day_scan(spark, manifest(spark, sf), _days(spark, sf))
    return scan.withColumn("day", ts_text("day", "yyyy-MM-dd"))


@query("found_count", _DAY_SQL + """
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(count(*) FILTER (WHERE status <> 'missing') AS BIGINT) AS found_count
FROM scan GROUP BY day""")
def q_found_count(spark, sf):
    return S.found_count(S.day_scan(spark, manifest(spark, sf), _days(spark, sf))).withColumn("day", ts_text("day", "yyyy-MM-dd"))


@query("missing_feeds", _DAY_SQL + """
SELECT strftime(e.day, '%Y-%m-%d') AS day, e.feed FROM exp e
WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.day = e.day AND h.feed = e.feed)""")
def q_missing_feeds(spark, sf):
    return S.missing_feeds(spark, manifest(spark, sf), _days(spark, sf)).select(ts_text("day", "yyyy-MM-dd").alias("day"), "feed")


# ----------------------------------------------------- A6, C6, C8, C9, H1 ---

_BUSINESS_HEADER_LINE = " DATE,Store_ID,product_id,CATEGORY ,qty_sold,revenue,discount,currency"


def _land_customer(spark, sf) -> str:
    c = t(spark, sf, "customer").withColumn("bucket", (F.col("c_custkey") / 500).cast("bigint"))
    fields = F.array(F.concat(F.lit("2024-01-"), F.lpad(s(F.col("c_nationkey") + 1), 2, "0")), s("c_nationkey"),
                     s("c_custkey"), F.col("c_mktsegment"), s(F.col("c_custkey") % 100), money("c_acctbal"),
                     F.lit("0"), F.lit("VND"))
    return land_buckets(spark, c.withColumn("value", encode_csv(fields, ",")), "value", "bucket", ["c_custkey"],
                        "customer-business", header=_BUSINESS_HEADER_LINE)


def _customer_table(spark, sf) -> DataFrame:
    lines = read_numbered_lines(spark, _land_customer(spark, sf), recursive=True)
    return TB.to_table_positional(TB.parse(lines, ","), 8, keep=["file", "line_no"])


_BUSINESS_SQL = """
SELECT '2024-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS date, CAST(c_nationkey AS VARCHAR) AS store_id,
       CAST(c_custkey AS VARCHAR) AS product_id, c_mktsegment AS category, CAST(c_custkey % 100 AS VARCHAR) AS qty_sold,
       printf('%.2f', c_acctbal) AS revenue, '0' AS discount, 'VND' AS currency
FROM customer"""


@query("header_promotion", _BUSINESS_SQL)
def q_header_promotion(spark, sf):
    return TB.promote_header(_customer_table(spark, sf)).drop("file", "line_no")


@query("preview20", """
SELECT c_custkey // 500 AS bucket, CAST(row_number() OVER (PARTITION BY c_custkey // 500 ORDER BY c_custkey) AS INTEGER) AS row,
       CAST(c_custkey AS VARCHAR) AS product_id, printf('%.2f', c_acctbal) AS revenue
FROM customer QUALIFY row <= 20""")
def q_preview20(spark, sf):
    lines = read_numbered_lines(spark, _land_customer(spark, sf), recursive=True)
    prev = A.csv_preview(TB.parse(lines, ","), "file", has_header=True)
    return prev.select(F.regexp_extract("file", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket"),
                       "row", F.col("fields")[2].alias("product_id"), F.col("fields")[5].alias("revenue"))


def _land_part_with_header(spark, sf) -> str:
    p = t(spark, sf, "part").withColumn("bucket", (F.col("p_partkey") / 500).cast("bigint"))
    fields = F.array(s("p_partkey"), F.col("p_name"), s("p_size"), F.col("p_brand"), F.col("p_type"))
    return land_buckets(spark, p.withColumn("value", encode_csv(fields, ",")), "value", "bucket", ["p_partkey"],
                        "part-header", header="P_PARTKEY,p_name,P_PARTKEY,,p type")


def _header_table(spark, sf) -> DataFrame:
    lines = read_numbered_lines(spark, _land_part_with_header(spark, sf), recursive=True)
    parsed = TB.parse(lines, ",", repair=FEED_BY_KEY["SCCT"].repair_dangling_quote)
    return TB.to_table_header(parsed, TB.one_shape(parsed, has_header=True).header)


@query("header_table", """
SELECT CAST(p_partkey AS VARCHAR) AS "P_PARTKEY", p_name, CAST(p_size AS VARCHAR) AS "P_PARTKEY_1",
       p_brand AS column3, p_type AS "p type"
FROM part""")
def q_header_table(spark, sf):
    return _header_table(spark, sf)


@query("header_schema", """
SELECT * FROM (VALUES (1, 'P_PARTKEY', 'string'), (2, 'p_name', 'string'), (3, 'P_PARTKEY_1', 'string'),
                      (4, 'column3', 'string'), (5, 'p type', 'string')) v(position, name, type)""")
def q_header_schema(spark, sf):
    return TB.describe(spark, _header_table(spark, sf))


@query("positional_schema", """
SELECT * FROM (VALUES (1, 'column1', 'string'), (2, 'column2', 'string'), (3, 'column3', 'string'),
                      (4, 'column4', 'string'), (5, 'column5', 'string')) v(position, name, type)""")
def q_positional_schema(spark, sf):
    c = t(spark, sf, "customer")
    fields = F.array(s("c_custkey"), F.col("c_name"), s("c_nationkey"), money("c_acctbal"), F.col("c_mktsegment"))
    root = land_ranges(spark, c.withColumn("value", encode_csv(fields, ";")), "value", ["c_custkey"], "customer-positional")
    parsed = TB.parse(read_numbered_lines(spark, root), ";")
    return TB.describe(spark, TB.to_table_positional(parsed, TB.one_shape(parsed).expected))


@query("describe", """
SELECT * FROM (VALUES (1, 'l_orderkey', 'bigint'), (2, 'l_partkey', 'bigint'), (3, 'l_suppkey', 'bigint'),
  (4, 'l_linenumber', 'int'), (5, 'l_quantity', 'double'), (6, 'l_extendedprice', 'double'), (7, 'l_discount', 'double'),
  (8, 'l_tax', 'double'), (9, 'l_returnflag', 'string'), (10, 'l_linestatus', 'string'), (11, 'l_shipdate', 'timestamp_ntz'))
  v(position, name, type)""")
def q_describe(spark, sf):
    return TB.describe(spark, t(spark, sf, "lineitem"))


# ------------------------------------------------------------------ A7 ---

def _events_typed(spark, sf) -> DataFrame:
    e = t(spark, sf, "events")
    fields = F.array(s("event_id"), ts_text("ts"), s("user_id"), F.col("event_type"), money("value"),
                     F.lpad(s("user_id"), 5, "0"), ts_text("ts", "yyyy-MM-dd"),
                     F.when(F.col("value") > 10, F.lit("true")).otherwise(F.lit("FALSE")),
                     ts_text("ts", "HH:mm:ss"), ts_text("ts", "yyyyMMdd"))
    root = land_ranges(spark, e.withColumn("value", encode_csv(fields, ",")), "value", ["event_id"], "events-text")
    parsed = TB.parse(read_numbered_lines(spark, root), ",")
    table = TB.to_table_positional(parsed, TB.one_shape(parsed).expected, base=0, pad=True)
    return TB.cast_table(table, TB.infer_types(table))


@query("infer_types", """
SELECT * FROM (VALUES (1, 'column0', 'bigint'), (2, 'column1', 'timestamp_ntz'), (3, 'column2', 'bigint'),
  (4, 'column3', 'string'), (5, 'column4', 'double'), (6, 'column5', 'string'), (7, 'column6', 'date'),
  (8, 'column7', 'boolean'), (9, 'column8', 'string'), (10, 'column9', 'bigint')) v(position, name, type)""")
def q_infer_types(spark, sf):
    return TB.describe(spark, _events_typed(spark, sf))


@query("typed_table", """
SELECT event_id AS column0, strftime(ts, '%Y-%m-%d %H:%M:%S') AS column1, user_id AS column2, event_type AS column3,
       value AS column4, lpad(CAST(user_id AS VARCHAR), 5, '0') AS column5, strftime(ts, '%Y-%m-%d') AS column6,
       value > 10 AS column7, strftime(ts, '%H:%M:%S') AS column8, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS column9
FROM events""")
def q_typed_table(spark, sf):
    tb = _events_typed(spark, sf)
    return tb.withColumn("column1", ts_text("column1")).withColumn("column6", ts_text("column6", "yyyy-MM-dd"))


# ------------------------------------------------------------- D1, D2 ---

def _size_label_sql(expr: str) -> str:
    b = f"CAST({expr} AS DOUBLE)"
    units = ["B", "KB", "MB", "GB", "TB"]
    parts = [f"WHEN {b} / {float(1024 ** i)} < 1024 THEN printf('%.1f {u}', {b} / {float(1024 ** i)})" for i, u in enumerate(units)]
    return "CASE " + " ".join(parts) + f" ELSE printf('%.1f PB', {b} / {float(1024 ** 5)}) END"


@query("csv_stats", f"""
WITH l AS (SELECT doc_id, text, unnest(string_split_regex(replace(text, '"', ''), '\\r\\n|\\r|\\n')) AS line FROM documents)
SELECT doc_id AS file, CAST(count(*) FILTER (WHERE line <> '') AS BIGINT) AS rows,
       CAST(coalesce(max(len(string_split(line, ','))) FILTER (WHERE line <> ''), 0) AS BIGINT) AS columns,
       CAST(max(strlen(text)) AS BIGINT) AS size, {_size_label_sql("max(strlen(text))")} AS size_label
FROM l GROUP BY doc_id""")
def q_csv_stats(spark, sf):
    d = t(spark, sf, "documents")
    lines = d.select(F.col("doc_id").alias("file"), F.octet_length("text").cast("bigint").alias("file_size"),
                     F.posexplode(F.split(F.replace("text", F.lit('"'), F.lit("")), "\r\n|\r|\n")).alias("pos", "value"))
    parsed = TB.parse(lines.withColumn("line_no", F.col("pos") + 1), ",")
    st = A.csv_stats(parsed, "file", has_header=False, size_col="file_size")
    return st.select("file", "rows", F.col("columns").cast("bigint").alias("columns"), "size", "size_label")


@query("csv_stats_quoted", """
WITH l AS (SELECT doc_id, lang, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents)
SELECT doc_id AS file, CAST(count(*) AS BIGINT) AS rows, CAST(max(CASE WHEN doc_id % 3 = 1 AND line <> '' THEN 4 ELSE 3 END) AS BIGINT) AS columns FROM l GROUP BY doc_id""")
def q_csv_stats_quoted(spark, sf):
    """D1 over quoted fields: whole texts with their own quotes and delimiters, encoded."""
    from quayside.functions.quoting import encode_columns

    d = t(spark, sf, "documents")
    lines = d.select(F.col("doc_id").alias("file"), "lang", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("pos", "line"))
    three, four = [s("file"), F.col("line"), F.coalesce("lang", F.lit("?"))], [s("file"), F.col("line"), F.lit(""), F.concat(F.lit('"'), "line", F.lit(",;"))]
    value = F.when((F.col("file") % 3 == 1) & (F.col("line") != ""), encode_columns(four, ",")).otherwise(encode_columns(three, ","))
    parsed = TB.parse(lines.select("file", (F.col("pos") + 1).alias("line_no"), value.alias("value")), ",", repair=False)
    return A.csv_stats(parsed, "file", size_col=None).select("file", "rows", F.col("columns").cast("bigint").alias("columns"))


@query("parquet_stats", """
SELECT 'lineitem.parquet' AS name, count(*) AS rows, CAST(11 AS BIGINT) AS columns FROM lineitem""")
def q_parquet_stats(spark, sf):
    st = A.parquet_stats(spark, f"{sf}/lineitem.parquet")
    return st.select(F.regexp_extract("file", "[^/]*$", 0).alias("name"), "rows", F.col("columns").cast("bigint").alias("columns"))


# ---------------------------------------------------------- B7, B8, B9 ---

@query("size_label", f"""
SELECT doc_id, n_chars * pow(1024, doc_id % 6) AS bytes, {_size_label_sql("n_chars * pow(1024, doc_id % 6)")} AS label,
       printf('%.1f MB', n_chars / 1048576.0) AS mb_label
FROM documents""")
def q_size_label(spark, sf):
    from quayside.functions.scalars import size_mb_label

    d = t(spark, sf, "documents")
    b = F.col("n_chars").cast("double") * F.pow(F.lit(1024.0), (F.col("doc_id") % 6).cast("double"))
    return d.select("doc_id", b.alias("bytes"), size_label(b).alias("label"), size_mb_label("n_chars").alias("mb_label"))


@query("compression_ratio", """
WITH x AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS p,
                  CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(floor(l_extendedprice * (1 + l_tax)) + CAST(l_quantity AS BIGINT) * 3 AS BIGINT) END AS c
           FROM lineitem)
SELECT l_orderkey, l_linenumber, p, c,
       CASE WHEN c > 0 THEN round_even((1 - CAST(p AS DOUBLE) / c) * 100, 1) ELSE 0.0 END AS ratio
FROM x""")
def q_compression_ratio(spark, sf):
    li = t(spark, sf, "lineitem")
    p = F.floor("l_extendedprice").cast("bigint")
    c = F.when(F.col("l_linenumber") == 7, F.lit(0)).otherwise(
        F.floor(F.col("l_extendedprice") * (F.lit(1) + F.col("l_tax"))) + F.col("l_quantity").cast("bigint") * 3).cast("bigint")
    x = li.select("l_orderkey", "l_linenumber", p.alias("p"), c.alias("c"))
    return x.withColumn("ratio", compression_ratio("p", "c"))


# ------------------------------------------------ I1, E1 (flagship), F5 ---

def _orders_fields():
    # The feeds repair dangling quotes, so a quote right before a delimiter is
    # read as quote-and-close; the injected text keeps quotes off that spot.
    status = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.concat("o_orderstatus", F.lit('"x;')))
    return F.array(s("o_orderkey"), s("o_custkey"), status, money("o_totalprice"),
                   ts_text("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority"))


@query("integrity", """
SELECT '30D_SALES' AS feed, count(*) AS csv_rows, CAST(6 AS INTEGER) AS csv_columns, count(*) AS parquet_rows,
       CAST(6 AS INTEGER) AS parquet_columns, true AS rows_match, true AS columns_match,
       CAST(20 AS INTEGER) AS csv_preview_rows, CAST(20 AS INTEGER) AS parquet_preview_rows, CAST(0 AS BIGINT) AS preview_differ,
       count(*) AS rows_written
FROM orders""")
def q_integrity(spark, sf):
    from quayside.plans.convert import convert

    o = t(spark, sf, "orders")
    root = land_ranges(spark, o.withColumn("value", encode_csv(_orders_fields(), ";")), "value", ["o_orderkey"], "orders-landing")
    out = scratch_path(spark, "published")
    audit = convert(spark, root, out, "30D_SALES")
    rows = A._row_differs
    differ = F.size(F.filter(F.zip_with("csv.preview", "parquet.preview", lambda a, b: rows(a, b)), lambda d: d))
    return audit.select(
        "feed", F.col("csv.rows").alias("csv_rows"), F.col("csv.columns").alias("csv_columns"),
        F.col("parquet.rows").alias("parquet_rows"), F.col("parquet.columns").alias("parquet_columns"),
        (F.col("csv.rows") == F.col("parquet.rows")).alias("rows_match"),
        (F.col("csv.columns") == F.col("parquet.columns")).alias("columns_match"),
        F.size("csv.preview").alias("csv_preview_rows"), F.size("parquet.preview").alias("parquet_preview_rows"),
        differ.cast("bigint").alias("preview_differ"), "rows_written")


@query("check", """
SELECT count(*) AS csv_rows, count(*) AS parquet_rows, CAST(6 AS BIGINT) AS csv_columns, CAST(6 AS BIGINT) AS parquet_columns,
       true AS rows_match, true AS columns_match, CAST(20 AS BIGINT) AS rows_compared, CAST(0 AS BIGINT) AS rows_differ
FROM orders""")
def q_check(spark, sf):
    from quayside.plans.convert import check, convert

    o = t(spark, sf, "orders")
    root = land_ranges(spark, o.withColumn("value", encode_csv(_orders_fields(), ";")), "value", ["o_orderkey"], "orders-landing")
    out = scratch_path(spark, "published")
    convert(spark, root, out, "30D_SALES").collect()
    res = check(spark, root, f"{out}/feed=30D_SALES", "30D_SALES")
    return res.drop("compression_ratio")


_RUN_BUCKET_ROWS = 4000


@query("run_feed", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS column1, CAST(o_custkey AS VARCHAR) AS column2,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus || '"x;' END AS column3,
       printf('%.2f', o_totalprice) AS column4, strftime(o_orderdate, '%Y-%m-%d') AS column5, o_orderpriority AS column6
FROM orders WHERE o_orderkey // {_RUN_BUCKET_ROWS} = (SELECT max(o_orderkey // {_RUN_BUCKET_ROWS}) FROM orders)""")
def q_run_feed(spark, sf):
    """I2 on a landing zone of real feed files: orders cut into one file per
    key bucket, stamped by bucket; the newest stamp is picked and converted."""
    from quayside.plans.convert import run_feed
    from quayside.plans.landing import land_named_files

    o = t(spark, sf, "orders").withColumn("bucket", (F.col("o_orderkey") / _RUN_BUCKET_ROWS).cast("bigint"))
    o = o.withColumn("value", encode_csv(_orders_fields(), ";"))

    root = land_named_files(spark, o, "value", "bucket", ["o_orderkey"], "orders-feed", lambda k: f"30D_SALES_{_stamp14(k)}.csv")
    out = scratch_path(spark, "published")
    run_feed(spark, root, out, "30D_SALES").collect()
    return spark.read.parquet(f"{out}/feed=30D_SALES").drop(*ORIGIN)


def _stamp14(k: str) -> str:
    """The k-th minute from the start of 2024."""
    import datetime as dt

    return (dt.datetime(2024, 1, 1) + dt.timedelta(minutes=int(k))).strftime("%Y%m%d%H%M%S")


@query("run_all", """
SELECT '30D_SALES' AS feed, count(*) AS csv_rows, count(*) AS parquet_rows, CAST(6 AS INTEGER) AS columns, count(*) AS published_rows
FROM orders WHERE o_orderkey // 4000 = (SELECT max(o_orderkey // 4000) FROM orders)
UNION ALL SELECT 'CLOSING_STOCK', count(*), count(*), CAST(7 AS INTEGER), count(*)
FROM events WHERE event_id // 3000 = (SELECT max(event_id // 3000) FROM events)
UNION ALL SELECT 'STOCK_INTRANSIT', count(*), count(*), CAST(5 AS INTEGER), count(*)
FROM lineitem WHERE l_orderkey // 4000 = (SELECT max(l_orderkey // 4000) FROM lineitem)
UNION ALL SELECT 'SCCT', count(*), count(*), CAST(5 AS INTEGER), count(*)
FROM part WHERE p_partkey // 500 = (SELECT max(p_partkey // 500) FROM part)""")
def q_run_all(spark, sf):
    """I3 on a landing zone holding all four feeds, each cut into stamped
    files by key bucket: one catalogue listing, one latest-per-feed aggregate,
    four conversions (positional, inferred, positional, header), then one
    all-or-nothing publish."""
    import datetime as dt

    from quayside.functions.quoting import encode_columns
    from quayside.plans.convert import run_all
    from quayside.plans.landing import land_named_files

    root = scratch_path(spark, "zone")
    bucket = lambda c, n: (F.col(c) / n).cast("bigint")
    o = t(spark, sf, "orders").withColumn("bucket", bucket("o_orderkey", 4000))
    land_named_files(spark, o.withColumn("value", encode_csv(_orders_fields(), ";")), "value", "bucket", ["o_orderkey"],
                     "z-orders", lambda k: f"30D_SALES_{_stamp14(k)}.csv", root=root)
    e = t(spark, sf, "events").withColumn("bucket", bucket("event_id", 3000))
    ev = encode_columns([s("event_id"), ts_text("ts"), s("user_id"), F.col("event_type"), money("value"),
                         F.lpad(s("user_id"), 5, "0"), ts_text("ts", "yyyy-MM-dd")], ",")
    land_named_files(spark, e.withColumn("value", ev), "value", "bucket", ["event_id"],
                     "z-events", lambda k: f"CLOSING_STOCK_{_stamp14(k)}.csv", root=root)
    li = t(spark, sf, "lineitem").withColumn("bucket", bucket("l_orderkey", 4000))
    lv = encode_columns([s("l_orderkey"), s("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus"),
                         ts_text("l_shipdate", "yyyy-MM-dd")], ";")
    land_named_files(spark, li.withColumn("value", lv), "value", "bucket", ["l_orderkey", "l_linenumber"],
                     "z-lineitem", lambda k: f"STOCK_INTRANSIT_{_stamp14(k)}.csv", root=root)
    p = t(spark, sf, "part").withColumn("bucket", bucket("p_partkey", 500))
    pv = encode_columns([s("p_partkey"), F.col("p_name"), s("p_size"), F.col("p_brand"), F.col("p_type")], ",")
    day = lambda k: (dt.date(2024, 1, 1) + dt.timedelta(days=int(k))).strftime("%Y%m%d")
    land_named_files(spark, p.withColumn("value", pv), "value", "bucket", ["p_partkey"],
                     "z-part", lambda k: f"SCCT_RAWDATA_LD_WMP_{day(k)}.csv", header="key,name,size,brand,type", root=root)
    from quayside.sources.catalog import ensure_dir

    out, target = scratch_path(spark, "published"), ensure_dir(spark, scratch_path(spark, "serving"))
    audits = run_all(spark, root, out, target).select(
        "feed", F.col("csv.rows").alias("csv_rows"), F.col("parquet.rows").alias("parquet_rows"),
        F.col("parquet.columns").alias("columns"))
    counts = None
    for f in FEEDS:  # feed folders have different schemas: each is read as its own dataset
        c = spark.read.parquet(f"{target}/feed={f.key}").agg(F.count(F.lit(1)).alias("published_rows")) \
            .withColumn("feed", F.lit(f.key))
        counts = c if counts is None else counts.unionByName(c)
    return audits.join(counts, "feed", "left_outer")


@query("converted_table", """
SELECT CAST(o_orderkey AS VARCHAR) AS column1, CAST(o_custkey AS VARCHAR) AS column2,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus || '"x;' END AS column3,
       printf('%.2f', o_totalprice) AS column4, strftime(o_orderdate, '%Y-%m-%d') AS column5, o_orderpriority AS column6,
       '30D_SALES' AS feed
FROM orders""")
def q_converted_table(spark, sf):
    from quayside.plans.convert import convert

    o = t(spark, sf, "orders")
    root = land_ranges(spark, o.withColumn("value", encode_csv(_orders_fields(), ";")), "value", ["o_orderkey"], "orders-landing")
    out = scratch_path(spark, "published")
    convert(spark, root, out, "30D_SALES").collect()
    return spark.read.parquet(out).drop(*ORIGIN)


@query("canonical_csv", """
SELECT CAST(l_orderkey AS VARCHAR) || ';' || CAST(l_linenumber AS VARCHAR) || ';' || chr(34) || l_returnflag || repeat(chr(34), 3) ||
       ';' || l_linestatus || ';' AS value
FROM lineitem""")
def q_canonical_csv(spark, sf):
    from quayside.operators.sinks import write_canonical_csv

    li = t(spark, sf, "lineitem")
    fields = F.array(s("l_orderkey"), s("l_linenumber"), F.concat("l_returnflag", F.lit('"')), F.col("l_linestatus"), F.lit(""))
    parsed = TB.parse(li.select(quote_all(fields, ";").alias("value")), ";", repair=False)
    path = scratch_path(spark, "canonical")
    write_canonical_csv(parsed, path, ";", n=5)
    return spark.read.text(path)


# ---------------------------------------------------------------- E2, E3 ---

def _orders_left(spark, sf) -> DataFrame:
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_orderstatus").alias("status"), money("o_totalprice").alias("price"),
                    F.col("o_orderpriority").alias("priority"))


def _orders_right(spark, sf) -> DataFrame:
    o = t(spark, sf, "orders").filter(F.col("o_orderkey") % 50 != 17)
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(k % 7 == 0, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 3 == 0, F.format_string("%.3f", F.col("o_totalprice"))).otherwise(money("o_totalprice")).alias("price"),
        F.when(k % 11 == 0, F.concat(F.lit(" "), F.col("o_orderpriority"))).otherwise(F.col("o_orderpriority")).alias("priority"))


_CMP = "CASE WHEN {x} IS NULL THEN '' WHEN regexp_full_match(trim({x}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN 'n:' || CAST(CAST(trim({x}) AS DOUBLE) AS VARCHAR) ELSE trim({x}) END"


def _cmp(x: str) -> str:
    return _CMP.format(x=x)


_DIFF_SIDES = """
l AS (SELECT o_orderkey, o_orderstatus AS c1, printf('%.2f', o_totalprice) AS c2, o_orderpriority AS c3 FROM orders),
r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS c1,
             CASE WHEN o_orderkey % 3 = 0 THEN printf('%.3f', o_totalprice) ELSE printf('%.2f', o_totalprice) END AS c2,
             CASE WHEN o_orderkey % 11 = 0 THEN ' ' || o_orderpriority ELSE o_orderpriority END AS c3
      FROM orders WHERE o_orderkey % 50 <> 17)"""


@query("preview_diff", f"""
WITH {_DIFF_SIDES},
lp AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS row, CAST(o_orderkey AS VARCHAR) AS k, c1, c2, c3 FROM l QUALIFY row <= 20),
rp AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS row, CAST(o_orderkey AS VARCHAR) AS k, c1, c2, c3 FROM r QUALIFY row <= 20)
SELECT count(*) AS rows_compared,
       count(*) FILTER (WHERE lp.row IS NULL OR rp.row IS NULL
                        OR {_cmp("lp.k")} <> {_cmp("rp.k")} OR {_cmp("lp.c1")} <> {_cmp("rp.c1")}
                        OR {_cmp("lp.c2")} <> {_cmp("rp.c2")} OR {_cmp("lp.c3")} <> {_cmp("rp.c3")}) AS rows_differ
FROM lp FULL OUTER JOIN rp USING (row)""")
def q_preview_diff(spark, sf):
    def prev(df):
        top = df.orderBy("o_orderkey").limit(A.PREVIEW_ROWS)
        from pyspark.sql import Window
        return top.select(F.row_number().over(Window.orderBy("o_orderkey")).alias("row"),
                          F.array(s("o_orderkey"), "status", "price", "priority").alias("fields"))
    return A.preview_diff(prev(_orders_left(spark, sf)), prev(_orders_right(spark, sf)))


@query("table_diff", f"""
WITH {_DIFF_SIDES},
j AS (SELECT l.o_orderkey IS NOT NULL AS hl, r.o_orderkey IS NOT NULL AS hr, l.c1 AS l1, l.c2 AS l2, l.c3 AS l3,
             r.c1 AS r1, r.c2 AS r2, r.c3 AS r3 FROM l FULL OUTER JOIN r USING (o_orderkey)),
tot AS (SELECT count(*) FILTER (WHERE NOT hl) AS missing_left, count(*) FILTER (WHERE NOT hr) AS missing_right,
  count(*) FILTER (WHERE NOT hl OR NOT hr OR {_cmp("l1")} <> {_cmp("r1")} OR {_cmp("l2")} <> {_cmp("r2")} OR {_cmp("l3")} <> {_cmp("r3")}) AS rows_differ,
  count(*) FILTER (WHERE hl AND hr AND l1 <> r1) AS x1, count(*) FILTER (WHERE hl AND hr AND {_cmp("l1")} <> {_cmp("r1")}) AS v1,
  count(*) FILTER (WHERE hl AND hr AND l2 <> r2) AS x2, count(*) FILTER (WHERE hl AND hr AND {_cmp("l2")} <> {_cmp("r2")}) AS v2,
  count(*) FILTER (WHERE hl AND hr AND l3 <> r3) AS x3, count(*) FILTER (WHERE hl AND hr AND {_cmp("l3")} <> {_cmp("r3")}) AS v3
  FROM j)
SELECT missing_left, missing_right, rows_differ, 'status' AS column, x1 AS lexical_diff, v1 AS value_diff FROM tot
UNION ALL SELECT missing_left, missing_right, rows_differ, 'price', x2, v2 FROM tot
UNION ALL SELECT missing_left, missing_right, rows_differ, 'priority', x3, v3 FROM tot""")
def q_table_diff(spark, sf):
    return A.table_diff(_orders_left(spark, sf), _orders_right(spark, sf), ["o_orderkey"], ["status", "price", "priority"])


@query("table_diff_blocks", """
WITH x AS (SELECT event_id % 997 = 3 AS changed, event_id % 1499 = 11 AS gone FROM events)
SELECT count(*) FILTER (WHERE gone) AS missing_right, CAST(0 AS BIGINT) AS missing_left,
       count(*) FILTER (WHERE gone OR changed) AS rows_differ, count(*) FILTER (WHERE changed AND NOT gone) AS lexical_diff FROM x""")
def q_table_diff_blocks(spark, sf):
    """E3 by block digests: few changes in a large table, so only a few blocks are joined."""
    ev, k = t(spark, sf, "events").select("event_id", money("value").alias("value"), "event_type"), F.col("event_id")
    changed = ev.filter(k % 1499 != 11).withColumn("value", F.when(k % 997 == 3, F.concat("value", F.lit("9"))).otherwise(F.col("value")))
    diff = A.table_diff(ev, changed, ["event_id"], ["value", "event_type"])
    return diff.filter(F.col("column") == "value").select("missing_right", "missing_left", "rows_differ", "lexical_diff")


# ---------------------------------------------------------------- F2, F3 ---

def _orders_by_status(spark, sf, status: str) -> DataFrame:
    return t(spark, sf, "orders").filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus")


@query("replace_feed", """
SELECT 'CLOSING_STOCK' AS feed, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'SCCT', o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'""")
def q_replace_feed(spark, sf):
    target = scratch_path(spark, "serving")
    write_feed(_orders_by_status(spark, sf, "F"), target, feed="CLOSING_STOCK")
    write_feed(_orders_by_status(spark, sf, "O"), target, feed="SCCT")
    write_feed(_orders_by_status(spark, sf, "P"), target, feed="CLOSING_STOCK")  # replaces F rows only
    return spark.read.parquet(target)


@query("publish", """
SELECT 'CLOSING_STOCK' AS feed, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'SCCT', o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'STOCK_INTRANSIT', o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""")
def q_publish(spark, sf):
    target = scratch_path(spark, "serving")
    staged = scratch_path(spark, "staged")
    write_feed(_orders_by_status(spark, sf, "F"), target, feed="CLOSING_STOCK")
    write_feed(_orders_by_status(spark, sf, "O"), target, feed="SCCT")
    write_feed(_orders_by_status(spark, sf, "P"), target, feed="STOCK_INTRANSIT")
    write_feed(_orders_by_status(spark, sf, "O"), staged, feed="CLOSING_STOCK")
    write_feed(_orders_by_status(spark, sf, "F"), staged, feed="STOCK_INTRANSIT")
    publish(spark, staged, target, ["CLOSING_STOCK", "STOCK_INTRANSIT"], mode="all_or_nothing")
    return spark.read.parquet(target)


@query("publish_version", """
SELECT 'CLOSING_STOCK' AS feed, o_orderkey, o_orderstatus, CAST(2 AS BIGINT) AS commits FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'SCCT', o_orderkey, o_orderstatus, 2 FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'STOCK_INTRANSIT', o_orderkey, o_orderstatus, 2 FROM orders WHERE o_orderstatus = 'F'""")
def q_publish_version(spark, sf):
    """F3 by commits: two feeds, then one of them anew and a third, each publish appearing at once."""
    from quayside.operators.commits import commit_numbers, publish_version, read_published
    from quayside.sources.catalog import ensure_dir

    target = ensure_dir(spark, scratch_path(spark, "serving"))
    for parts in ({"CLOSING_STOCK": "F", "SCCT": "O"}, {"CLOSING_STOCK": "P", "STOCK_INTRANSIT": "F"}):
        staged = scratch_path(spark, "staged")
        for feed, status in parts.items():
            write_feed(_orders_by_status(spark, sf, status), staged, feed=feed)
        publish_version(spark, staged, target, list(parts), move="STOCK_INTRANSIT" in parts)
    out = None
    for feed in ("CLOSING_STOCK", "SCCT", "STOCK_INTRANSIT"):
        rows = read_published(spark, target, feed).select(F.lit(feed).alias("feed"), "o_orderkey", "o_orderstatus")
        out = rows if out is None else out.unionAll(rows)
    return out.withColumn("commits", F.lit(len(commit_numbers(spark, target))).cast("bigint"))


# ------------------------------------------------------ B11, B12, J1-J6 ---

def _messages(spark, sf) -> DataFrame:
    e = t(spark, sf, "events")
    et = F.col("event_type")
    msg = (F.when(et == "error", F.concat(F.lit("event with lỗi, number "), s("event_id")))
           .when(et == "purchase", F.concat(F.lit("order hoàn tất for user "), s("user_id")))
           .when(et == "signup", F.concat(F.lit("WARNING: new user "), F.col("props")))
           .when(et == "click", F.concat(F.lit("Convert "), s("event_id"), F.lit(" Complete")))
           .otherwise(F.concat(F.lit("view "), F.col("props"))))
    ev = e.select(F.concat(F.lit("e"), s("event_id")).alias("id"), msg.alias("message"))
    cv = t(spark, sf, "conversations").select(F.concat(F.lit("c"), s("conv_id"), F.lit("."), s("turn")).alias("id"),
                                              F.col("text").alias("message"))
    return ev.unionByName(cv)


_MESSAGES_SQL = """
msgs AS (
  SELECT 'e' || CAST(event_id AS VARCHAR) AS id,
         CASE event_type WHEN 'error' THEN 'event with lỗi, number ' || CAST(event_id AS VARCHAR)
              WHEN 'purchase' THEN 'order hoàn tất for user ' || CAST(user_id AS VARCHAR)
              WHEN 'signup' THEN 'WARNING: new user ' || props
              WHEN 'click' THEN 'Convert ' || CAST(event_id AS VARCHAR) || ' Complete'
              ELSE 'view ' || props END AS message
  FROM events
  UNION ALL SELECT 'c' || CAST(conv_id AS VARCHAR) || '.' || CAST(turn AS VARCHAR), text FROM conversations)"""

# --- fixed values (must equal the reference's): the severity words, and the feed prefixes above ---
_SEVERITY_SQL = """CASE WHEN contains(lower(message), 'error') OR contains(lower(message), 'lỗi') OR contains(lower(message), 'failed') THEN 'error'
     WHEN contains(lower(message), 'hoàn tất') OR contains(lower(message), 'complete') OR contains(lower(message), 'success') THEN 'success'
     WHEN contains(lower(message), 'warning') OR contains(lower(message), 'dừng') THEN 'warning' ELSE 'info' END"""


@query("log_severity", f"""
WITH {_MESSAGES_SQL}
SELECT id, {_SEVERITY_SQL} AS severity FROM msgs""")
def q_log_severity(spark, sf):
    return _messages(spark, sf).select("id", severity("message").alias("severity"))


@query("log_filter", f"""
WITH {_MESSAGES_SQL}
SELECT id, message, {_SEVERITY_SQL} AS severity FROM msgs WHERE contains(lower(message), 'lỗi')""")
def q_log_filter(spark, sf):
    return TL.log_view(_messages(spark, sf), keyword="  LỖI ").select("id", "message", "severity")


@query("log_retention", """
SELECT event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 1000""")
def q_log_retention(spark, sf):
    e = t(spark, sf, "events")
    return TL.retain_last(e, ["event_type"], ts="ts", tiebreak="event_id").select("event_id", "event_type")


@query("log_expiry", """
WITH last AS (SELECT user_id, max(ts) AS l FROM events GROUP BY user_id), a AS (SELECT max(ts) AS m FROM events)
SELECT e.event_id, e.user_id FROM events e JOIN last USING (user_id), a WHERE last.l >= a.m - INTERVAL 86400 SECOND""")
def q_log_expiry(spark, sf):
    e = t(spark, sf, "events")
    return TL.expire_keys(e, ["user_id"]).select("event_id", "user_id")


def _heartbeats(spark, sf) -> DataFrame:
    e = t(spark, sf, "events")
    return e.select(F.concat(F.lit("dev"), s("user_id")).alias("device_id"), F.upper("event_type").alias("status"),
                    F.col("props").alias("current_job"), F.col("ts").alias("last_seen"))


_LIVENESS_SQL = """
WITH hb AS (SELECT 'dev' || CAST(user_id AS VARCHAR) AS device_id, upper(event_type) AS status, props AS current_job, ts AS last_seen FROM events),
latest AS (SELECT * FROM hb QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY last_seen DESC, status DESC, current_job DESC NULLS LAST) = 1),
a AS (SELECT max(last_seen) AS m FROM hb)
SELECT device_id, strftime(last_seen, '%Y-%m-%d %H:%M:%S.%f') AS last_seen, last_seen >= a.m - INTERVAL 120 SECOND AS online,
       CASE WHEN last_seen >= a.m - INTERVAL 120 SECOND THEN status ELSE 'OFFLINE' END AS status,
       CASE WHEN last_seen >= a.m - INTERVAL 120 SECOND THEN current_job END AS current_job
FROM latest, a"""


@query("liveness", _LIVENESS_SQL)
def q_liveness(spark, sf):
    lv = TL.liveness(_heartbeats(spark, sf))
    return lv.withColumn("last_seen", ts_text("last_seen", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _file_events(spark, sf) -> DataFrame:
    e = t(spark, sf, "events")
    et = F.col("event_type")
    status = (F.when(et == "view", "pending").when(et == "click", "converting").when(et == "purchase", "completed")
              .when(et == "error", "error").otherwise("stopped"))
    return e.select(
        F.concat(F.lit("job"), s(F.col("user_id") % 7)).alias("job"),
        F.concat(F.lit("file"), s(F.col("user_id") % 30)).alias("file"),
        status.alias("status"), F.floor("value").cast("int").alias("progress"),
        F.when(status == "completed", F.concat(F.lit("/out/file"), s(F.col("user_id") % 30), F.lit(".parquet"))).alias("output"),
        F.col("ts").alias("ts"), "event_id")


_FILE_STATE_SQL = """
fe AS (SELECT 'job' || CAST(user_id % 7 AS VARCHAR) AS job, 'file' || CAST(user_id % 30 AS VARCHAR) AS file,
              CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'converting' WHEN 'purchase' THEN 'completed'
                              WHEN 'error' THEN 'error' ELSE 'stopped' END AS status,
              CAST(floor(value) AS INTEGER) AS progress, ts, event_id,
              CASE WHEN event_type = 'purchase' THEN '/out/file' || CAST(user_id % 30 AS VARCHAR) || '.parquet' END AS output
       FROM events),
latest AS (SELECT * FROM fe QUALIFY row_number() OVER (PARTITION BY job, file ORDER BY ts DESC, status DESC, progress DESC, output DESC NULLS LAST) = 1),
failed AS (SELECT job, bool_or(status = 'error') AS jf FROM latest GROUP BY job),
state AS (SELECT l.job, l.file, CASE WHEN f.jf AND l.status = 'converting' THEN 'error' ELSE l.status END AS status,
                 l.progress, l.output, l.ts FROM latest l JOIN failed f USING (job))"""


@query("file_state", f"""
WITH {_FILE_STATE_SQL}
SELECT job, file, status, progress, output, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM state""")
def q_file_state(spark, sf):
    st = TL.fold_file_state(_file_events(spark, sf))
    return st.withColumn("ts", ts_text("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("job_rollup", f"""
WITH {_FILE_STATE_SQL}
SELECT job, bool_or(status = 'converting') AS running, NOT bool_or(status = 'error') AS success,
       arg_min(file, ts) FILTER (WHERE status = 'error') AS first_error_file, count(*) AS files,
       count(*) FILTER (WHERE status = 'pending') AS n_pending, count(*) FILTER (WHERE status = 'converting') AS n_converting,
       count(*) FILTER (WHERE status = 'completed') AS n_completed, count(*) FILTER (WHERE status = 'error') AS n_error,
       count(*) FILTER (WHERE status = 'stopped') AS n_stopped, count(*) FILTER (WHERE status = 'missing') AS n_missing,
       count(*) FILTER (WHERE progress < 25) AS n_selected
FROM state GROUP BY job""")
def q_job_rollup(spark, sf):
    st = TL.fold_file_state(_file_events(spark, sf)).withColumn("selected", F.col("progress") < 25)
    return TL.job_rollup(st, "selected")


@query("runnable", f"""
WITH {_FILE_STATE_SQL}
SELECT job, file, status FROM state WHERE progress < 25 AND status IN ('pending', 'stopped', 'error')""")
def q_runnable(spark, sf):
    st = TL.fold_file_state(_file_events(spark, sf)).withColumn("selected", F.col("progress") < 25)
    return TL.runnable(st).select("job", "file", "status")


@query("since_last_run", """
WITH logs AS (SELECT event_id, 'job' || CAST(user_id % 7 AS VARCHAR) AS job, ts FROM events),
runs AS (SELECT 'job' || CAST(user_id % 7 AS VARCHAR) AS job, max(ts) AS started FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT l.event_id, l.job FROM logs l LEFT JOIN runs r USING (job) WHERE r.started IS NULL OR l.ts >= r.started""")
def q_since_last_run(spark, sf):
    e = t(spark, sf, "events")
    job = F.concat(F.lit("job"), s(F.col("user_id") % 7)).alias("job")
    logs = e.select("event_id", job, "ts")
    commands = e.select(F.when(F.col("event_type") == "signup", F.lit("RUN")).otherwise(F.lit("LOG")).alias("command"),
                        job, F.col("ts").alias("created_at"))
    return TL.since_last_run(logs, commands).select("event_id", "job")


# ------------------------------------------------------------- G1, K1, K2 ---

def _lineitem_ragged(spark, sf) -> DataFrame:
    li = t(spark, sf, "lineitem")
    bad = (F.col("l_linenumber") > 1) & (((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 53) == 0)
    base = [s("l_orderkey"), s("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus"), ts_text("l_shipdate", "yyyy-MM-dd")]
    fields = (F.when(bad & (F.col("l_orderkey") % 2 == 0), F.array(*base, F.lit("X")))
              .when(bad, F.array(*base[:4])).otherwise(F.array(*base)))
    return li.withColumns({"value": encode_csv(fields, ";"), "thousand": F.floor(F.col("l_orderkey") / 1000), "ragged": bad})


#: Line 1 of a file says how many fields its lines have, so none may be ragged: among the lines of
#: a thousand orders the ragged ones come last, and files are cut between thousands.
_RAGGED_ORDER = ["thousand", "ragged", "l_orderkey", "l_linenumber"]


_RAGGED_SQL = """(l_linenumber > 1 AND (l_orderkey * 7 + l_linenumber) % 53 = 0)"""


@query("arity_quarantine", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS orderkey, CAST(l_linenumber AS VARCHAR) AS linenumber, 5 AS expected,
       CASE WHEN l_orderkey % 2 = 0 THEN 6 ELSE 4 END AS found
FROM lineitem WHERE {_RAGGED_SQL}""")
def q_arity_quarantine(spark, sf):
    from quayside.plans.convert import profile_source

    root = land_ranges(spark, _lineitem_ragged(spark, sf), "value", _RAGGED_ORDER, "lineitem-ragged")
    feed = FEED_BY_KEY["STOCK_INTRANSIT"]
    prof = profile_source(spark, [root], feed)
    expected = prof.per_file.select("file", F.size("first").alias("expected"))
    _, bad = TB.split_by_arity(prof.lines, expected)
    return bad.select(F.split("value", ";")[0].alias("orderkey"), F.split("value", ";")[1].alias("linenumber"),
                      "expected", "found")


def _stream_landing(spark, sf) -> str:
    """Lineitem as STOCK_INTRANSIT files, among a backup copy, another feed's file and a note."""
    from quayside.plans.landing import land_file, land_named_files

    li = _lineitem_ragged(spark, sf).withColumn("bucket", (F.col("l_orderkey") / 15000).cast("bigint"))
    root = land_named_files(spark, li, "value", "bucket", _RAGGED_ORDER, "lineitem-landing",
                            lambda k: f"STOCK_INTRANSIT_{_stamp14(k)}.csv")
    few = t(spark, sf, "part").select("p_partkey", F.concat_ws(",", "p_name", "p_brand").alias("value"))
    for n, name in enumerate(("STOCK_INTRANSIT_20240101000000_bak.csv", "CLOSING_STOCK_20240101000000.csv", "notes.txt")):
        land_file(spark, few, "value", ["p_partkey"], f"foreign-{n}", name, root=root)
    return root


def _run_stream_ingest(spark, sf) -> tuple[str, str]:
    from quayside.streaming.ingest import start_ingest

    landing = _stream_landing(spark, sf)
    out, quarantine, ckpt = scratch_path(spark, "ingested"), scratch_path(spark, "quarantine"), scratch_path(spark, "ckpt")
    q = start_ingest(spark, landing, FEED_BY_KEY["STOCK_INTRANSIT"], out, quarantine, ckpt)
    q.awaitTermination()
    return out, quarantine


@query("stream_ingest", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS column1, CAST(l_linenumber AS VARCHAR) AS column2, l_returnflag AS column3,
       l_linestatus AS column4, strftime(l_shipdate, '%Y-%m-%d') AS column5
FROM lineitem WHERE NOT {_RAGGED_SQL}""")
def q_stream_ingest(spark, sf):
    from quayside.streaming.ingest import ingested_shapes, read_ingested

    out, _ = _run_stream_ingest(spark, sf)
    feed = FEED_BY_KEY["STOCK_INTRANSIT"]
    (shape,) = ingested_shapes(spark, out, feed)
    return read_ingested(spark, out, feed, shape).select("column1", "column2", "column3", "column4", "column5")


#: Triggers that a landing zone of many files is taken in.
_TRIGGERS = 16


@query("ingest_progress", f"""
WITH n AS (SELECT count(*) AS total, count(*) FILTER (WHERE {_RAGGED_SQL}) AS rejected FROM lineitem)
SELECT CAST(unnest(range(5000, total + 1, 5000)) AS BIGINT) AS mark, total, rejected, true AS rising FROM n""")
def q_ingest_progress(spark, sf):
    """D3 of a stream in some ``_TRIGGERS`` triggers (of one file each where there are no more): the
    marks passed, and running totals that only rise."""
    from quayside.plans.progress import marks
    from quayside.streaming.ingest import ingest_progress, start_ingest

    feed = FEED_BY_KEY["STOCK_INTRANSIT"]
    out, quarantine, ckpt = scratch_path(spark, "ingested"), scratch_path(spark, "quarantine"), scratch_path(spark, "ckpt")
    landing = _stream_landing(spark, sf)
    a_trigger = -(-catalog(spark, landing).count() // _TRIGGERS)
    start_ingest(spark, landing, feed, out, quarantine, ckpt, max_files_per_trigger=a_trigger).awaitTermination()
    batches = F.collect_list(F.struct("ingest_batch", "total"))  # a row per trigger
    in_order = F.transform(F.array_sort(batches), lambda b: b["total"])
    whole = ingest_progress(spark, out, feed).agg(
        F.max("total").alias("total"), F.sum("rejected").alias("rejected"), (in_order == F.array_sort(in_order)).alias("rising"))
    return marks(whole, "total", 5000).select("mark", "total", "rejected", "rising")


@query("stream_quarantine", f"""
SELECT CAST(l_orderkey AS VARCHAR) AS orderkey, 5 AS expected, CASE WHEN l_orderkey % 2 = 0 THEN 6 ELSE 4 END AS found
FROM lineitem WHERE {_RAGGED_SQL}""")
def q_stream_quarantine(spark, sf):
    from quayside.streaming.ingest import read_quarantined

    out, quarantine = _run_stream_ingest(spark, sf)
    return read_quarantined(spark, out, quarantine, FEED_BY_KEY["STOCK_INTRANSIT"]).select(F.split("value", ";")[0].alias("orderkey"), "expected", "found")


@query("stream_liveness", _LIVENESS_SQL)
def q_stream_liveness(spark, sf):
    from quayside.streaming.liveness import read_liveness, start_liveness

    landing = scratch_path(spark, "heartbeats")
    hb = _heartbeats(spark, sf).withColumn("day", F.to_date("last_seen"))
    hb.write.partitionBy("day").parquet(landing)
    table, ckpt = scratch_path(spark, "device-state"), scratch_path(spark, "ckpt")
    q = start_liveness(spark, landing, table, ckpt)
    q.awaitTermination()
    return read_liveness(spark, table).withColumn("last_seen", ts_text("last_seen", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("stream_transitions", _LIVENESS_SQL)
def q_stream_transitions(spark, sf):
    """K2 with timers: heartbeats by day, in several triggers; the newest transition of each device."""
    from quayside.streaming.transitions import device_states, read_transitions, start_transitions

    landing = scratch_path(spark, "heartbeats")
    _heartbeats(spark, sf).withColumn("day", F.to_date("last_seen")).write.partitionBy("day").parquet(landing)
    table, ckpt = scratch_path(spark, "transitions"), scratch_path(spark, "ckpt")
    days = spark.read.parquet(landing)
    start_transitions(spark, landing, table, ckpt, lateness_seconds=400 * 86400, max_files_per_trigger=20, schema=days.schema).awaitTermination()
    out = device_states(read_transitions(spark, table))
    return out.withColumn("last_seen", ts_text("last_seen", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


# ------------------------------------------- G1-G4, F4, I4, K1: planted cases ---

def _land_feed(spark, sf, table: str, key: str, fields: list, delim: str, name: str, bad=None, root: str | None = None, header: str | None = None) -> str:
    """A table as one file of a feed; rows where ``bad`` holds get one field more."""
    from quayside.functions.quoting import encode_columns
    from quayside.plans.landing import land_file

    line = encode_columns(fields, delim)
    if bad is not None:
        line = F.when(bad, F.concat(line, F.lit(f"{delim}extra"))).otherwise(line)
    df = t(spark, sf, table).withColumn("value", line)
    return land_file(spark, df, "value", [key], f"land-{table}", name, header=header, root=root)


def _order_fields() -> list:
    return [s("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")]


def _part_fields() -> list:
    return [s("p_partkey"), F.col("p_brand"), s("p_size")]


@query("convert_quarantine", """
SELECT '30D_SALES' AS feed, CAST(o_orderkey AS VARCHAR) AS key, o_orderkey % 7 = 3 AS rejected FROM orders
UNION ALL SELECT 'STOCK_INTRANSIT', CAST(p_partkey AS VARCHAR), p_partkey % 5 = 3 FROM part""")
def q_convert_quarantine(spark, sf):
    """G1 with two feeds and one quarantine: every line is in its output or its quarantine."""
    from quayside.plans.convert import convert

    out, aside = scratch_path(spark, "published"), scratch_path(spark, "quarantine")
    sales = _land_feed(spark, sf, "orders", "o_orderkey", _order_fields(), ";", "30D_SALES_20240101000000.csv", F.col("o_orderkey") % 7 == 3)
    stock = _land_feed(spark, sf, "part", "p_partkey", _part_fields(), ";", "STOCK_INTRANSIT_20240101000000.csv", F.col("p_partkey") % 5 == 3)
    for root, key in ((sales, "30D_SALES"), (stock, "STOCK_INTRANSIT")):
        convert(spark, root, out, key, strict=False, quarantine=aside)
    good = spark.read.parquet(out).select("feed", F.col("column1").alias("key"), F.lit(False).alias("rejected"))
    bad = spark.read.parquet(aside).select("feed", F.split("value", ";")[0].alias("key"), F.lit(True).alias("rejected"))
    return good.unionAll(bad)


@query("convert_progress", """
SELECT '30D_SALES' AS feed, 'done' AS state, count(*) AS rows, true AS rising FROM orders
UNION ALL SELECT 'STOCK_INTRANSIT', 'failed', CAST(0 AS BIGINT), true FROM part HAVING count(*) > 0""")
def q_convert_progress(spark, sf):
    """D3: the last progress row of a run that ends well and of one that does not; rows never fall on the way."""
    from quayside.plans.convert import run_selected
    from quayside.plans.progress import latest_progress, read_progress

    root, steps = scratch_path(spark, "zone"), scratch_path(spark, "progress")
    names = {"30D_SALES": "30D_SALES_20240101000000.csv", "STOCK_INTRANSIT": "STOCK_INTRANSIT_20240101000000.csv"}
    _land_feed(spark, sf, "orders", "o_orderkey", _order_fields(), ";", names["30D_SALES"], root=root)
    _land_feed(spark, sf, "part", "p_partkey", _part_fields(), ";", names["STOCK_INTRANSIT"], F.col("p_partkey") % 9 == 4, root=root)
    run_selected(spark, [(f"{root}/{n}", k) for k, n in names.items()], scratch_path(spark, "published"), progress=steps)
    rows = read_progress(spark, steps)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("seq", "rows"))), lambda r: r["rows"])
    rising = rows.where("state = 'running'").groupBy("run").agg((in_order == F.array_sort(in_order)).alias("rising"))
    return latest_progress(rows).join(rising, "run", "left").select(
        "feed", "state", F.when(F.col("state") == "done", F.col("rows")).otherwise(0).alias("rows"), F.coalesce("rising", F.lit(True)).alias("rising"))


@query("failed_convert", """
SELECT CAST(p_partkey AS VARCHAR) AS key, 'part' AS source, CAST(0 AS BIGINT) AS leftovers, true AS refused FROM part""")
def q_failed_convert(spark, sf):
    """a conversion that fails on a ragged line leaves the old output, and nothing else."""
    from quayside.plans.convert import convert
    from quayside.sources.catalog import catalog, catalog_changes

    out = scratch_path(spark, "published")
    old = _land_feed(spark, sf, "part", "p_partkey", _part_fields(), ";", "30D_SALES_20240101000000.csv")
    new = _land_feed(spark, sf, "orders", "o_orderkey", _order_fields(), ";", "30D_SALES_20240102000000.csv", F.col("o_orderkey") % 100 == 50)
    convert(spark, old, out, "30D_SALES")
    refused = False
    try:
        convert(spark, new, out, "30D_SALES")
    except Exception as exc:  # noqa: BLE001 - the refusal is the result
        refused = "wrong field count" in str(exc)
    inside = catalog(spark, out).filter(~F.col("path").contains("/feed=30D_SALES/") | F.col("path").contains("/_staging/"))
    left = inside.agg(F.count(F.lit(1)))
    return spark.read.parquet(out).select(F.col("column1").alias("key"), F.lit("part").alias("source")).withColumns(
        {"leftovers": left.scalar(), "refused": F.lit(refused)})


@query("refused_inputs", """
SELECT count(*) AS rows, true AS empty_file, true AS missing_file, true AS several_feeds, true AS no_quarantine FROM orders""")
def q_refused_inputs(spark, sf):
    """An empty file in a group, a path that is not there, files of two feeds, and records
    to take out without a place for them are refused; the good file alone converts."""
    from quayside.plans.convert import convert

    root = _land_feed(spark, sf, "orders", "o_orderkey", _order_fields(), ";", "30D_SALES_20240101000000.csv")
    good, out = f"{root}/30D_SALES_20240101000000.csv", scratch_path(spark, "published")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    empty = jvm.org.apache.hadoop.fs.Path(f"{root}/30D_SALES_20240102000000.csv")
    empty.getFileSystem(conf).create(empty).close()

    def refused(text: str, *args, **kw) -> bool:
        try:
            convert(spark, *args, **kw)
        except Exception as exc:  # noqa: BLE001 - the refusal is the result
            return text in str(exc)
        return False

    flags = {"empty_file": refused("no data in", [good, empty.toString()], out),
             "missing_file": refused("PATH_NOT_FOUND", [good, f"{root}/30D_SALES_20250101000000.csv"], out),
             "several_feeds": refused("several feeds", [good, f"{root}/SCCT_RAWDATA_LD_WMP_20240101.csv"], out),
             "no_quarantine": refused("quarantine", good, out, strict=False)}
    convert(spark, good, out)
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows")).withColumns({k: F.lit(v) for k, v in flags.items()})


@query("late_string", """
SELECT CAST(event_id AS VARCHAR) AS column0, CASE WHEN event_id = (SELECT max(event_id) FROM events) THEN 'abc' ELSE CAST(user_id AS VARCHAR) END AS column1,
       'bigint' AS type0, 'string' AS type1 FROM events""")
def q_late_string(spark, sf):
    """One late value that is no number widens its column to text, and fails nothing."""
    from quayside.plans.convert import convert

    last = t(spark, sf, "events").agg(F.max("event_id")).scalar()
    fields = [s("event_id"), F.when(F.col("event_id") == last, "abc").otherwise(s("user_id"))]
    root = _land_feed(spark, sf, "events", "event_id", fields, ",", "CLOSING_STOCK_20240101000000.csv")
    out = scratch_path(spark, "published")
    convert(spark, root, out, "CLOSING_STOCK")
    df = spark.read.parquet(out)
    types = dict(df.dtypes)
    return df.select(s("column0").alias("column0"), "column1", F.lit(types["column0"]).alias("type0"), F.lit(types["column1"]).alias("type1"))


@query("run_selected", """
SELECT '30D_SALES' AS feed, 'completed' AS status, count(*) AS published FROM orders
UNION ALL SELECT 'STOCK_INTRANSIT', 'error', CAST(0 AS BIGINT) UNION ALL SELECT 'SCCT', 'pending', CAST(0 AS BIGINT)""")
def q_run_selected(spark, sf):
    """I4: selected files in order, each published; the first error stops the rest."""
    from quayside.plans.convert import run_selected
    from quayside.sources.catalog import ensure_dir, path_exists

    root, target = scratch_path(spark, "zone"), ensure_dir(spark, scratch_path(spark, "serving"))
    _land_feed(spark, sf, "orders", "o_orderkey", _order_fields(), ";", "30D_SALES_20240101000000.csv", root=root)
    _land_feed(spark, sf, "part", "p_partkey", _part_fields(), ";", "STOCK_INTRANSIT_20240101000000.csv", F.col("p_partkey") % 9 == 4, root=root)
    _land_feed(spark, sf, "part", "p_partkey", _part_fields(), ",", "SCCT_RAWDATA_LD_WMP_20240101.csv", header="key,brand,size", root=root)
    names = {"30D_SALES": "30D_SALES_20240101000000.csv", "STOCK_INTRANSIT": "STOCK_INTRANSIT_20240101000000.csv", "SCCT": "SCCT_RAWDATA_LD_WMP_20240101.csv"}
    states = run_selected(spark, [(f"{root}/{n}", k) for k, n in names.items()], scratch_path(spark, "published"), target)
    out = None
    for st in states:
        row = (spark.read.parquet(f"{target}/feed={st['feed']}") if path_exists(spark, f"{target}/feed={st['feed']}") else spark.range(0)).agg(
            F.count(F.lit(1)).alias("published")).select(F.lit(st["feed"]).alias("feed"), F.lit(st["status"]).alias("status"), "published")
        out = row if out is None else out.unionAll(row)
    return out


@query("row_origin", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, row_number() OVER (ORDER BY o_orderkey) AS line_no,
       '30D_SALES_20240203040506.csv' AS file, '2024-02-03 04:05:06' AS stamp, '30D_SALES_20240203040506.parquet' AS output, CAST(1 AS BIGINT) AS old_outputs
FROM orders""")
def q_row_origin(spark, sf):
    """An output row knows its file, line and stamp, and the published feed its source."""
    from quayside.plans.convert import convert

    name, out = "30D_SALES_20240203040506.csv", scratch_path(spark, "published")
    convert(spark, _land_feed(spark, sf, "orders", "o_orderkey", _order_fields(), ";", name), out, "30D_SALES")
    listed = S.published_outputs(spark, out)
    latest = S.latest_by_mtime(listed).join(S.old_output_count(listed), "feed").select("feed", F.col("name").alias("output"), "old_outputs")
    rows = with_line_numbers(spark, f"{out}/feed=30D_SALES").select(
        F.lit("30D_SALES").alias("feed"), F.col("column1").alias("key"), F.col("_line_no").alias("line_no"),
        F.regexp_extract("_file", "[^/]*$", 0).alias("file"), ts_text("_stamp").alias("stamp"))
    return rows.join(F.broadcast(latest), "feed").drop("feed")  # a row per feed; by a shuffle all rows would meet in one task


@query("source_output_diff", """
WITH x AS (SELECT o_orderkey % 10 = 4 AS status, o_orderkey % 15 = 7 AS gone FROM orders)
SELECT count(*) FILTER (WHERE gone) AS missing_right, count(*) FILTER (WHERE gone OR status) AS rows_differ,
       count(*) FILTER (WHERE status AND NOT gone) AS status_differs FROM x""")
def q_source_output_diff(spark, sf):
    """E3 of landed text against its converted table, whole, by file and line, with planted changes."""
    from quayside.plans.convert import convert, profile_source

    out = scratch_path(spark, "published")
    root = _land_feed(spark, sf, "orders", "o_orderkey", _order_fields(), ";", "30D_SALES_20240101000000.csv")
    convert(spark, root, out, "30D_SALES")
    left = TB.to_table_positional(profile_source(spark, [root], FEED_BY_KEY["30D_SALES"], widest=False).lines, 3, keep=["file", "line_no"])
    key = F.col("column1").cast("bigint")
    right = with_line_numbers(spark, f"{out}/feed=30D_SALES").filter(key % 15 != 7).withColumn("column2", F.when(key % 10 == 4, "?").otherwise(F.col("column2")))
    right = right.withColumnsRenamed({"_file": "file", "_line_no": "line_no"})
    diff = A.table_diff(left, right, ["file", "line_no"], ["column1", "column2", "column3"])
    return diff.filter(F.col("column") == "column2").select("missing_right", "rows_differ", F.col("value_diff").alias("status_differs"))


def _ingest(spark, landing: str, key: str) -> str:
    from quayside.streaming.ingest import start_ingest

    out = scratch_path(spark, "ingested")
    start_ingest(spark, landing, FEED_BY_KEY[key], out, scratch_path(spark, "quarantine"), scratch_path(spark, "ckpt")).awaitTermination()
    return out


@query("stream_two_headers", """
SELECT CAST(p_partkey AS VARCHAR) AS key, p_brand AS brand, CASE WHEN p_partkey % 2 = 0 THEN 'key,brand' ELSE 'id,make' END AS header FROM part""")
def q_stream_two_headers(spark, sf):
    """K1: two files of one width and different headers in one micro-batch are two tables."""
    from quayside.plans.landing import land_file
    from quayside.sources.catalog import catalog, catalog_changes

    root = scratch_path(spark, "zone")
    for i, header in enumerate(("key,brand", "id,make")):
        p = t(spark, sf, "part").filter(F.col("p_partkey") % 2 == i).withColumn("value", F.concat_ws(",", "p_partkey", "p_brand"))
        land_file(spark, p, "value", ["p_partkey"], f"two-{i}", f"SCCT_RAWDATA_LD_WMP_2024010{i + 1}.csv", header=header, root=root)
    out = _ingest(spark, root, "SCCT")
    folders = catalog(spark, out).select(F.regexp_extract("path", "^(.*/shape=[^/]*)/", 1).alias("d")).filter("d <> ''").distinct().collect()  # one a shape
    rows = None
    for r in folders:
        df = spark.read.parquet(r["d"])
        names = [c for c in df.columns if c in ("key", "brand", "id", "make")]
        part = df.select(F.col(names[0]).alias("key"), F.col(names[1]).alias("brand"), F.lit(",".join(names)).alias("header"))
        rows = part if rows is None else rows.unionAll(part)
    return rows


@query("stream_typed", """
SELECT event_id AS column0, strftime(ts, '%Y-%m-%d') AS column1, value AS column2, 'bigint,date,double' AS types FROM events""")
def q_stream_typed(spark, sf):
    """K1 = I1: a feed of inferred types gets them in the stream too."""
    root = _land_feed(spark, sf, "events", "event_id", [s("event_id"), ts_text("ts", "yyyy-MM-dd"), money("value")], ",", "CLOSING_STOCK_20240101000000.csv")
    df = spark.read.parquet(f"{_ingest(spark, root, 'CLOSING_STOCK')}/n=3")
    kinds = dict(df.dtypes)
    return df.select("column0", ts_text("column1", "yyyy-MM-dd").alias("column1"), "column2", F.lit(",".join(kinds[f"column{i}"] for i in range(3))).alias("types"))


@query("header_promotion_mixed", """
SELECT c_custkey // 500 AS bucket, CAST(c_custkey AS VARCHAR) AS product_id, printf('%.2f', c_acctbal) AS revenue FROM customer""")
def q_header_promotion_mixed(spark, sf):
    """C9 file by file: only every other file brings the header, with odd white space around a name."""
    from quayside.plans.landing import land_buckets

    c = t(spark, sf, "customer").withColumn("bucket", (F.col("c_custkey") / 500).cast("bigint"))
    fields = F.array(F.lit("2024-01-01"), s("c_nationkey"), s("c_custkey"), F.col("c_mktsegment"), F.lit("1"), money("c_acctbal"), F.lit("0"), F.lit("VND"))
    c = c.withColumn("value", encode_csv(fields, ","))
    parts = []
    for i, header in enumerate((_BUSINESS_HEADER_LINE.replace("Store_ID", "\u00a0Store_ID\u2003"), None)):
        root = land_buckets(spark, c.filter(F.col("bucket") % 2 == i), "value", "bucket", ["c_custkey"], f"customer-mixed-{i}", header=header)
        parts.append(read_numbered_lines(spark, root, recursive=True))
    table = TB.to_table_positional(TB.parse(parts[0].unionAll(parts[1]), ","), 8, keep=["file", "line_no"])
    out = TB.promote_header(table)
    return out.select(F.regexp_extract("file", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket"), "product_id", "revenue")


@query("ratio_ties", """
SELECT p_partkey AS part, CAST(1665 AS BIGINT) * p_size AS p, CAST(30000 AS BIGINT) * p_size AS c, 94.5::DOUBLE AS ratio FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, CAST(10486 AS BIGINT) * p_size, CAST(28000 AS BIGINT) * p_size, 62.5::DOUBLE FROM part WHERE p_partkey % 3 = 1
UNION ALL SELECT p_partkey, CAST(1397 AS BIGINT) * p_size, CAST(2000 AS BIGINT) * p_size, 30.1::DOUBLE FROM part WHERE p_partkey % 3 = 2""")
def q_ratio_ties(spark, sf):
    """B9 where the printed value is a tie and the stored one is not, at the sizes of every part."""
    third = F.col("p_partkey") % 3
    p = F.when(third == 0, 1665).when(third == 1, 10486).otherwise(1397).cast("bigint") * F.col("p_size")
    c = F.when(third == 0, 30000).when(third == 1, 28000).otherwise(2000).cast("bigint") * F.col("p_size")
    x = t(spark, sf, "part").select(F.col("p_partkey").alias("part"), p.alias("p"), c.alias("c"))
    return x.withColumn("ratio", compression_ratio("p", "c"))


@query("job_failure", f"""
WITH {_FILE_STATE_SQL.replace("failed AS (SELECT job, bool_or(status = 'error') AS jf", "failed AS (SELECT job, bool_or(status = 'error') OR job IN ('job1', 'job4') AS jf")}
SELECT job, file, status FROM state""")
def q_job_failure(spark, sf):
    """J4 with job results: a failed job turns its converting files into errors."""
    results = t(spark, sf, "events").select(F.concat(F.lit("job"), s(F.col("user_id") % 7)).alias("job")).distinct()
    results = results.withColumn("failed", F.col("job").isin("job1", "job4"))
    return TL.fold_file_state(_file_events(spark, sf), results).select("job", "file", "status")


@query("since_run_all", """
WITH logs AS (SELECT event_id, 'job' || CAST(user_id % 7 AS VARCHAR) AS job, ts FROM events),
runs AS (SELECT 'job' || CAST(user_id % 7 AS VARCHAR) AS job, max(ts) AS started FROM events WHERE event_type = 'signup' GROUP BY 1),
whole AS (SELECT max(ts) AS started FROM events WHERE event_type = 'purchase' AND event_id % 10 = 3)
SELECT l.event_id, l.job FROM logs l LEFT JOIN runs r USING (job), whole w
WHERE l.ts >= coalesce(greatest(r.started, w.started), r.started, w.started, l.ts)""")
def q_since_run_all(spark, sf):
    """J6 with RUN_ALL commands, which name no job."""
    e = t(spark, sf, "events")
    job = F.concat(F.lit("job"), s(F.col("user_id") % 7))
    whole = (F.col("event_type") == "purchase") & (F.col("event_id") % 10 == 3)
    commands = e.select(F.when(F.col("event_type") == "signup", "RUN").when(whole, "RUN_ALL").otherwise("LOG").alias("command"),
                        F.when(~whole, job).alias("job"), F.col("ts").alias("created_at"))
    return TL.since_last_run(e.select("event_id", job.alias("job"), "ts"), commands).select("event_id", "job")


@query("log_retention_5000", """
SELECT event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 5000""")
def q_log_retention_5000(spark, sf):
    e = t(spark, sf, "events")
    return TL.retain_last(e, ["event_type"], n=5000, ts="ts", tiebreak="event_id").select("event_id", "event_type")
