"""Audit of source against output: C6 preview, C7/C8 blank and header rows,
D1/D2 statistics, E1 integrity, E2 preview diff, E3 whole-table diff.

Statistics are grouped by a few keys (file, feed) with partial aggregation,
so a file that holds a third of all rows still sends one row per task to the
shuffle. Diffs join on a unique position key: no key is hot.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions.quoting import is_blank_line, is_blank_parsed, n_fields
from quayside.functions.scalars import comparable_equal, comparable_number, size_label
from quayside.operators.origin import first_rows

PREVIEW_ROWS = 20
#: Blocks that two tables are compared by before rows are: digests of 48 bytes, so a few hundred KB a task.
DIFF_BLOCKS = 4096


def _keys(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def csv_stats(parsed: DataFrame, keys: str | list[str] = "file", has_header: bool = False,
              size_col: str | None = "file_size") -> DataFrame:
    """Per file, non-blank records (less the header), widest record, bytes."""
    k = _keys(keys)
    nonblank = ~is_blank_parsed()
    aggs = [
        F.count_if(nonblank).alias("_rows"),
        F.coalesce(F.max(F.when(nonblank, n_fields())), F.lit(0)).alias("columns"),
    ]
    if size_col:
        aggs.append(F.max(size_col).alias("size"))
    out = parsed.groupBy(*k).agg(*aggs)
    rows = F.greatest(F.col("_rows") - F.lit(1), F.lit(0)) if has_header else F.col("_rows")
    out = out.withColumn("rows", rows.cast("bigint")).drop("_rows")
    if size_col:
        out = out.withColumn("size_label", size_label("size"))
    return out


def csv_preview(parsed: DataFrame, keys: str | list[str] | None = "file", has_header: bool = False,
                n: int = PREVIEW_ROWS, order: str = "line_no") -> DataFrame:
    """The first ``n`` non-blank *data* records by ``order`` (the
    header is skipped, so both sides show ``n`` data rows).

    With keys: per key, ``row_number() <= k`` (a partial top-k per task before
    the shuffle). Without keys: one global ``orderBy().limit()``
    (TakeOrderedAndProject: each task keeps its own top ``n``)."""
    nonblank = parsed.filter(~is_blank_parsed())
    if not keys:
        if has_header:
            nonblank = nonblank.filter(F.col("line_no") > 1)
        top = nonblank.select(order, "line_no", "fields").orderBy(order).limit(n)
        return top.select(F.row_number().over(Window.orderBy(order)).alias("row"), "line_no", "fields")
    k = _keys(keys)
    skip = 1 if has_header else 0
    w = Window.partitionBy(*k).orderBy(order)
    ranked = nonblank.select(*k, order, "line_no", "fields").withColumn("_rn", F.row_number().over(w))
    return ranked.filter((F.col("_rn") > skip) & (F.col("_rn") <= n + skip)).select(
        *k, (F.col("_rn") - F.lit(skip)).alias("row"), "line_no", "fields"
    )


def first_data_rows(numbered: DataFrame, feed, n: int = PREVIEW_ROWS) -> list[list[str]]:
    """C6/C7/C8 for one conversion: the first ``n`` non-blank data records by file and line, as
    lists (bounded: ``n`` rows reach the driver). Each task keeps its own first ``n`` raw lines;
    only the lines that remain are split, so the answer depends on no plan and no file layout."""
    from quayside.operators.tables import parse

    rows = numbered.filter(~is_blank_line("value"))
    if feed.has_header:
        rows = rows.filter(F.col("line_no") > 1)
    top = rows.select("file", "line_no", "value").orderBy("file", "line_no").limit(n)
    return [list(r["fields"]) for r in
            parse(top, feed.delimiter, feed.repair_dangling_quote).select("file", "line_no", "fields").orderBy("file", "line_no").collect()]


def first_output_rows(spark: SparkSession, folder: str, data_columns: list[str], n: int = PREVIEW_ROWS) -> list[list[str]]:
    """C6 on the Parquet side: the first ``n`` rows of a converted table by source file and line."""
    top = first_rows(spark, folder, n)
    rows = top.select("_file", "_split", "_rid", as_string_fields(top, data_columns).alias("fields")).orderBy("_file", "_split", "_rid")
    return [list(r["fields"]) for r in rows.collect()]


def preview_literal(rows: list[list[str]]) -> Column:
    """A bounded preview as an ``ARRAY<ARRAY<STRING>>`` literal."""
    if not rows:
        return F.array().cast("array<array<string>>")
    return F.array(*[F.array(*[F.lit(v).cast("string") for v in r]).cast("array<string>") if r
                     else F.array().cast("array<string>") for r in rows])


def as_string_fields(df: DataFrame, columns: list[str]) -> Column:
    """A typed row as the ``ARRAY<STRING>`` shown in the preview."""
    return F.array(*[F.col(c).cast("string") for c in columns])


def parquet_stats(spark: SparkSession, path: str) -> DataFrame:
    """Per Parquet file: rows (no data column is read), columns, bytes."""
    df = spark.read.parquet(path)
    n_cols = len(df.columns)
    return (
        df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size"))
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("size"))
        .withColumn("columns", F.lit(n_cols))
        .withColumn("size_label", size_label("size"))
    )


def parquet_preview(df: DataFrame, data_columns: list[str], keys: list[str] | None = None,
                    n: int = PREVIEW_ROWS) -> DataFrame:
    """C6 on the Parquet side: first ``n`` rows in file order (part file name,
    then row index inside the file), as ``ARRAY<STRING>`` rows. Part files
    are numbered by write task, and tasks follow the source scan order."""
    k = keys or []
    ordered = df.select(
        *k, F.col("_metadata.file_name").alias("_fn"), F.col("_metadata.row_index").alias("_ri"),
        as_string_fields(df, data_columns).alias("fields"),
    )
    if not k:
        top = ordered.orderBy("_fn", "_ri").limit(n)
        return top.select(F.row_number().over(Window.orderBy("_fn", "_ri")).alias("row"), "fields")
    w = Window.partitionBy(*k).orderBy("_fn", "_ri")
    return ordered.withColumn("row", F.row_number().over(w)).filter(F.col("row") <= n).select(*k, "row", "fields")


def integrity(csv: DataFrame, parquet: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows and columns of source and output, matched per key (full outer:
    a file on one side only is reported, with NULLs on the other)."""
    k = _keys(keys)
    c = csv.select(*k, F.col("rows").alias("csv_rows"), F.col("columns").cast("bigint").alias("csv_columns"))
    p = parquet.select(*k, F.col("rows").alias("parquet_rows"), F.col("columns").cast("bigint").alias("parquet_columns"))
    j = c.join(p, k, "full_outer")
    return j.select(
        *k, "csv_rows", "parquet_rows", "csv_columns", "parquet_columns",
        F.col("csv_rows").eqNullSafe(F.col("parquet_rows")).alias("rows_match"),
        F.col("csv_columns").eqNullSafe(F.col("parquet_columns")).alias("columns_match"),
    )


def _row_differs(a: Column, b: Column) -> Column:
    """E2 rule: lengths differ, or any position has unequal comparable values."""
    a0 = F.coalesce(a, F.array().cast("array<string>"))
    b0 = F.coalesce(b, F.array().cast("array<string>"))
    pair = F.zip_with(a0, b0, lambda x, y: ~comparable_equal(x, y))
    return (F.size(a0) != F.size(b0)) | F.exists(pair, lambda d: d)


def preview_diff(csv_rows: DataFrame, parquet_rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows aligned by position ``row``; a missing row counts as different.
    Returns per key: compared rows and rows that differ."""
    k = keys or []
    j = csv_rows.select(*k, "row", F.col("fields").alias("a")).join(
        parquet_rows.select(*k, "row", F.col("fields").alias("b")), k + ["row"], "full_outer")
    out = j.groupBy(*k).agg(
        F.count(F.lit(1)).alias("rows_compared"),
        F.count_if(_row_differs(F.col("a"), F.col("b"))).alias("rows_differ"),
    )
    return out


def block_digests(df: DataFrame, keys: list[str], columns: list[str], blocks: int = DIFF_BLOCKS) -> DataFrame:
    """Per block of rows (by the hash of their keys) the row count and an order-independent digest
    of 128 bits: the sums of the halves of two hashes over keys and cells (NULL as '', as the diff
    compares them). Every task sends one fixed-width row per block. Rows with a NULL key, which
    match nothing, are block -1."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*keys, *columns)]
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    rows = df.select(F.when(no_key, F.lit(-1)).otherwise(F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")).alias("block"),
                     F.xxhash64(*cells).alias("h0"), F.xxhash64(F.lit("second"), *reversed(cells)).alias("h1"))
    halves = [F.sum(half).alias(f"{h}_{i}") for h in ("h0", "h1")
              for i, half in enumerate((F.col(h).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)))]
    return rows.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), *halves)


def differing_blocks(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], blocks: int = DIFF_BLOCKS) -> DataFrame:
    """``DF[block]`` of the blocks whose digests differ, or that hold rows without a key."""
    a, b = (block_digests(df, keys, columns, blocks) for df in (left, right))
    facts = [c for c in a.columns if c != "block"]
    both = a.withColumnsRenamed({c: f"l_{c}" for c in facts}).join(b.withColumnsRenamed({c: f"r_{c}" for c in facts}), "block", "full_outer")
    same = reduce(and_, [F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in facts])
    return both.filter(~same | (F.col("block") < 0)).select("block")


def table_diff(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str] | None = None,
               blocks: int = DIFF_BLOCKS) -> DataFrame:
    """The E2 rule over whole tables aligned on ``keys`` (unique; of the same type on both
    sides), with per-column counts of lexical and of numeric mismatches.

    First both sides are reduced to digests of ``blocks`` blocks of rows; only blocks whose digests
    differ are joined (a sort-merge full outer join), so equal tables move digests and nothing else.
    Where more than half of the blocks differ, whole tables are joined.

    One output row per column: ``column, lexical_diff, value_diff`` plus the
    table-level ``missing_left``, ``missing_right``, ``rows_differ``."""
    compared = columns or [c for c in left.columns if c not in keys]
    differ = [r["block"] for r in differing_blocks(left, right, keys, compared, blocks).collect()]  # <= blocks + 1 numbers
    if 2 * len(differ) <= blocks:
        of_key = F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")
        kept = of_key.isin(*[b for b in differ if b >= 0]) if differ and max(differ) >= 0 else F.lit(False)
        if -1 in differ:
            kept = reduce(or_, [F.col(k).isNull() for k in keys], kept)
        left, right = left.filter(kept), right.filter(kept)
    return joined_diff(left, right, keys, compared)


def joined_diff(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """``table_diff`` by the full join alone."""
    cols = columns or [c for c in left.columns if c not in keys]
    lsel = left.select(*keys, *[F.col(c).cast("string").alias(f"l_{i}") for i, c in enumerate(cols)], F.lit(True).alias("_l"))
    rsel = right.select(*keys, *[F.col(c).cast("string").alias(f"r_{i}") for i, c in enumerate(cols)], F.lit(True).alias("_r"))
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    pairs = [(F.col(f"l_{i}"), F.col(f"r_{i}")) for i in range(len(cols))]
    # the comparison stands in the plan once, for an array of cells, whatever the number of columns
    cells = F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in pairs])
    equal = lsel.join(rsel, keys, "full_outer").select("*", F.transform(cells, lambda p: comparable_equal(p["a"], p["b"])).alias("_eq"))
    marks = equal.select(
        "_l", "_r", *[(both & (F.coalesce(a, F.lit("")) != F.coalesce(b, F.lit("")))).alias(f"lex_{i}") for i, (a, b) in enumerate(pairs)],
        *[(both & ~F.get("_eq", F.lit(i))).alias(f"val_{i}") for i in range(len(cols))])
    counted = [f"{kind}_{i}" for kind in ("lex", "val") for i in range(len(cols))]
    totals = marks.agg(
        F.count_if(F.col("_l").isNull()).alias("missing_left"), F.count_if(F.col("_r").isNull()).alias("missing_right"),
        *[F.count_if(F.col(c)).alias(c) for c in counted],
        F.count_if(reduce(or_, [F.col(f"val_{i}") for i in range(len(cols))], ~both)).alias("rows_differ"))
    stack = ", ".join(f"'{c}', lex_{i}, val_{i}" for i, c in enumerate(cols))
    return totals.select(
        "missing_left", "missing_right", "rows_differ",
        F.expr(f"stack({len(cols)}, {stack}) AS (column, lexical_diff, value_diff)"),
    )


def numeric_equal(a: Column, b: Column) -> Column:
    """B10 split in two: numeric equality (``007`` = ``7``) reported apart from
    lexical equality so lost leading zeros stay visible."""
    return comparable_number(a).eqNullSafe(comparable_number(b))
