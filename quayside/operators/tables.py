"""Parsed records -> tables: A5 positional, A6 header, A7 inferred types,
B4 empty -> NULL, C8/C9 header handling, G1/G2 strict shape, H1-H3 schema.

Driver round trips are limited to what a schema needs: the field count or the
header of each file (one row per file) and, for inference, one aggregate row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.quoting import TOKENS, field, field_tokens, fields_of_parsed, n_fields
from quayside.functions.scalars import js_trim
from quayside.session import materialize

#: Start of the message of a record that does not fit the shape of its table.
WRONG_COUNT = "wrong field count in"
# one row per file, a path of about 200 bytes; beyond it the join is a shuffle, with the same result
FILE_BROADCAST_MAX_ROWS = 50_000


# ---------------------------------------------------------------- parsing ---

def parse(lines: DataFrame, delim: str, repair: bool = True, value_col: str = "value") -> DataFrame:
    """B1/B2 over a line table: adds the field tokens of each line (one regex
    pass; the hot path reads field counts and cells from them) and ``fields
    ARRAY<STRING>`` (computed only where a plan actually uses it; column
    pruning drops it elsewhere)."""
    out = lines.withColumn(TOKENS, field_tokens(F.col(value_col), delim, repair))
    return out.withColumn("fields", fields_of_parsed())


# ------------------------------------------------------------ names (H3) ---

def positional_names(n: int, base: int = 1, pad: bool = False) -> list[str]:
    """H3: ``column1..columnN`` (declared) or zero-padded ``column0..`` (inferred)."""
    width = len(str(base + n - 1)) if pad else 0
    return [f"column{str(i).zfill(width)}" for i in range(base, base + n)]


def fix_header_names(raw: list[str]) -> list[str]:
    """Empty names become ``columnK`` (K = 0-based position, padded as
    inferred names are); repeated names get ``_1``, ``_2`` ... suffixes."""
    fallback = positional_names(len(raw), base=0, pad=True)
    out: list[str] = []
    used: set[str] = set()
    for i, name in enumerate(raw):
        candidate = name if name != "" else fallback[i]
        if candidate in used:
            k = 1
            while f"{candidate}_{k}" in used:
                k += 1
            candidate = f"{candidate}_{k}"
        used.add(candidate)
        out.append(candidate)
    return out


# ------------------------------------------------------- shape (G1, G2) ---

def first_records(parsed: DataFrame) -> DataFrame:
    """H2: ``DF[file, fields]`` of line 1 of every file (a filter: no line is
    aggregated, and only the kept lines build their fields array)."""
    return parsed.filter(F.col("line_no") == 1).select("file", fields_of_parsed().alias("fields"))


def file_arity(parsed: DataFrame) -> DataFrame:
    """H2: ``DF[file, expected]`` = field count of line 1 of each file."""
    return parsed.filter(F.col("line_no") == 1).select("file", n_fields().alias("expected"))


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= FILE_BROADCAST_MAX_ROWS else df


@dataclass
class Shape:
    """What the driver learns about a file group before building its table."""

    expected: int
    header: list[str] | None = None


def group_shapes(parsed: DataFrame, has_header: bool = False, most: int = 2) -> list[Shape]:
    """The distinct shapes (field count of line 1[, header]) of a file group, at most ``most``:
    the default is enough to tell one from several, whatever the number of files."""
    cols = [F.size("fields").alias("n")] + ([F.col("fields").alias("h")] if has_header else [])
    rows = first_records(parsed).select(*cols).distinct().orderBy("n").limit(most).collect()
    return [Shape(r["n"], list(r["h"]) if has_header else None) for r in rows]


def one_shape(parsed: DataFrame, has_header: bool = False) -> Shape:
    """The shape that all files of a group share."""
    found = group_shapes(parsed, has_header)
    if not found:
        raise ValueError("no data")
    if len(found) > 1:
        raise ValueError("files disagree on their first line: convert them as separate groups")
    return found[0]


def arity_error(expected: Column | int) -> Column:
    exp = F.lit(expected) if isinstance(expected, int) else expected
    return F.raise_error(F.concat(
        F.lit(f"{WRONG_COUNT} "), F.col("file"), F.lit(" at line "), F.col("line_no").cast("string"),
        F.lit(": expected "), exp.cast("string"), F.lit(", found "), n_fields().cast("string"),
    ))


def shape_ok(expected: int) -> Column:
    """G1 (fail): true, or a task failure naming file and line."""
    return F.when(n_fields() == F.lit(expected), F.lit(True)).otherwise(arity_error(expected))


def split_by_arity(parsed: DataFrame, expected: int | DataFrame) -> tuple[DataFrame, DataFrame]:
    """G1 (quarantine): ``(good, rejected)`` from one predicate.

    ``expected`` is one field count, or ``DF[file, expected]`` (one row per file,
    joined by broadcast when its size allows)."""
    if isinstance(expected, int):
        tagged = parsed.withColumn("expected", F.lit(expected))
    else:
        if not hasattr(expected, "path_"):  # counted and joined: written once
            expected = materialize(expected, "expected")
        tagged = parsed.join(_maybe_broadcast(expected, expected.count()), "file")
    ok = n_fields() == F.col("expected")
    good = tagged.filter(ok).drop("expected")
    bad = tagged.filter(~ok).select(
        "file", "line_no", F.col("expected").cast("int").alias("expected"),
        n_fields().alias("found"), F.col("value"),
    )
    return good, bad


# ---------------------------------------------------------- tables (A5-A7) ---

def _cells(n: int) -> list[Column]:
    """Field ``i`` with empty -> NULL."""
    return [F.nullif(field(i), F.lit("")) for i in range(n)]


def _checked(parsed: DataFrame, n: int, strict: bool) -> DataFrame:
    """G1 (fail): one row predicate that is true or raises, naming file and
    line. Kept apart from the cells so they stay plain expressions."""
    return parsed.filter(shape_ok(n)) if strict else parsed


def to_table_positional(parsed: DataFrame, expected: int, base: int = 1, pad: bool = False,
                        strict: bool = True, keep: list[str] | None = None) -> DataFrame:
    """A5: all-string table ``column1..columnN``; strict: any other field count
    fails the job with the file and line in the message (G1)."""
    names = positional_names(expected, base=base, pad=pad)
    cols = [c.alias(nm) for c, nm in zip(_cells(expected), names)]
    return _checked(parsed, expected, strict).select(*(keep or []), *cols)


def to_table_header(parsed: DataFrame, header: list[str], strict: bool = True,
                    keep: list[str] | None = None) -> DataFrame:
    """Names from line 1 (fixed up), line 1 dropped, all strings."""
    names = fix_header_names(header)
    body = _checked(parsed.filter(F.col("line_no") > 1), len(names), strict)
    cols = [c.alias(nm) for c, nm in zip(_cells(len(names)), names)]
    return body.select(*(keep or []), *cols)


def checked(n: int, column: Column, kind: str) -> Column:
    """G1 as part of a column that is always written: it is that column, or a task failure naming
    file and line. (A filter would move below the split and split every line twice.)"""
    return F.when(n_fields() == F.lit(n), column).otherwise(arity_error(n).cast(kind))


def to_table_named(parsed: DataFrame, names: list[str], keep: list[Column]) -> DataFrame:
    """All-string table with the given names, of records that hold no header; ``keep`` has the check."""
    return parsed.select(*keep, *[c.alias(nm) for c, nm in zip(_cells(len(names)), names)])


# Type ladder for A7, most specific first. TIME is detected but kept as text.
_INT = "^[+-]?(0|[1-9][0-9]*)$"
_DEC = "^[+-]?(?:(?:0|[1-9][0-9]*)(?:\\.[0-9]*)?|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_TIME = "^(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?:\\.[0-9]{1,6})?$"
_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TS = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\\.[0-9]{1,6})?$"

TYPE_LADDER = ["boolean", "bigint", "double", "time", "date", "timestamp_ntz"]


def _fits(v: Column, t: str) -> Column:
    if t == "boolean":
        return F.lower(v).isin("true", "false")
    if t == "bigint":
        return v.rlike(_INT) & v.try_cast("bigint").isNotNull()
    if t == "double":
        return v.rlike(_DEC) & v.try_cast("double").isNotNull()
    if t == "time":
        return v.rlike(_TIME)
    if t == "date":
        return v.rlike(_DATE) & F.try_to_date(v, "yyyy-MM-dd").isNotNull()
    if t == "timestamp_ntz":
        return v.rlike(_TS) & v.try_cast("timestamp_ntz").isNotNull()
    raise ValueError(t)


_CODE = {t: 1 << i for i, t in enumerate(TYPE_LADDER)}
_STRING_BIT = 1 << len(TYPE_LADDER)


def value_type_bit(v: Column) -> Column:
    """The narrowest ladder type one value fits, as a bit (a short-circuit
    CASE: most values are settled by their first check); NULL stays NULL."""
    expr = None
    for t in TYPE_LADDER:
        expr = F.when(_fits(v, t), F.lit(_CODE[t])) if expr is None else expr.when(_fits(v, t), F.lit(_CODE[t]))
    return F.when(v.isNotNull(), expr.otherwise(F.lit(_STRING_BIT)))


def type_from_bits(mask: int | None) -> str:
    """Column type from the OR of its value bits: the narrowest ladder type
    every value fits (integers widen to double), else string."""
    if not mask:
        return "string"
    for t, allowed in [("boolean", {"boolean"}), ("bigint", {"bigint"}), ("double", {"bigint", "double"}),
                       ("time", {"time"}), ("date", {"date"}), ("timestamp_ntz", {"timestamp_ntz"})]:
        bits = sum(_CODE[a] for a in allowed)
        if mask & ~bits == 0:
            return "string" if t == "time" else t
    return "string"


def infer_types(table: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """One aggregate over the whole table (partial per task, one row out):
    per column, the bitwise OR of the value type bits (a hash aggregate).

    A column gets the narrowest ladder type all non-NULL values fit; no value
    or no common type -> string (a late ``abc`` widens to string instead of
    failing, G4). ``007`` is string (leading zeros kept); TIME stays string."""
    cols = columns or table.columns
    aggs = [F.bit_or(value_type_bit(F.col(c))).alias(f"m{i}") for i, c in enumerate(cols)]
    row = table.agg(*aggs).collect()[0]
    return {c: type_from_bits(row[f"m{i}"]) for i, c in enumerate(cols)}


def cast_column(v: Column, t: str) -> Column:
    if t == "string":
        return v
    if t == "boolean":
        return F.lower(v) == F.lit("true")
    if t == "date":
        return F.try_to_date(v, "yyyy-MM-dd")
    return v.try_cast(t)


def cast_table(table: DataFrame, types: dict[str, str]) -> DataFrame:
    """Apply the inferred types; other columns pass through."""
    return table.select(*[cast_column(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in table.columns])


# ---------------------------------------------------------- schema (H1) ---

def describe(spark: SparkSession, df: DataFrame) -> DataFrame:
    """H1: ``DF[position, name, type]`` of a table's schema (metadata only)."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([
        T.StructField("position", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
    ])
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------- header promotion (C9) ---

# --- fixed values (must equal the reference's) -----------------------------
BUSINESS_HEADER = ["date", "store_id", "product_id", "category", "qty_sold", "revenue", "discount", "currency"]
# ---------------------------------------------------------------------------


def header_matches(cells: list[Column], names: list[str]) -> Column:
    cond = F.lit(True)
    for c, name in zip(cells, names):
        cond = cond & (F.lower(js_trim(F.coalesce(c, F.lit("")))) == F.lit(name))
    if len(cells) < len(names):
        return F.lit(False)
    return cond


def promote_header(table: DataFrame, names: list[str] | None = None, order_col: str = "line_no",
                   group_col: str = "file") -> DataFrame:
    """C9, file by file: where the first row (per ``group_col`` by ``order_col``)
    holds the known names (trimmed, lower-cased), that row is dropped. The columns
    get the known names when any file brings them - the files of one table share
    their columns by position; a table without such a row is returned unchanged."""
    names = names or BUSINESS_HEADER
    data_cols = [c for c in table.columns if c not in (order_col, group_col)]
    if len(data_cols) < len(names):
        return table
    # first places by a hash aggregate of numbers; only the rows there are looked at
    firsts = table.groupBy(group_col).agg(F.min(order_col).alias("_first"))
    at = [table[group_col].eqNullSafe(firsts[group_col]), table[order_col] == firsts["_first"]]
    heads = table.join(firsts, at, "left_semi").filter(header_matches([F.col(c) for c in data_cols[:len(names)]], names))
    heads = materialize(heads.select(F.col(group_col).alias("_g"), F.col(order_col).alias("_o")), "header-rows")
    found = heads.count()
    if not found:
        return table
    gone = _maybe_broadcast(heads, found)
    kept = table.join(gone, [table[group_col].eqNullSafe(gone["_g"]), table[order_col] == gone["_o"]], "left_anti")
    renames = dict(zip(data_cols[:len(names)], names))
    return kept.select(*[F.col(c).alias(renames.get(c, c)) for c in table.columns])
