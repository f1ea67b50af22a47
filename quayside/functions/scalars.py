"""Scalar column expressions: stamps, size labels, ratios, comparable values,
log severity and display dates. All built-in Spark functions, no UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's) -----------------------------
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB"]  # then "PB" for everything above
SIZE_LAST_UNIT = "PB"
SIZE_STEP = 1024
# Log severity: lower-cased message contains any of these, checked in this order.
SEVERITY_RULES = [
    ("error", ["error", "lỗi", "failed"]),
    ("success", ["hoàn tất", "complete", "success"]),
    ("warning", ["warning", "dừng"]),
]
SEVERITY_DEFAULT = "info"
DISPLAY_STAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"
DISPLAY_MTIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ---------------------------------------------------------------------------

# JavaScript's String.prototype.trim() white space and line terminators.
_JS_SPACE_CHARS = ("\t\n\u000b\f\r \u00a0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                   + "\u2028\u2029\u202f\u205f\u3000\ufeff")
_DECIMAL_SHAPE = "^[+-]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_RADIX_SHAPE = "^0(?:[xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_quote(text: str) -> str:
    return "\\Q" + text + "\\E"


def stamp_pattern(prefix: str, digits: int) -> str:
    return f"(?i)^{java_quote(prefix)}([0-9]{{{digits}}})\\.csv$"


def file_stamp(name: Column | str, prefix: str, digits: int, fmt: str) -> Column:
    """The stamp in a landed file name as a zone-less TIMESTAMP_NTZ, or
    NULL if the name does not match or the stamp is not a real date/time
    (month 13, 31 Feb, hour 24 ...). The stamp names a wall-clock time, so it
    is never moved by the session time zone (a 02:30 in a DST gap stays 02:30)."""
    digits_text = F.regexp_extract(_c(name), stamp_pattern(prefix, digits), 1)
    valid = (digits_text != F.lit("")) & F.try_to_timestamp(digits_text, F.lit(fmt)).isNotNull()
    return F.when(valid, F.to_timestamp_ntz(digits_text, F.lit(fmt)))


_TIME_TOKENS = re.compile(r"(yyyy|MM|dd|HH|mm|ss|SSSSSS|SSS)")


def format_time(ts: Column | str, pattern: str) -> Column:
    """``date_format`` without the session time zone for zone-less values.

    TIMESTAMP_NTZ values print their own wall-clock time (``date_format``
    would route them through the session zone and move times in a DST gap);
    instants (TIMESTAMP) print in the session zone, as ``date_format`` does;
    dates print at midnight. Tokens: yyyy MM dd HH mm ss SSS SSSSSS."""
    text = _c(ts).cast("timestamp_ntz").cast("string")  # yyyy-MM-dd HH:mm:ss[.fraction]
    frac = F.when(F.instr(text, ".") > 0, F.rpad(F.substring_index(text, ".", -1), 6, "0")).otherwise(F.lit("000000"))
    spans = {"yyyy": (1, 4), "MM": (6, 2), "dd": (9, 2), "HH": (12, 2), "mm": (15, 2), "ss": (18, 2)}
    parts = []
    for piece in _TIME_TOKENS.split(pattern):
        if not piece:
            continue
        if piece in spans:
            parts.append(F.substring(text, *spans[piece]))
        elif piece == "SSSSSS":
            parts.append(frac)
        elif piece == "SSS":
            parts.append(F.substring(frac, 1, 3))
        else:
            parts.append(F.lit(piece))
    return F.when(text.isNotNull(), F.concat(*parts))


def ntz_micros(ts: Column | str) -> Column:
    """Microseconds of a TIMESTAMP_NTZ wall-clock time read as UTC: an
    ordering key that no session time zone can bend."""
    return F.unix_micros(F.concat(_c(ts).cast("string"), F.lit("Z")).cast("timestamp"))


def size_label(size_bytes: Column | str) -> Column:
    """1024-step label with one decimal, B..TB then PB (round half even)."""
    amount = _c(size_bytes).cast("double")
    expr = None
    for power, unit in enumerate(SIZE_UNITS):
        scaled = amount / F.lit(float(SIZE_STEP ** power))
        text = F.format_string("%.1f " + unit, F.bround(scaled, 1))
        expr = F.when(scaled < SIZE_STEP, text) if expr is None else expr.when(scaled < SIZE_STEP, text)
    last = F.format_string("%.1f " + SIZE_LAST_UNIT, F.bround(amount / F.lit(float(SIZE_STEP ** len(SIZE_UNITS))), 1))
    return expr.otherwise(last)


def size_mb_label(size_bytes: Column | str) -> Column:
    """Fixed MB label of the scan list."""
    return F.format_string("%.1f MB", F.bround(_c(size_bytes).cast("double") / F.lit(1048576.0), 1))


def round_half_even_1(x: Column) -> Column:
    """A double rounded to one decimal by its exact binary value, ties to even.

    ``bround`` rounds the shortest decimal text, which can stand on the other
    side of a tie. Here the whole part is split off and the fraction scaled by
    2**53: both are exact, so ten times the fraction is rounded as a whole number."""
    size = F.abs(x)
    whole = F.floor(size)
    scaled = ((size - whole) * F.lit(2.0 ** 53)).cast("decimal(20,0)") * F.lit(10)
    unit = F.lit(2 ** 53).cast("decimal(20,0)")
    tenths = F.floor(scaled / unit).cast("bigint")
    rest = (scaled - tenths.cast("decimal(20,0)") * unit) * F.lit(2)
    up = (rest > unit) | ((rest == unit) & (tenths % 2 == 1))
    rounded = (whole * F.lit(10) + tenths + up.cast("bigint")).cast("double") / F.lit(10.0)
    return F.when(size >= F.lit(2.0 ** 50), x).otherwise(F.signum(x) * rounded)


def compression_ratio(parquet_bytes: Column | str, csv_bytes: Column | str) -> Column:
    """Percent saved, one decimal; 0 when the source is empty."""
    p = _c(parquet_bytes).cast("double")
    c = _c(csv_bytes).cast("double")
    return F.when(c > 0, round_half_even_1((F.lit(1.0) - p / c) * F.lit(100.0))).otherwise(F.lit(0.0))


def js_trim(text: Column | str) -> Column:
    """Trim JavaScript white space from both ends (a character-set trim, no regex)."""
    return F.trim(_c(text), F.lit(_JS_SPACE_CHARS))


def _radix_number(t: Column) -> Column:
    """A 0x, 0o or 0b integer of any length as a double.

    Of the digits after the prefix the first ones that fill at most 60 bits are read exactly; one
    more bit says whether anything but zeros follows, so that rounding to a double is as from all
    digits, and the power of two that was cut off is multiplied back."""
    kind = F.lower(F.substring(t, 2, 1))
    base, width, keep = (F.when(kind == "x", x).when(kind == "o", o).otherwise(b) for x, o, b in ((16, 8, 2), (4, 3, 1), (15, 20, 60)))
    digits = F.ltrim(F.substr(t, F.lit(3)), F.lit("0"))
    n = F.length(digits)
    head = F.call_function("conv", F.substr(digits, F.lit(1), keep), base, F.lit(10)).cast("bigint")
    rest = (F.ltrim(F.substr(digits, keep + 1), F.lit("0")) != "").cast("bigint")
    long = (head * 2 + rest).cast("double") * F.pow(F.lit(2.0), (width * (n - keep) - 1).cast("double"))
    return F.when(n == 0, F.lit(0.0)).when(n <= keep, head.cast("double")).otherwise(long)


def _literal_number(t: Column) -> Column:
    """The number a trimmed text is a literal of (it may be infinite), else NULL."""
    # cheap guards first: the regexes only run on text that can be a number
    may_be_number = F.substring(t, 1, 1).isin(*list("+-.0123456789"))
    dec = F.when(may_be_number & t.rlike(_DECIMAL_SHAPE), t.try_cast("double"))
    radix = may_be_number & F.lower(F.substring(t, 1, 2)).isin("0x", "0o", "0b") & t.rlike(_RADIX_SHAPE)
    return F.coalesce(dec, F.when(radix, _radix_number(t)))


def _finite(num: Column) -> Column:
    """A finite number with -0.0 folded into 0.0, else NULL."""
    return F.when(num.isNotNull() & (F.abs(num) < F.lit(float("inf"))), num + F.lit(0.0))


def comparable_number(value: Column | str) -> Column:
    """The finite number a trimmed text stands for (JavaScript ``Number`` rules:
    decimal literals, exponents, 0x/0o/0b integers), else NULL."""
    return _finite(_literal_number(js_trim(_c(value).cast("string"))))


def comparable(value: Column | str) -> Column:
    """NULL -> '', trimmed text, finite numbers by numeric value.

    Two values are equal in the preview diff iff their ``comparable`` keys are
    equal: numbers map to Spark's (injective) double text, other text to itself.
    """
    v = _c(value).cast("string")
    num = comparable_number(v)
    return (
        F.when(v.isNull(), F.lit(""))
        .when(num.isNotNull(), F.concat(F.lit("\u0000n:"), num.cast("string")))
        .otherwise(js_trim(v))
    )


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used. Written out in full,
    the expressions below would repeat each other many times over, to code that is too long to be
    compiled to machine code."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def comparable_equal(a: Column | str, b: Column | str) -> Column:
    """B10 as a predicate: ``comparable(a) == comparable(b)`` without turning
    numbers back into text (numbers compare as doubles, other values as
    trimmed text, NULL as ''). Texts that are equal as they are, most of what a diff
    meets, are settled first; only the others are read as numbers."""
    va, vb = (F.coalesce(_c(x).cast("string"), F.lit("")) for x in (a, b))

    def number(t: Column) -> Column:
        return _let(_literal_number(t), _finite)

    def equal(t: Column) -> Column:
        numbers = F.struct(number(t["a"]).alias("a"), number(t["b"]).alias("b"))
        return _let(numbers, lambda n: F.when(n["a"].isNotNull() | n["b"].isNotNull(), n["a"].eqNullSafe(n["b"])).otherwise(t["a"] == t["b"]))

    return F.when(va == vb, F.lit(True)).otherwise(_let(F.struct(js_trim(va).alias("a"), js_trim(vb).alias("b")), equal))


def severity(message: Column | str) -> Column:
    """Error > success > warning > info by case-insensitive substring."""
    low = F.lower(_c(message))
    expr = None
    for level, words in SEVERITY_RULES:
        cond = None
        for w in words:
            c = F.contains(low, F.lit(w))
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return expr.otherwise(F.lit(SEVERITY_DEFAULT))


def keyword_match(message: Column | str, keyword: str | None) -> Column:
    """Trimmed, case-insensitive contains; an empty keyword keeps all."""
    query = (keyword or "").strip().lower()
    if not query:
        return F.lit(True)
    return F.contains(F.lower(_c(message)), F.lit(query))


def display_stamp(ts: Column | str) -> Column:
    """Stamp as shown in the feed scripts."""
    return format_time(ts, DISPLAY_STAMP_FORMAT)


def display_mtime(ts: Column | str) -> Column:
    """Modification time as shown in the scan list (an instant prints in
    the session zone, a zone-less time as itself)."""
    return format_time(ts, DISPLAY_MTIME_FORMAT)
