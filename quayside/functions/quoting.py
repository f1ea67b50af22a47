"""Quote-aware split and canonical CSV encoding as pure Catalyst expressions.

No UDF: every line is split by ``regexp_extract_all`` with one Java pattern,
so the work runs in every task of the scan stage and stays in the JVM.

Dialect rules (one record per physical line; quote state never crosses a line):

* a delimiter outside quotes ends a field; inside quotes it is data;
* a quote opens quoting only at the start of a field;
* inside quotes ``""`` is a literal quote, a quote right before a delimiter or
  the end of the line closes, any other quote is a literal quote;
* a quote that is never closed takes the rest of the line;
* ``repair=True`` (dangling-quote repair): inside quotes, ``""`` right before a
  delimiter or the end is a literal quote *and* the close.

The line is prefixed with the delimiter, so each field is exactly one match:
group 1 is the quoted body, group 2 the closing token, group 3 an unquoted field.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _regex_char(delim: str) -> str:
    if len(delim) != 1:
        raise ValueError(f"delimiter must be one character, got {delim!r}")
    if delim == '"':
        raise ValueError("the quote character cannot be the delimiter")
    return delim if delim.isalnum() else "\\" + delim


def split_pattern(delim: str, repair: bool) -> str:
    d = _regex_char(delim)
    end = f"(?:{d}|\\z)"
    if repair:
        body = f'(?:[^"]++|""(?!{end})|"(?!"|{end}))*+'
        close = f'(""(?={end})|"(?={end})|\\z)'
    else:
        body = f'(?:[^"]++|""|"(?!"|{end}))*+'
        close = f'("(?={end})|\\z)'
    return f'{d}(?:"({body}){close}|([^{d}]*))'


def field_tokens(line: Column | str, delim: str, repair: bool = False) -> Column:
    """One regex pass: every field as its raw token (delimiter + field text as
    written). The array length is the field count."""
    col = F.col(line) if isinstance(line, str) else line
    prefixed = F.concat(F.lit(delim), col)
    return F.regexp_extract_all(prefixed, F.lit(split_pattern(delim, repair)), 0)


def decode_token(token: Column) -> Column:
    """The value of one field token, with plain string functions (no regex).

    A quoted body never ends in a lone quote (a lone quote must be followed by
    a non-quote character), so the trailing run of ``k`` quotes after the
    opening quote is body pairs plus the closing token: odd ``k`` ends with a
    closing quote (dropped); even ``k`` is either unclosed (base) or pairs and
    a ``""`` close (repair), and both read as the run unescaped. Decoding is
    therefore the same in both dialects; only the token boundaries differ."""
    inner = F.substr(token, F.lit(3))  # after the delimiter and the opening quote
    n = F.length(inner)
    k = n - F.length(F.rtrim(inner, F.lit('"')))
    unescape = lambda c: F.replace(c, F.lit('""'), F.lit('"'))
    quoted = F.when(k % 2 == 1, unescape(F.left(inner, n - 1))).otherwise(unescape(inner))
    return F.when(F.substring(token, 2, 1) == F.lit('"'), quoted).otherwise(F.substr(token, F.lit(2)))


def field_from_tokens(tokens: Column, i: int) -> Column:
    """Field ``i`` (0-based) by element access: no lambda, stays in codegen;
    NULL when out of range."""
    return decode_token(F.get(tokens, i))


def fields_from_tokens(tokens: Column) -> Column:
    """The whole ``ARRAY<STRING>`` (a higher-order function: use it on small
    row sets such as first lines and previews, not on whole tables)."""
    return F.transform(tokens, decode_token)


def split_quoted(line: Column | str, delim: str, repair: bool = False) -> Column:
    """B1/B2: split one raw line into ``ARRAY<STRING>`` (never NULL elements)."""
    return fields_from_tokens(field_tokens(line, delim, repair))


def split_fields(line: Column | str, delim: str, repair: bool, n: int) -> tuple[list[Column], Column]:
    """B1/B2 when the field count ``n`` is known: ``([field_0..field_n-1], count)``
    as codegen-friendly columns over one shared regex pass."""
    tokens = field_tokens(line, delim, repair)
    return [field_from_tokens(tokens, i) for i in range(n)], F.size(tokens)


def _needs_quote(f: Column, delim: str) -> Column:
    return (F.contains(f, F.lit(delim)) | F.contains(f, F.lit('"')) | F.contains(f, F.lit("\n"))
            | F.contains(f, F.lit("\r")))


def _encode_one(f: Column, delim: str) -> Column:
    v = F.coalesce(f, F.lit(""))
    return F.when(_needs_quote(v, delim), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)


def encode_csv(fields: Column | str, delim: str) -> Column:
    """Minimal quoting with ``""`` escape, as a CSV writer with LF endings.

    A field is quoted when it holds the delimiter, a quote, CR or LF; a record
    made of one empty field is written ``""`` so that it is not a blank line.
    (Array input uses a lambda; prefer ``encode_columns`` for known columns.)
    """
    arr = F.col(fields) if isinstance(fields, str) else fields
    encoded = F.transform(arr, lambda f: _encode_one(f, delim))
    single_empty = (F.size(arr) == 1) & (F.coalesce(F.get(arr, 0), F.lit("")) == F.lit(""))
    return F.when(single_empty, F.lit('""')).otherwise(F.array_join(encoded, delim))


def encode_columns(cols: list[Column], delim: str) -> Column:
    """B3 over a known list of string columns: plain expressions, no lambda."""
    body = F.concat_ws(delim, *[_encode_one(c, delim) for c in cols])
    if len(cols) == 1:
        return F.when(F.coalesce(cols[0], F.lit("")) == F.lit(""), F.lit('""')).otherwise(body)
    return body


def quote_all(fields: Column | str, delim: str) -> Column:
    """Every field quoted, quotes doubled (the shape of fully quoted exports)."""
    arr = F.col(fields) if isinstance(fields, str) else fields
    return F.array_join(
        F.transform(arr, lambda f: F.concat(F.lit('"'), F.replace(F.coalesce(f, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))),
        delim,
    )


def is_blank_record(fields: Column | str) -> Column:
    """A record that is one empty field (a blank line, or a lone ``""``)."""
    arr = F.col(fields) if isinstance(fields, str) else fields
    return (F.size(arr) == 1) & (F.get(arr, 0) == F.lit(""))


#: The only lines of one empty field.
BLANK_LINES = ("", '"', '""')


def is_blank_line(value: Column | str) -> Column:
    """C7 on a raw line, without a split."""
    return (F.col(value) if isinstance(value, str) else value).isin(*BLANK_LINES)


# Column name under which ``parse`` keeps the field tokens of a line.
TOKENS = "_qt"


def n_fields() -> Column:
    """Field count of a parsed line (from its tokens)."""
    return F.size(F.col(TOKENS))


def field(i: int) -> Column:
    """Field ``i`` of a parsed line (from its tokens)."""
    return field_from_tokens(F.col(TOKENS), i)


def fields_of_parsed() -> Column:
    """The fields array of a parsed line (a lambda: small row sets only)."""
    return fields_from_tokens(F.col(TOKENS))


def is_blank_parsed() -> Column:
    """C7 on a parsed line: one field and it is empty - a blank line, a lone
    ``""`` or a lone ``"`` (the token is the delimiter plus '', '"' or '""')."""
    first = F.get(F.col(TOKENS), 0)
    return (n_fields() == 1) & F.substr(first, F.lit(2)).isin("", '"', '""')
