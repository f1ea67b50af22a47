"""Convert, run one feed, run all feeds, run selected files, re-check.

A strict conversion reads the source text once:

1. the heads of the files (``sources.heads``: first lines, no scan) give shape, header, the
   source preview and, for an inferred feed, a guess of the column types;
2. one pass parses, checks the shape and writes. Rows carry file, split and place instead of
   a line number; ``observe`` counts lines, blank lines and headers, and for an inferred feed
   which types the values of each column fit. Where they say other than the guess, and only
   then, the pass is made again with the types found;
3. the audit reads three columns of the output: rows and places of each split. They must be
   consecutive and add up to the lines observed, so no line is lost or doubled, and they give
   the offsets that line numbers are resolved with (``operators.origin``).

Conversions with a quarantine, of groups of more than ``HEAD_FILES`` files, or of files in
which a data line equals the header, are planned from numbered lines: a pass over the text
for counts per split, then the write.

Output is staged beside its target and moved into place only after the integrity
check (E1, file by file) passes; what was staged goes in any case (F4).
"""

from __future__ import annotations

import time
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.functions.quoting import BLANK_LINES, TOKENS, fields_of_parsed, is_blank_line, is_blank_parsed, n_fields
from quayside.functions.scalars import compression_ratio, file_stamp, size_label
from quayside.operators import audit as A
from quayside.operators import tables as TB
from quayside.operators.origin import ORIGIN, offsets_of, split_facts, write_offsets
from quayside.operators.selection import candidates, latest_by_stamp, require_latest
from quayside.operators.sinks import staging_path, swap_in, write_staged
from quayside.plans.progress import Progress
from quayside.session import materialize, remove
from quayside.sources.catalog import catalog
from quayside.sources.feeds import FEED_BY_KEY, FEEDS, Feed, resolve_feed_name
from quayside.sources.heads import HEAD_FILES, Head, file_heads, first_records, listed_files, plain_names
from quayside.sources.lines import number_lines, read_numbered_lines, split_table, tagged_lines


@dataclass
class Profiled:
    lines: DataFrame        # file, file_size, mtime, line_no, value, tokens, fields
    per_file: DataFrame     # file, first (fields of line 1), rows_nonblank, lines, columns, size
    unnumbered: DataFrame   # the parsed lines without line numbers (no join): for whole-table aggregates
    numbered: DataFrame     # the numbered lines before any split
    written: list[str] = field(default_factory=list)  # folders that go when the profile is no longer read
    offsets: DataFrame | None = None  # file, split, first, before


def profile_source(spark: SparkSession, paths: list[str], feed: Feed, widest: bool = True) -> Profiled:
    """Pass 1 (see module doc): numbered lines plus per-file facts. ``columns``, the widest
    record, needs a split of every line; without ``widest`` it is NULL."""
    raw = tagged_lines(spark, paths)
    parse = lambda df: TB.parse(df, feed.delimiter, feed.repair_dangling_quote)
    counts = {"_nonblank": F.count_if(~is_blank_line("value")), "_size": F.max("file_size")}
    counted = raw
    if widest:
        counted = parse(raw)
        counts["_widest"] = F.max(F.when(~is_blank_parsed(), n_fields()))
    blocks = split_table(counted, **counts)
    numbered = number_lines(raw, blocks)
    # line 1 of a file is found by number; only these lines are split
    firsts = parse(numbered.filter(F.col("line_no") == 1).select("_fkey", "file", "value")).select(
        "_fkey", "file", fields_of_parsed().alias("first"))
    columns = F.coalesce(F.max("_widest"), F.lit(0)) if widest else F.lit(None).cast("int")
    per_file = blocks.groupBy("_fkey").agg(
        F.sum("_nonblank").alias("rows_nonblank"), F.sum("_n").alias("lines"), columns.alias("columns"), F.max("_size").alias("size"))
    # read several times below: written once (a row per file), or each use would scan the text for line 1
    per_file = materialize(firsts.join(per_file, "_fkey").select("_fkey", "file", "first", "rows_nonblank", "lines", "columns", "size"), "per-file")
    offsets = blocks.join(per_file.select("_fkey", "file"), "_fkey").select(
        "file", F.col("block").alias("split"), F.col("_rid0").alias("first"), F.col("_before").alias("before"))
    # split below the join with the split table: a check of the field count above it, which names the
    # line, then reads the tokens and does not split a second time
    lines = number_lines(parse(raw), blocks).select("file", "file_size", "mtime", "line_no", "block", "_rid", "value", TOKENS, "fields")
    return Profiled(lines, per_file, parse(raw), numbered, [blocks.path_, per_file.path_], offsets)


def _rows_expected(feed: Feed, n: int | None, all_lines: bool) -> F.Column:
    """Rows that E1 expects of a file: its non-blank records less the header. In a table of one
    column a blank line is a row, and a quarantine takes blank lines too: there all lines count."""
    total = F.col("lines") if n == 1 or all_lines else F.col("rows_nonblank")
    return F.greatest(total - F.lit(1), F.lit(0)) if feed.has_header else total


def _csv_side(prof: Profiled, feed: Feed) -> DataFrame:
    return prof.per_file.select(
        "file", _rows_expected(feed, None, False).cast("bigint").alias("rows"), F.col("columns").cast("int").alias("columns"),
        "size", size_label("size").alias("size_label"),
    )


def require_data(spark: SparkSession, paths: list[str], prof: Profiled) -> None:
    """No file of the group is empty (files without a line have no row in the profile; a path
    that does not exist fails when the scan is planned, G3). The listing is a DataFrame."""
    name = F.regexp_extract("file", "[^/]*$", 0)
    listed = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"))
    empty = listed.select(name.alias("name")).join(prof.per_file.select(name.alias("name")), "name", "left_anti")
    found = [r["name"] for r in empty.orderBy("name").limit(5).collect()]
    if found or prof.per_file.isEmpty():
        raise ValueError(f"no data in: {', '.join(found) or ', '.join(paths)}")


def first_shape(prof: Profiled, feed: Feed) -> tuple[int, list[str] | None]:
    """H2/A6 of a group: the field count, and header if the feed has one, of all first lines."""
    cols = [F.size("first").alias("n")] + ([F.col("first").alias("h")] if feed.has_header else [])
    shapes = prof.per_file.select(*cols).distinct().limit(2).collect()  # two are enough to refuse
    if not shapes:
        raise ValueError("no data")
    if len(shapes) > 1:
        raise ValueError(f"files of {feed.key} disagree on their first line: convert them as separate groups")
    return shapes[0]["n"], list(shapes[0]["h"]) if feed.has_header else None


def stamp_of(feed: Feed) -> F.Column:
    """The stamp in the name of ``file``."""
    name = F.substring_index("file", "/", -1)  # a name with a stamp has nothing that a URI would encode
    return file_stamp(name, feed.prefix, feed.stamp_digits, feed.stamp_format)


def origin() -> list[F.Column]:
    """Identity of a row: file, split and place in the scan."""
    return [F.col("file").alias("_file"), F.col("block").alias("_split"), F.col("_rid")]


def shaped_table(parsed: DataFrame, unnumbered: DataFrame, feed: Feed, n: int, header: list[str] | None,
                 strict: bool, keep: list[F.Column]) -> DataFrame:
    """A5/A6/A7 for records of ``n`` fields: the one table builder of batch and stream."""
    if feed.has_header:
        return TB.to_table_header(parsed, list(header), strict=strict, keep=keep)
    if feed.all_string:
        return TB.to_table_positional(parsed, n, base=1, strict=strict, keep=keep)
    table = TB.to_table_positional(parsed, n, base=0, pad=True, strict=strict, keep=keep)
    # inference needs no line numbers: aggregate over the unnumbered scan
    whole = unnumbered.filter(n_fields() == n)
    return TB.cast_table(table, TB.infer_types(TB.to_table_positional(whole, n, base=0, pad=True, strict=False)))


def build_table(spark: SparkSession, prof: Profiled, feed: Feed, strict: bool = True) -> tuple[DataFrame, list[str], DataFrame | None]:
    """A5/A6/A7 + G1 for one feed: returns (table with ORIGIN, data columns, rejected)."""
    n, header = first_shape(prof, feed)
    parsed, rejected = prof.lines, None
    if not strict:
        parsed, rejected = TB.split_by_arity(parsed, n)
    table = shaped_table(parsed, prof.unnumbered, feed, n, header, strict, origin())
    return table, [c for c in table.columns if c not in ORIGIN], rejected


def _file_mismatches(prof: Profiled, feed: Feed, n: int, found: DataFrame, all_lines: bool) -> list[str]:
    """E1 per file: files whose rows differ between source and output (the first few)."""
    want = prof.per_file.select("file", _rows_expected(feed, n, all_lines).cast("bigint").alias("want"))
    both = want.join(found.groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("got")), "file", "full_outer")
    bad = both.filter(F.coalesce("want", F.lit(0)) != F.coalesce("got", F.lit(0)))
    return [f"{r['file']}: {r['want']} in the source, {r['got']} in the output" for r in bad.orderBy("file").limit(5).collect()]


_AUDIT = ("feed string, input string, output string, c_rows bigint, c_columns int, c_size bigint, c_preview array<array<string>>, "
          "p_rows bigint, p_columns int, p_size bigint, p_preview array<array<string>>, schema array<struct<name:string,type:string>>, "
          "elapsed_seconds double, rows_written bigint")


@dataclass
class Written:
    """A staged output and what the audit says of its source."""

    columns: list[str]
    rows: int              # D1: data records of the source
    size: int              # bytes of the source
    widest: int
    preview: list[list[str]]
    rows_written: int
    aside: tuple[str, str] | None = None  # staged quarantine and its place


class NeedsNumbers(Exception):
    """Line numbers are needed while the text is read: to name a misfit line, or because a data
    line in a first split equals the header."""


def _parsed_lines(spark: SparkSession, records: list[tuple[str, int, str]], feed: Feed) -> list[list[str]]:
    """Fields of a few lines that the driver holds, by the splitter of the scan."""
    lines = spark.createDataFrame([(i, v) for i, (_, _, v) in enumerate(records)], "i int, value string")
    parsed = TB.parse(lines, feed.delimiter, feed.repair_dangling_quote)
    return [list(r["fields"]) for r in parsed.select("i", "fields").orderBy("i").collect()]


def _is_blank(value: str) -> bool:
    """``is_blank_line`` for a line that the driver holds."""
    return value in BLANK_LINES


def _shape_of(spark: SparkSession, heads: list[Head], feed: Feed) -> tuple[int, list[str] | None]:
    """H2/A6 of a group from the first lines of its files."""
    firsts = sorted({h.lines[0] for h in heads})
    fields = _parsed_lines(spark, [("", 1, v) for v in firsts], feed)
    if len({tuple(f) if feed.has_header else len(f) for f in fields}) > 1:
        raise ValueError(f"files of {feed.key} disagree on their first line: convert them as separate groups")
    return len(fields[0]), fields[0] if feed.has_header else None


def _guess_types(spark: SparkSession, heads: list[Head], feed: Feed, n: int) -> dict[str, str]:
    """A7 of the lines in the heads."""
    lines = spark.createDataFrame([(v,) for h in heads for v in h.lines], "value string")
    parsed = TB.parse(lines, feed.delimiter, feed.repair_dangling_quote).filter(n_fields() == n)
    return TB.infer_types(TB.to_table_positional(parsed, n, base=0, pad=True, strict=False))


def bytes_of(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files in a listing; none is opened."""
    return spark.read.format("binaryFile").load(paths).agg(F.sum("length")).head()[0] or 0


def _watched(progress: Progress | None, rows: int):
    return progress.watch(rows) if progress else nullcontext()


def write_in_one_pass(spark: SparkSession, files: list[str], listed: list[str], feed: Feed, staged: str,
                      progress: Progress | None = None) -> Written:
    """A2-A7, G1, F1 and the facts for E1 from one read of the text (two if the types were guessed wrong)."""
    heads = file_heads(spark, listed)
    empty = [h.file.rsplit("/", 1)[-1] for h in heads if not h.lines]
    if empty or not heads:
        raise ValueError(f"no data in: {', '.join(empty[:5]) or ', '.join(files)}")
    n, header = _shape_of(spark, heads, feed)
    is_header = F.lit(False)
    if feed.has_header:
        is_header = (F.col("block") == 0) & F.col("value").isin(*{h.lines[0] for h in heads})
    seen, made = Observation(), Observation()
    raw = tagged_lines(spark, files).observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count_if(is_header).alias("headers"), F.count_if(~is_blank_line("value")).alias("nonblank"))
    parsed = TB.parse(raw.filter(~is_header), feed.delimiter, feed.repair_dangling_quote)
    parsed = parsed.withColumn("line_no", F.col("_rid"))  # for the message of a misfit, which is then made from numbered lines
    inferred = not feed.has_header and not feed.all_string
    if feed.has_header:
        names = TB.fix_header_names(header)
    else:
        names = TB.positional_names(n, base=0 if inferred else 1, pad=inferred)
    file, split, place = origin()
    table = TB.to_table_named(parsed, names, [file, split, TB.checked(n, place, "bigint").alias("_rid")])
    types = _guess_types(spark, heads, feed, n) if inferred else {}
    bits = [F.bit_or(TB.value_type_bit(F.col(c))).alias(f"m{i}") for i, c in enumerate(names)] if inferred else []
    first = TB.cast_table(table.observe(made, F.count(F.lit(1)).alias("rows"), *bits), types)
    size = bytes_of(spark, files)
    seen_lines = [len(v.encode()) + 1 for h in heads for v in h.lines]
    try:
        with _watched(progress, size * len(seen_lines) // sum(seen_lines)):
            write_staged(first, staged, row_group_bytes=feed.row_group_bytes)
    except Exception as failed:
        if TB.WRONG_COUNT in str(failed):
            raise NeedsNumbers from failed
        raise
    if inferred:
        found = {c: TB.type_from_bits(made.get[f"m{i}"]) for i, c in enumerate(names)}
        if found != types:
            seen_before = dict(seen.get)
            made = Observation()
            again = TB.cast_table(table.observe(made, F.count(F.lit(1)).alias("rows")), found)
            write_staged(again, staged, row_group_bytes=feed.row_group_bytes)
            if made.get["rows"] != seen_before["lines"]:
                raise RuntimeError(f"integrity check failed for {feed.key}: the source changed while it was read")
    lines, headers, rows = seen.get["lines"], seen.get["headers"], made.get["rows"]
    if feed.has_header and headers != len(listed):
        raise NeedsNumbers
    facts = materialize(split_facts(spark.read.parquet(staged).select("_file", "_split", "_rid")), "split-facts")
    try:
        gap = F.when(F.col("high") - F.col("low") + 1 != F.col("rows"), F.col("file"))
        found = facts.agg(F.sum("rows").alias("rows"), F.min(gap).alias("gap")).head()
        if found["gap"] or not lines - headers == rows == (found["rows"] or 0):
            raise RuntimeError(f"integrity check failed for {feed.key}: {lines - headers} lines in the source, {found['rows']} in the output"
                               + (f"; lines of {found['gap']} are missing" if found["gap"] else ""))
        write_offsets(offsets_of(facts, feed.has_header), staged, stamp_of(feed))
    finally:
        remove(spark, facts.path_)
    top = first_records(heads, A.PREVIEW_ROWS, _is_blank, 1 if feed.has_header else 0)
    preview = A.first_data_rows(read_numbered_lines(spark, files), feed) if top is None else _parsed_lines(spark, top, feed) if top else []
    return Written(names, seen.get["nonblank"] - headers, size, n, preview, rows)


def write_numbered(spark: SparkSession, files: list[str], feed: Feed, staged: str, strict: bool, aside: str | None,
                   progress: Progress | None = None) -> Written:
    """The same from numbered lines, with or without a quarantine: a pass for counts, one for each output."""
    prof = profile_source(spark, files, feed, widest=False)
    bad_staged = staging_path(aside) if aside else None
    try:
        require_data(spark, files, prof)
        table, data_cols, rejected = build_table(spark, prof, feed, strict)
        n = len(data_cols)
        obs = Observation(f"rows_{feed.key}")
        lines = prof.per_file.agg(F.sum("lines")).head()[0] if progress else 0
        with _watched(progress, lines):
            write_staged(table.observe(obs, F.count(F.lit(1)).alias("rows")), staged, row_group_bytes=feed.row_group_bytes)
        found, widest = spark.read.parquet(staged).select("_file"), n
        if rejected is not None:
            write_staged(rejected, bad_staged)
            bad = spark.read.parquet(bad_staged)
            found = found.unionAll(bad.filter(F.col("line_no") > (1 if feed.has_header else 0)).select(F.col("file").alias("_file")))
            widest = max(n, bad.agg(F.max("found")).head()[0] or 0)
        wrong = _file_mismatches(prof, feed, n, found, not strict)
        if wrong:
            raise RuntimeError(f"integrity check failed for {feed.key}: {'; '.join(wrong)}")
        write_offsets(prof.offsets, staged, stamp_of(feed))
        csv_row = prof.per_file.agg(F.sum(_rows_expected(feed, None, False)).alias("rows"), F.sum("size").alias("size")).head()
        preview = A.first_data_rows(prof.numbered, feed)
        return Written(data_cols, csv_row["rows"], csv_row["size"], widest, preview, obs.get["rows"], (bad_staged, aside) if aside else None)
    except BaseException:
        if bad_staged:
            remove(spark, bad_staged)
        raise
    finally:
        remove(spark, *prof.written)


def convert(spark: SparkSession, paths: str | list[str], out: str, feed_name: str | None = None,
            strict: bool = True, quarantine: str | None = None, stage: str | None = None, progress: str | None = None) -> DataFrame:
    """Resolve the feed, audit the CSV, build the table, write it staged,
    audit the Parquet, check integrity, swap into ``out`` (feed partition).

    With ``strict=False`` records of another field count go to ``quarantine``,
    which must be given: every line of the source is in one of the two.
    With ``progress``, a folder, rows written so far are reported there (D3).
    Returns a one-row audit DataFrame (FIXTURES.md ``audit`` schema)."""
    started = time.perf_counter()
    files = [paths] if isinstance(paths, str) else list(paths)
    if not strict and not quarantine:
        raise ValueError("strict=False needs a quarantine for the records it takes out")
    keys = {resolve_feed_name(feed_name or f.rstrip("/").rsplit("/", 1)[-1]).key for f in files}
    if len(keys) != 1:
        raise ValueError(f"files of several feeds: {', '.join(sorted(keys))}")
    feed = FEED_BY_KEY[keys.pop()]
    target = f"{out.rstrip('/')}/feed={feed.key}"
    staged = f"{stage}/feed={feed.key}" if stage else staging_path(target)
    aside = None if strict else f"{quarantine.rstrip('/')}/feed={feed.key}"
    done, steps = None, Progress(spark, progress, feed.key) if progress else None
    try:
        listed = listed_files(spark, files)
        if strict and len(listed) <= HEAD_FILES and plain_names(listed):
            try:
                done = write_in_one_pass(spark, files, listed, feed, staged, steps)
            except NeedsNumbers:
                remove(spark, staged)
        if done is None:
            done = write_numbered(spark, files, feed, staged, strict, aside, steps)
        p_size = bytes_of(spark, [staged])
        if done.aside:
            swap_in(spark, *done.aside)
        swap_in(spark, staged, target)  # swap after E1
        written = spark.read.parquet(target)
        pq_prev = A.first_output_rows(spark, target, done.columns)
    except BaseException:
        if steps:
            steps.failed()
        raise
    finally:
        remove(spark, staged, *([done.aside[0]] if done and done.aside else []))
    if steps:
        steps.done(done.rows_written)
    schema = [(f.name, f.dataType.simpleString()) for f in written.schema.fields if f.name not in ORIGIN]
    elapsed = round(time.perf_counter() - started, 2)
    # the moved files are the checked files: the audit row reuses the numbers of the integrity check
    facts = (feed.key, ",".join(files), target, done.rows, done.widest, done.size, done.preview, done.rows_written, len(done.columns), p_size,
             pq_prev, schema, float(elapsed), done.rows_written)
    side = lambda p, *more: F.struct(*[F.col(f"{p}_{c}").alias(c) for c in ("rows", "columns", "size")],
                                     size_label(f"{p}_size").alias("size_label"), F.col(f"{p}_preview").alias("preview"), *more)
    return spark.createDataFrame([facts], _AUDIT).select(
        "feed", "input", "output", side("c").alias("csv"), side("p", F.col("schema")).alias("parquet"),
        compression_ratio("p_size", "c_size").alias("compression_ratio"), "elapsed_seconds", "rows_written")


def run_feed(spark: SparkSession, root: str, out: str, feed_name: str, recursive: bool = True, progress: str | None = None) -> DataFrame:
    """Pick the latest file of the feed by stamp (C2), then convert."""
    feed = resolve_feed_name(feed_name)
    latest = require_latest(latest_by_stamp(candidates(catalog(spark, root, recursive), [feed])), [feed.key])
    path = latest.select("path").collect()[0]["path"]  # one row: the chosen file
    return convert(spark, path, out, feed.key, progress=progress)


def run_all(spark: SparkSession, root: str, out: str, target: str | None = None, recursive: bool = True,
            profiles: list[Feed] | None = None, progress: str | None = None) -> DataFrame:
    """One catalogue listing and one latest-per-feed aggregate for all
    feeds, one conversion per feed, then publish all feeds together."""
    from quayside.operators.sinks import publish

    table = profiles or FEEDS
    latest = require_latest(latest_by_stamp(candidates(catalog(spark, root, recursive), table)), [f.key for f in table])
    chosen = {r["feed"]: r["path"] for r in latest.select("feed", "path").collect()}  # <= #feeds rows
    audits = [convert(spark, chosen[f.key], out, f.key, progress=progress) for f in table]
    if target:
        publish(spark, out, target, [f.key for f in table], mode="all_or_nothing")
    result = audits[0]
    for a in audits[1:]:
        result = result.unionByName(a)
    return result


def run_selected(spark: SparkSession, selected: list[tuple[str, str]], out: str, target: str | None = None,
                 progress: str | None = None) -> list[dict]:
    """I4: convert the selected files in order, publishing each; the first
    error stops the rest (they stay ``pending``), the failing file is ``error``."""
    from quayside.operators.sinks import publish

    states = [{"file": p, "feed": f, "status": "pending", "error": None} for p, f in selected]
    for st in states:
        st["status"] = "converting"
        try:
            convert(spark, st["file"], out, st["feed"], progress=progress).collect()
            if target:
                publish(spark, out, target, [resolve_feed_name(st["feed"]).key], mode="per_feed")
            st["status"] = "completed"
        except Exception as exc:  # noqa: BLE001 - the state records the failure
            st["status"] = "error"
            st["error"] = str(exc)
            break
    return states


def check(spark: SparkSession, csv_paths: str | list[str], parquet_path: str, feed_name: str) -> DataFrame:
    """Re-check an existing CSV/Parquet pair: D1, D2, H1, C6, E1, E2."""
    files = [csv_paths] if isinstance(csv_paths, str) else list(csv_paths)
    feed = resolve_feed_name(feed_name)
    prof = profile_source(spark, files, feed)
    csv = _csv_side(prof, feed).agg(F.sum("rows").alias("rows"), F.max("columns").alias("columns"),
                                    F.sum("size").alias("size")).withColumn("k", F.lit(1))
    pdf = spark.read.parquet(parquet_path)
    data_cols = [c for c in pdf.columns if c != "feed" and c not in ORIGIN]
    pq = A.parquet_stats(spark, parquet_path).agg(F.sum("rows").alias("rows"), F.sum("size").alias("size")).withColumns(
        {"k": F.lit(1), "columns": F.lit(len(data_cols))})
    integ = A.integrity(csv, pq, "k")
    schema = "row int, fields array<string>"
    c_rows = A.first_data_rows(prof.numbered, feed)
    p_rows = A.first_output_rows(spark, parquet_path, data_cols)
    c_prev = spark.createDataFrame([(i + 1, r) for i, r in enumerate(c_rows)], schema)  # <= 20 rows
    p_prev = spark.createDataFrame([(i + 1, r) for i, r in enumerate(p_rows)], schema)
    diff = A.preview_diff(c_prev.withColumn("k", F.lit(1)), p_prev.withColumn("k", F.lit(1)), ["k"])
    ratio = csv.select(F.col("size").alias("c_size"), "k").join(pq.select(F.col("size").alias("p_size"), "k"), "k")
    return (
        integ.join(diff, "k").join(ratio, "k")
        .select("csv_rows", "parquet_rows", "csv_columns", "parquet_columns", "rows_match", "columns_match",
                "rows_compared", "rows_differ", compression_ratio("p_size", "c_size").alias("compression_ratio"))
    )
