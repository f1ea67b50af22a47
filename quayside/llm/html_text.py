"""Main text of web pages by differencing with the page of nearest URL.

1. A page becomes lines: one for each block, character references decoded, white
   space one space. Each line knows whether it is inside ``article`` or ``main``
   and whether an element around it is named (by HTML or its class or id) as
   something else than main text: navigation, header, footer, aside, form, advert,
   notice, comments and so on.
2. The distinct pages of a host are put in order of URL path. Each is paired
   with the neighbour that shares the longer path with it (the one before it on
   ties). The order is a range sort over all hosts, so a host that holds most
   pages is spread over many tasks; neighbours across task borders are found by
   row number.
3. All lines of a pair are aligned by longest common subsequence. Shared lines
   belong to the site, not the page: they are deleted, inside ``article`` and
   ``main`` and outside. A pair that shares more than half of the page's text is
   one page twice and says nothing; then the other neighbour is taken.
4. Names supplement the difference. What an HTML element says of itself always
   counts (``nav``, ``footer``, ``aside``), however much text it holds. A class, an id or
   a ``form`` counts too, but not around the page's ``main`` element or ``h1`` (a wrapper
   named after one of its parts, a page that is one form), and not where nothing would
   be left. If both neighbours are the page twice, ``article`` and ``main`` with more than
   half of the text keep theirs and lose the shared lines around them.

Copies of a page on a host count once in the order and get the same result.
Lines outside an ``article`` or ``main`` element are text unless shared or named.

Defined results: NULL or empty html has the empty text; a NULL or odd url is a
host of its own ('' and the whole url as path); rows that repeat a page_id are
pages of their own; unclosed or cut-off markup ends with the page; an empty
table gives an empty table.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import Scratch

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|noscript|template|svg|iframe|object|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|<(?=/?[a-zA-Z])[^>]*(?:>|\Z)", re.S | re.I)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot "
    "thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NOT_MAIN = frozenset("head nav header footer aside form menu dialog select button datalist audio video canvas map".split())
_MAIN = frozenset(("article", "main"))
_NAMED = re.compile(r"(?:\b(?:class|id|role)\s*=\s*)(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
#: Words of a class, id or role that name something else than main text.
_OTHER = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies disqus footer header masthead menu nav navbar navigation newsletter notice notices popup promo promotion "
    "related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget "
    "widgets contentinfo complementary alert".split())
#: Kinds of lines: in none of these elements, inside article or main, inside an element named as something else.
PLAIN, MAIN, OTHER = 0, 1, 2
BY_TAG, BY_CLASS = 1, 2
#: Elements that a page has once, in its main part.
_HEART = frozenset(("main", "h1"))
#: Void of end tags: an opening tag of the key closes an open one of the values.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",)}


def _other(name: str, attrs: str) -> int:
    """Whether an element is named as something else: BY_TAG, BY_CLASS or neither (0)."""
    if name in _NOT_MAIN:
        return BY_TAG if name != "form" else BY_CLASS
    if name in ("html", "body", "article", "main") or not attrs:
        return 0
    words = {w for m in _NAMED.finditer(attrs) for w in re.split(r"[^a-z]+", (m[1] or m[2] or m[3] or "").lower())}
    return BY_CLASS if words & _OTHER or _HIDDEN.search(attrs) else 0


def _scan(page: str, doubted: set[int] | None) -> tuple[list[str], list[int], set[int]]:
    """Lines, their kinds, and the elements named by class around the page's main element or heading.

    ``doubted`` elements (by their number; None for all that are named by class) count as not named.
    """
    lines: list[str] = []
    kinds: list[int] = []
    buffer: list[str] = []
    beside: list[str] = []  # of elements left out inside a line
    stack: list[tuple[str, int, bool, bool]] = []  # name, number if named by class, starts what is left out, is main
    around: set[int] = set()
    out = inside = named = 0

    def end(buffer: list[str], kind: int):
        text = " ".join(html_lib.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            lines.append(text)
            kinds.append(kind)

    def end_block():
        end(beside, OTHER)
        end(buffer, MAIN if inside else PLAIN)

    def put(text: str):
        (beside if out else buffer).append(text)

    def pop():
        nonlocal out, inside
        _, _, a, b = stack.pop()
        out -= a
        inside -= b
        if a and not out:
            end(beside, OTHER)

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            put(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            (beside if out else buffer).append(" ")
            continue
        if name in _BLOCKS:
            end_block()
        elif name in ("td", "th"):
            (beside if out else buffer).append(" ")
        if m["close"]:
            if any(x[0] == name for x in stack):
                while stack[-1][0] != name:
                    pop()
                pop()
        elif name not in _VOID and not m["attrs"].endswith("/"):
            if name == "body":
                while stack and stack[-1][0] == "head":
                    pop()
            if stack and stack[-1][0] in _CLOSES.get(name, ()):
                pop()
            if name == "p":
                continue  # p has no nesting; its blocks end at every block tag
            if name in _HEART:
                around.update(x[1] for x in stack if x[1] >= 0)
            by, number = _other(name, m["attrs"]), -1
            if by == BY_CLASS:
                number, named = named, named + 1
            a = by == BY_TAG or by == BY_CLASS and doubted is not None and number not in doubted
            b = name in _MAIN
            stack.append((name, number, a, b))
            out += a
            inside += b
    if at < len(page):
        put(page[at:])
    end_block()
    while stack:
        pop()
    return lines, kinds, around


def page_lines(page: str | None) -> tuple[list[str], list[bool]]:
    """Lines of a page without what its markup names as other, and whether each is marked as main."""
    lines, kinds, _ = _scan(page or "", set())
    own = [i for i, k in enumerate(kinds) if k != OTHER]
    return [lines[i] for i in own], [kinds[i] == MAIN for i in own]


def marked_lines(page: str | None) -> tuple[list[str], list[int]]:
    """All lines of a page and their kinds."""
    page = page or ""
    lines, kinds, around = _scan(page, set())
    if around:
        lines, kinds, _ = _scan(page, around)
    if lines and all(k == OTHER for k in kinds):
        lines, kinds, _ = _scan(page, None)
    return lines, kinds


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, kinds = [], []
        for page in batch.column(2):
            a, b = marked_lines(page.as_py())
            lines.append(a)
            kinds.append(b)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lines, pa.list_(pa.string())), pa.array(kinds, pa.list_(pa.int8()))],
            ["page_id", "url", "lines", "kinds"])


def _rows(a: list, b: list) -> list[int]:
    """Bit-parallel LCS: after each element of ``a`` the bits of ``b`` where the length does not grow."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, out = full, []
    for x in a:
        u = v & places.get(x, 0)
        v = (v + u | v - u) & full
        out.append(v)
    return out


def _lengths(a: list, b: list) -> np.ndarray:
    """LCS length of all of ``a`` with each prefix of ``b``."""
    v = (_rows(a, b) or [(1 << len(b)) - 1])[-1]
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.r_[0, np.cumsum(1 - bits.astype(np.int64))]


def shared(a: list, b: list, at: int = 0, cells: int = 1 << 28) -> list[int]:
    """Places in ``a`` of one longest common subsequence with ``b``; in parts of bounded memory."""
    if not a or not b:
        return []
    if len(a) * len(b) > cells and len(a) > 1:
        half = len(a) // 2
        cut = int((_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]).argmax())
        return shared(a[:half], b[:cut], at, cells) + shared(a[half:], b[cut:], at + half, cells)
    rows, i, j, out = _rows(a, b), len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            j -= 1
            out.append(at + i)
    return out[::-1]


def _common(a: str, b: str) -> int:
    """Leading path segments in common, then leading characters of the next."""
    x, y = a.split("/"), b.split("/")
    n = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
    p, q = ("/".join(x[n:n + 1]), "/".join(y[n:n + 1]))
    return n * 10_000 + next((i for i, (c, d) in enumerate(zip(p, q, strict=False)) if c != d), min(len(p), len(q)))


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        host, page, gone = [], [], []
        for r in batch.to_pylist():
            own, kinds = r["hashes"], r["kinds"]
            sizes = [0 if k == OTHER else n for n, k in zip(r["sizes"], kinds, strict=True)]
            others = [(-_common(r["path"], r[f"{k}_path"]), n, r[f"{k}_hashes"]) for n, k in enumerate(("before", "after")) if r[f"{k}_path"] is not None]
            pairs = [shared(own, lines) for _, _, lines in sorted(others, key=lambda x: x[:2])]
            same = next((x for x in pairs if 2 * sum(sizes[i] for i in x) <= sum(sizes)), None)
            if same is None and 2 * sum(n for n, k in zip(sizes, kinds, strict=True) if k == MAIN) > sum(sizes):
                same = [i for i in (pairs or [[]])[0] if kinds[i] != MAIN]
            same = [i for i in same or () if kinds[i] != OTHER]
            if same:
                host.append(r["host"])
                page.append(r["content"])
                gone.append(same)
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(page, pa.int64()), pa.array(gone, pa.list_(pa.int32()))],
                                         ["host", "content", "gone"])


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text."""
    scratch = Scratch(pages.sparkSession, "html")
    types = dict(pages.dtypes)
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*|[?#].*$", ""), r"(?:\.html?|/)+$", "")
    parsed = pages.select("page_id", "url", "html").mapInArrow(
        _parse, f"page_id {types['page_id']}, url {types['url']}, lines array<string>, kinds array<tinyint>")
    parsed = scratch.save(parsed.select("page_id", "url", "lines", "kinds", host.alias("host"), path.alias("path"),
                                        F.xxhash64("lines", "kinds").alias("content")))

    line = F.struct("path", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"),
                    F.transform("lines", lambda x: F.length(x)).alias("sizes"), "kinds")
    distinct = parsed.groupBy("host", "content").agg(F.min(line).alias("page")).select(
        "host", "content", "page.path", "page.hashes", "page.sizes", "page.kinds")
    ordered = scratch.save(distinct.repartitionByRange("host", "path", "content").sortWithinPartitions("host", "path", "content")
                           .withColumn("row", F.monotonically_increasing_id()))
    part = F.shiftright("row", 33)
    ends = ordered.groupBy(part.alias("part")).agg(F.min("row").alias("first"), F.max("row").alias("last"))
    tasks = Window.orderBy("part")  # one row for each task of the sort
    ends = F.broadcast(ends.select("part", "first", "last", F.lag("last").over(tasks).alias("end_before"), F.lead("first").over(tasks).alias("start_after")))
    before = F.when(F.col("row") == F.col("first"), F.col("end_before")).otherwise(F.col("row") - 1)
    after = F.when(F.col("row") == F.col("last"), F.col("start_after")).otherwise(F.col("row") + 1)
    to = {"own": F.col("row"), "before": after, "after": before}  # a page is what lies before the next one
    sent = (ordered.withColumn("part", part).join(ends, "part")
            .withColumn("to", F.explode(F.array(*[F.struct(F.lit(k).alias("side"), v.alias("row")) for k, v in to.items()]))).where("to.row is not null"))
    one = {k: F.max(F.when(F.col("to.side") == k, F.struct("host", "path", "hashes", *(("content", "sizes", "kinds") if k == "own" else ())))).alias(k)
           for k in to}
    own = F.col("to.side") == "own"
    sent = sent.select("to", "host", "path", "hashes", *[F.when(own, F.col(c)).alias(c) for c in ("content", "sizes", "kinds")])
    pairs = sent.groupBy("to.row").agg(*one.values())
    gone = pairs.select("own.*", *[F.when(F.col(f"{k}.host") == F.col("own.host"), F.col(f"{k}.{c}")).alias(f"{k}_{c}")
                                   for k in ("before", "after") for c in ("path", "hashes")])
    gone = scratch.save(gone.mapInArrow(_difference, "host string, content bigint, gone array<int>"))
    out = parsed.join(gone, ["host", "content"], "left")
    kept = F.filter("lines", lambda x, i: (F.get("kinds", i) != OTHER) & (F.col("gone").isNull() | ~F.array_contains("gone", i)))
    return out.select("page_id", "url", F.array_join(kept, "\n").alias("text"))
