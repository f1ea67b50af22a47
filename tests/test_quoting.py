"""Vectors, and split against an independent state machine."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions.quoting import encode_csv, split_quoted

# (line, base fields, repair fields), delimiter ","
VECTORS = [
    ("", [""], [""]),
    ("a,", ["a", ""], ["a", ""]),
    ('"x,y",z', ["x,y", "z"], ["x,y", "z"]),
    ('"a""b",c', ['a"b', "c"], ['a"b', "c"]),
    ('a"b,c', ['a"b', "c"], ['a"b', "c"]),
    ('"c"d",e', ['c"d', "e"], ['c"d', "e"]),
    ('"",z', ["", "z"], ["", "z"]),
    (' "q",z', [' "q"', "z"], [' "q"', "z"]),
    ('"open,x', ["open,x"], ["open,x"]),
    ('""abc,q', ['"abc,q'], ['"abc,q']),
    ('"6"",Flop,1', ['6",Flop,1'], ['6"', "Flop", "1"]),
    ('"a"",b",c', ['a",b', "c"], ['a"', 'b"', "c"]),
]


def machine(line: str, d: str, repair: bool) -> list[str]:
    """The dialect rules as an explicit three-state machine (test oracle)."""
    out, buf, state, i = [], "", "start", 0
    while i < len(line):
        ch = line[i]
        at_end_or_delim = lambda j: j >= len(line) or line[j] == d
        if state in ("start", "plain"):
            if ch == d:
                out.append(buf)
                buf, state = "", "start"
            elif ch == '"' and state == "start":
                state = "quoted"
            else:
                buf += ch
                state = "plain"
            i += 1
            continue
        # quoted
        if ch != '"':
            buf += ch
            i += 1
        elif i + 1 < len(line) and line[i + 1] == '"':
            buf += '"'
            i += 2
            if repair and at_end_or_delim(i):
                state = "plain"
        elif at_end_or_delim(i + 1):
            state = "plain"
            i += 1
        else:
            buf += '"'
            i += 1
    out.append(buf)
    return out


def test_machine_matches_vectors():
    for line, base, rep in VECTORS:
        assert machine(line, ",", False) == base, line
        assert machine(line, ",", True) == rep, line


def test_split_vectors(spark):
    df = spark.createDataFrame([(v[0],) for v in VECTORS], ["v"])
    got = df.select("v", split_quoted("v", ",", False).alias("b"), split_quoted("v", ",", True).alias("r")).collect()
    by_line = {r["v"]: (list(r["b"]), list(r["r"])) for r in got}
    for line, base, rep in VECTORS:
        assert by_line[line] == (base, rep), line


def test_split_random_lines_both_dialects_and_delimiters(spark):
    rng = random.Random(7)
    rows = []
    for d in [",", ";", "|", "\t"]:
        alphabet = ['a', 'b', '"', d, ' ']
        for _ in range(1500):
            n = rng.randint(0, 14)
            rows.append((d, "".join(rng.choice(alphabet) for _ in range(n))))
    df = spark.createDataFrame(rows, ["d", "v"])
    for d in [",", ";", "|", "\t"]:
        sub = df.filter(F.col("d") == d)
        res = sub.select("v", split_quoted("v", d, False).alias("b"), split_quoted("v", d, True).alias("r")).collect()
        for r in res:
            assert list(r["b"]) == machine(r["v"], d, False), (d, r["v"])
            assert list(r["r"]) == machine(r["v"], d, True), (d, r["v"])


def test_long_lines(spark):
    long_plain = ",".join(["x" * 50] * 2000)
    many_quotes = '"' + '""' * 3000 + '",z'
    big_quoted = ",".join(['"a,b"'] * 2000)
    df = spark.createDataFrame([(long_plain,), (many_quotes,), (big_quoted,)], ["v"])
    res = df.select("v", split_quoted("v", ",", True).alias("f")).collect()
    for r in res:
        assert list(r["f"]) == machine(r["v"], ",", True)


ENCODE = [
    (["a", "b"], "a;b"),
    (["a;b", "c"], '"a;b";c'),
    (['x"y'], '"x""y"'),
    ([""], '""'),
    (["", ""], ";"),
    (["a\nb"], '"a\nb"'),
    (["a\rb", ""], '"a\rb";'),
    ([" lead", "trail "], " lead;trail "),
]


def test_encode_vectors(spark):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(ENCODE)], "i int, f array<string>")
    got = {r["i"]: r["e"] for r in df.select("i", encode_csv("f", ";").alias("e")).collect()}
    for i, (_, want) in enumerate(ENCODE):
        assert got[i] == want


field = st.text(alphabet=st.sampled_from(list('ab ;",x')), max_size=8)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(field, min_size=1, max_size=6), min_size=1, max_size=40))
def test_split_inverts_encode(spark, records):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, f array<string>")
    back = df.select("i", "f", split_quoted(encode_csv("f", ";"), ";", False).alias("g")).collect()
    for r in back:
        assert list(r["g"]) == list(r["f"])
