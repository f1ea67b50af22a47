"""Roles and turns of chat transcripts by a hidden Markov model.

A transcript is a sequence of pieces of text; its lines are emitted by hidden
states, one for the first line of a turn and one for its other lines, for each
role. A line shows which speaker marker it opens with, how long it is, whether a
blank line stands before it and whether it ends as a question; given the state
these are independent. All tables are smoothed counts over labelled turns.

Viterbi's recursion is a product of (max, +) matrices, so long transcripts are
split: every piece becomes one matrix, pieces of 256 consecutive turns are
multiplied in one task, their products again, level by level, until every
conversation has at most 256 factors. The best path through those fixes the
states at their borders, then inside them, down to the lines: the exact best path
of the whole transcript, with no task holding all of it.

Canonical form of a turn: ``<|role|>``, its lines without the marker, ``<|end|>``,
each on lines of their own. ``rendered`` of the pieces in order, joined, is the
conversation.

Defined results: a NULL text is an empty line; a NULL conv_id is a conversation,
a NULL turn its first; the k-th row with one conv_id and turn (by role and text)
belongs to the k-th copy of that conversation; other roles and NULL teach
nothing; without labelled turns the counts are the smoothing alone; an empty
table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import Scratch

ROLES = ("system", "user", "assistant")
#: State 2r opens a turn of role r, state 2r + 1 goes on in it; the last state is the start.
STATES, START = 2 * len(ROLES) + 1, 2 * len(ROLES)
FACTORS = 256
_SHIFT = 8
_NEVER = -1e30
#: Speaker names by role; a marker is one of them, alone or before ":" and the like.
NAMES = {"system": ("system", "context", "sys"), "user": ("user", "human", "instruction", "question", "prompter", "customer", "q"),
         "assistant": ("assistant", "ai", "bot", "response", "answer", "agent", "model", "gpt", "a")}
_ROLE_OF = {n: r for r, names in enumerate(NAMES.values()) for n in names}
_MARKER = re.compile(r"\s*(?:(?:<\|(?:im_start\|>)?|\[|\(|\*\*|#{1,4}\s*)(?P<dressed>[A-Za-z]+)\s*(?:\|>|\]|\)|:?\*\*|:)?\s*:?|(?P<plain>[A-Za-z]+)\s*[:>])(?:\s+|$)")
#: Kinds of each feature: marker (none, one for each role, another name), length, blank before, question.
_KINDS = (len(ROLES) + 2, 5, 2, 2)


def features(line: str, blank_before: bool) -> tuple[int, int, int, int]:
    m = _MARKER.match(line)
    name = ((m["dressed"] or m["plain"]) if m else "").lower()
    marker = _ROLE_OF[name] + 1 if name in _ROLE_OF else len(ROLES) + 1 if name else 0
    text = line.strip()
    size = 0 if not text else 1 + (len(text) > 40) + (len(text) > 120) + (len(text) > 400)
    return marker, size, int(blank_before), int(text.endswith("?"))


def piece_features(text: str | None) -> list[tuple[int, int, int, int]]:
    lines = (text or "").split("\n")
    return [features(x, i > 0 and not lines[i - 1].strip()) for i, x in enumerate(lines)]


def _opening(lines: list) -> int:
    """Blank lines before a turn belong to the turn before it."""
    return next((i for i, f in enumerate(lines) if f[1]), 0)


class Model:
    """Log-probabilities of steps between states and of features in them."""

    def __init__(self, steps: np.ndarray, seen: list[np.ndarray]):
        allowed = np.zeros((STATES, STATES), bool)
        for r in range(len(ROLES)):
            allowed[:, 2 * r] = True
            allowed[[2 * r, 2 * r + 1], 2 * r + 1] = True
        allowed[START, 1::2] = False
        allowed[START, 0:START:2] = True
        p = np.where(allowed, steps + 0.5, 0)
        self.steps = np.where(allowed, np.log(np.maximum(p, 1e-12) / p.sum(1, keepdims=True)), _NEVER)
        # blank lines may open a transcript before any turn
        self.steps[START, START] = np.log(0.5)
        self.emit = [np.log((x + 0.5) / (x + 0.5).sum(1, keepdims=True)) for x in seen]

    def line(self, f: tuple[int, int, int, int]) -> np.ndarray:
        """Log-likelihood of a line in each state."""
        out = sum(table[:, k] for table, k in zip(self.emit, f, strict=True))
        return np.r_[out, 0.0 if not f[1] else _NEVER]

    def product(self, lines: list) -> np.ndarray:
        out = np.where(np.eye(STATES, dtype=bool), 0.0, _NEVER)
        for f in lines:
            out = times(out, self.steps + self.line(f))
        return out

    def path(self, lines: list, first: int, last: int) -> list[int]:
        """Best states of the lines after state ``first``, the last of them ``last``."""
        best, back = self.steps[first] + self.line(lines[0]), []
        for f in lines[1:]:
            way = best[:, None] + self.steps
            back.append(way.argmax(0))
            best = way.max(0) + self.line(f)
        out = [last]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a[:, :, None] + b[None]).max(1), _NEVER)


def through(factors: list[np.ndarray], first: int, last: int | None) -> list[int]:
    """Best states at the ends of the factors, from state ``first`` to ``last`` (None: the best)."""
    best, back = factors[0][first], []
    for m in factors[1:]:
        way = best[:, None] + m
        back.append(way.argmax(0))
        best = way.max(0)
    out = [int(best.argmax()) if last is None else last]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


def train(pieces: DataFrame) -> Model:
    """From labelled turns (conv, copy, turn, role, text); what comes to the driver is a fixed number of sums."""
    known = pieces.where(F.col("role").isin(*ROLES)).select("conv", "copy", "turn", "role", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, seen = np.zeros((STATES, STATES), np.int64), [np.zeros((START, k), np.int64) for k in _KINDS]
        for batch in batches:
            for r in batch.to_pylist():
                lines, role = piece_features(r["text"]), ROLES.index(r["role"])
                opening = _opening(lines)
                for i, f in enumerate(lines[opening:]):
                    state = 2 * role + (i > 0)
                    for table, k in zip(seen, f, strict=True):
                        table[state, k] += 1
                    if i:
                        steps[2 * role + (i > 1), state] += 1
                for f in lines[:opening]:
                    for s in range(1, START, 2):
                        for table, k in zip(seen, f, strict=True):
                            table[s, k] += 1
                    for s in range(START):
                        steps[s, s // 2 * 2 + 1] += 1
        flat = np.concatenate([steps.ravel(), *[t.ravel() for t in seen]])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(flat[at])], ["at", "n"])

    flat = np.zeros(STATES * STATES + START * sum(_KINDS))
    for r in known.mapInArrow(count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        flat[r["at"]] = r["n"]
    steps = flat[:STATES * STATES].reshape(STATES, STATES)
    seen, pos = [], STATES * STATES
    for k in _KINDS:
        seen.append(flat[pos:pos + START * k].reshape(START, k))
        pos += START * k
    after = known.select("conv", "copy", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"))
    same = [known[c].eqNullSafe(after[c]) for c in ("conv", "copy", "turn")]
    for r in known.join(after, same, "left").groupBy("before", "role").count().collect():
        to = 2 * ROLES.index(r["role"])
        if r["before"] is None:
            steps[START, to] += r["count"]
        else:
            steps[[2 * ROLES.index(r["before"]), 2 * ROLES.index(r["before"]) + 1], to] += r["count"]
    return Model(steps, seen)


def _numbered(rows: DataFrame, *carry: str) -> DataFrame:
    """Pieces with conv, copy and turn of the rules in the module's text."""
    turn = F.coalesce(F.col("turn").cast("bigint"), F.lit(-1))
    copies = Window.partitionBy("conv_id", turn).orderBy("role", "text")
    return rows.select(F.col("conv_id").alias("conv"), F.row_number().over(copies).alias("copy"), turn.alias("turn"),
                       F.col("turn").alias("given_turn"), "role", "text", *carry)


def _matrices(x) -> list[np.ndarray]:
    return [np.array(m).reshape(STATES, STATES) for m in x.to_pylist()]


def recover(pieces: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """``pieces`` (conv, copy, turn, given_turn, role, text) with the roles found in each and its canonical form."""
    conv = dict(pieces.dtypes)["conv"]
    given = dict(pieces.dtypes)["given_turn"]
    key = f"conv {conv}, copy int"

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [model.product(piece_features(t.as_py())).ravel() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in ("conv", "copy", "turn")] + [pa.array(made, pa.list_(pa.float64()))],
                                             ["conv", "copy", "node", "m"])

    def multiply(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        m = None
        for x in _matrices(group.column("m")):
            m = x if m is None else times(m, x)
        head = group.slice(0, 1)
        return pa.table({"conv": head.column("conv"), "copy": head.column("copy"), "node": head.column("up"), "m": pa.array([m.ravel()], pa.list_(pa.float64()))})

    rise = F.shiftright("node", _SHIFT)
    levels = [scratch.save(pieces.select("conv", "copy", "turn", "text").mapInArrow(factor, f"{key}, node bigint, m array<double>"))]
    while True:
        widest = levels[-1].groupBy("conv", "copy").count().agg(F.max("count")).head()[0] or 0
        if widest <= FACTORS:
            break
        levels.append(scratch.save(levels[-1].withColumn("up", rise).groupBy("conv", "copy", "up").applyInArrow(multiply, f"{key}, node bigint, m array<double>")))

    border = f"{key}, node bigint, first int, last int, opens boolean, closes boolean"

    def borders(group: pa.Table, first: int, last: int | None, opens: bool, closes: bool) -> pa.Table:
        group = group.sort_by("node")
        ends = through(_matrices(group.column("m")), first, last)
        n = group.num_rows
        return pa.table({"conv": group.column("conv"), "copy": group.column("copy"), "node": group.column("node"),
                         "first": pa.array([first, *ends[:-1]], pa.int32()), "last": pa.array(ends, pa.int32()),
                         "opens": pa.array([opens and i == 0 for i in range(n)]), "closes": pa.array([closes and i == n - 1 for i in range(n)])})

    def inside(group: pa.Table, above: pa.Table) -> pa.Table:
        a = above.to_pylist()[0]
        return borders(group.drop_columns(["up"]), a["first"], a["last"], a["opens"], a["closes"])

    state = scratch.save(levels.pop().groupBy("conv", "copy").applyInArrow(lambda g: borders(g, START, None, True, True), border))
    while levels:
        level = levels.pop().withColumn("up", rise)
        above = state.withColumnRenamed("node", "up")
        state = scratch.save(level.groupBy("conv", "copy", "up").cogroup(above.groupBy("conv", "copy", "up")).applyInArrow(inside, border))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, turns, rendered = [], [], []
            for r in batch.to_pylist():
                lines = (r["text"] or "").split("\n")
                path = model.path(piece_features(r["text"]), r["first"], r["last"])
                found, text = [], []
                for x, s in zip(lines, path, strict=True):
                    if s == START:
                        continue
                    opens = s % 2 == 0
                    if opens:
                        if found or not r["opens"] and r["first"] != START:
                            while text and not text[-1].strip():  # blank lines between turns go
                                text.pop()
                            text.append("<|end|>")
                        found.append(ROLES[s // 2])
                        text.append(f"<|{found[-1]}|>")
                        m = _MARKER.match(x)
                        if m and ((m["dressed"] or m["plain"]).lower() in _ROLE_OF):
                            x = x[m.end():]
                            if not x:
                                continue
                    text.append(x)
                if r["closes"]:
                    while text and not text[-1].strip():
                        text.pop()
                    text.append("<|end|>")
                roles.append(found)
                turns.append(len(lines))
                rendered.append("".join(f"{t}\n" for t in text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in ("conv", "given_turn", "role")] + [pa.array(roles, pa.list_(pa.string())), pa.array(turns, pa.int64()), pa.array(rendered, pa.string())],
                ["conv_id", "turn", "role", "roles", "n_lines", "rendered"])

    at = state.withColumnsRenamed({"conv": "_conv", "copy": "_copy", "node": "_node"})
    same = pieces["conv"].eqNullSafe(at["_conv"]) & (pieces["copy"] == at["_copy"]) & (pieces["turn"] == at["_node"])
    return pieces.join(at, same).select("conv", "given_turn", "role", "text", "first", "last", "opens", "closes").mapInArrow(
        render, f"conv_id {conv}, turn {given}, role string, roles array<string>, n_lines bigint, rendered string")


#: How a transcript may show its speakers; the last shows none.
STYLES = [{"system": "System: ", "user": "User: ", "assistant": "Assistant: "}, {"system": "[System] ", "user": "Human: ", "assistant": "AI: "},
          {"system": "### System:\n", "user": "### Instruction:\n", "assistant": "### Response:\n"},
          {"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n"}, {"system": "Context: ", "user": "Q: ", "assistant": "A: "},
          {"system": "", "user": "", "assistant": ""}]


def transcripts(conversations: DataFrame) -> DataFrame:
    """The turns of ``conversations`` as pieces of raw transcripts, in a style for each conversation."""
    rows = _numbered(conversations.select("conv_id", "turn", "role", "text"))
    style = F.pmod(F.xxhash64("conv"), F.lit(len(STYLES)))
    marker = F.lit("")
    for i, s in enumerate(STYLES):
        for role, text in s.items():
            marker = F.when((style == i) & (F.col("role") == role), text).otherwise(marker)
    between = F.when(F.col("turn") > 0, "\n").otherwise("")
    return rows.withColumn("text", F.concat(between, marker, F.coalesce("text", F.lit(""))))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Raw transcripts of all conversations, their roles recovered by a model that learns from
    the conversations outside fold 2 of 4."""
    scratch = Scratch(conversations.sparkSession, "chat")
    pieces = scratch.save(transcripts(conversations))
    taught = F.crc32(F.coalesce(F.col("conv").cast("string"), F.lit(""))) % 4 != 2
    return recover(pieces, train(pieces.where(taught)), scratch)
