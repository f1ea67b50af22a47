import itertools
import random

import numpy as np

from quayside.llm import chat
from quayside.llm.chat import ROLES, START, STATES, Model, features, format_chats, piece_features
from quayside.llm.common import Scratch


def conversations(seed=1, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    out = []
    for c in range(n):
        turn = 0
        if rng.random() < 0.3:
            out.append((c, turn, "system", " ".join(word() for _ in range(4)) + "."))
            turn += 1
        for k in range(rng.randrange(1, 6)):
            role = ROLES[1 + k % 2]
            lines = [" ".join(word() for _ in range(rng.randrange(3, 9) * (1 if role == "user" else 6))) + ("?" if role == "user" else ".") for _ in range(rng.randrange(1, 4))]
            out.append((c, turn, role, "\n".join(lines)))
            turn += 1
    return out


def test_roles_are_recovered(spark):
    data = conversations()
    odd = [(500, 0, "user", None), (None, None, "user", "hello there?"), (500, 0, "user", None), (501, 0, None, "Human: hi"), (501, 1, "tool", "AI: yes. Human: no")]
    df = spark.createDataFrame([(*x, 1, "r") for x in data + odd], "conv_id bigint, turn bigint, role string, text string, copy int, rendered string").repartition(3)
    got = format_chats(df).collect()
    assert len(got) == len(data) + len(odd)
    known = [r for r in got if r.conv_id is not None and r.conv_id < 500]
    right = [r.roles == [r.role] for r in known]
    assert sum(right) / len(right) > 0.97
    whole = {}
    for r in sorted(known, key=lambda r: (r.conv_id, r.turn)):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.rendered
    texts = {}
    for c, _, role, text in data:
        texts[c] = texts.get(c, "") + f"<|{role}|>\n{text}\n<|end|>\n"
    good = {r.conv_id for r, ok in zip(known, right, strict=True) if ok} - {r.conv_id for r, ok in zip(known, right, strict=True) if not ok}
    assert all(whole[c] == texts[c] for c in good)


def brute(model, lines):
    best = None
    for path in itertools.product(range(STATES), repeat=len(lines)):
        score, s = 0.0, START
        for f, t in zip(lines, path, strict=True):
            score, s = score + model.steps[s, t] + model.line(f)[t], t
        if best is None or score > best[0]:
            best = (score, path)
    return best


def test_split_viterbi_is_exact(spark, monkeypatch):
    monkeypatch.setattr(chat, "FACTORS", 2)
    monkeypatch.setattr(chat, "_SHIFT", 1)
    rng = np.random.default_rng(3)
    model = Model(rng.integers(0, 50, (STATES, STATES)), [rng.integers(0, 50, (START, k)) for k in chat._KINDS])
    texts = ["User: hi", "\nanswer one?", "", "Q: x\n\nlong " + "y " * 40, "plain?", "\nSystem: z"]
    pieces = spark.createDataFrame([(1, 1, i, i, "user", t) for i, t in enumerate(texts)], "conv bigint, copy int, turn bigint, given_turn bigint, role string, text string")
    got = {r.turn: r for r in chat.recover(pieces, model, Scratch(spark, "test")).collect()}
    lines = [f for t in texts for f in piece_features(t)]
    # all lines at once, by plain Viterbi
    score = model.steps[START] + model.line(lines[0])
    back = []
    for f in lines[1:]:
        way = score[:, None] + model.steps
        back.append(way.argmax(0))
        score = way.max(0) + model.line(f)
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path = path[::-1]
    short = [f for t in texts[:3] for f in piece_features(t)]
    assert brute(model, short)[0] == max((model.product(short)[START]))
    at = 0
    for i, t in enumerate(texts):
        n = len(t.split("\n"))
        assert got[i].roles == [ROLES[s // 2] for s in path[at:at + n] if s % 2 == 0 and s != START]
        at += n


def test_markers_and_empty_table(spark):
    marker = lambda x: features(x, False)[0]
    assert [marker(x) for x in ("User: hi", "### Response:", "<|system|>", "[System] x", "Note: y", "plain text", "A: b", "Q> c", "**Assistant:** x")] == [2, 3, 1, 1, 4, 0, 3, 2, 3]
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert format_chats(df).collect() == []
