import random

import numpy as np
import pytest

from quayside.llm import byte_bpe
from quayside.llm.byte_bpe import Codec, Encoded, Pieces, Prefixes, Vocabulary, cutter, read_ranks, split_table

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
NAME = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(P.path(NAME))


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return Vocabulary(ranks, split_table(ranks))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(seed, n):
    rng = random.Random(seed)
    kinds = [lambda: rng.choice("ab "), lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xC0, 0x250), rng.randrange(0x4E00, 0x9FFF)])),
             lambda: rng.choice(["  ", "\n", "\t", "'s", "'ll", "aaaa", "0000", " the", "ing", " ", "\u0085", "é", "<|endoftext|>", "\U00016EA7", "՘"])]
    return ["".join(kind() for _ in range(rng.randrange(1, 40))) for kind in kinds for _ in range(n)]


def test_equals_the_library(spark, library):
    texts = odd_texts(1, 300) + ["", None, "a" * 70_000, " " * 5_000, "word " * 300_000 + "end", "\U00016EA7" * 300_000]
    rows = [(i, t, 1, b"x") for i, t in enumerate(texts)] + [(None, "no id", 1, b"x"), (0, texts[0], 1, b"x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id int, ids binary").repartition(4)
    codec = Codec(spark, P.path(NAME), P.PATTERN)
    got = codec.decode_ids(codec.encode_texts(docs)).collect()
    want = sorted((-1 if i is None else i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got) == want
    assert codec.encode_texts(docs.limit(0)).collect() == []


def test_every_token_is_reached_and_every_character_is_cut_alike(ranks, vocabulary, library):
    assert set(vocabulary.split) == set(ranks.values())
    pieces, cut = Pieces(vocabulary), cutter(P.PATTERN)
    for start in range(0x80, 0x33500, 64):
        text = "".join(f"a{chr(c)}a {chr(c)}1{chr(c)} " for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(b"".join(map(pieces.__getitem__, cut.findall(text))), "<u4").tolist() == library.encode_ordinary(text)


def test_appends_and_edits(vocabulary, library):
    rng = random.Random(3)
    parts = ["a", "'", "l", "s", " ", "1", "\n", "é", "the "]
    for _ in range(400):
        text = Encoded(vocabulary, P.PATTERN, "".join(rng.choice(parts) for _ in range(rng.randrange(30))))
        for _ in range(4):
            a = rng.randrange(len(text.text) + 1)
            b = rng.randrange(a, len(text.text) + 1)
            new = "".join(rng.choice(parts) for _ in range(rng.randrange(5)))
            if rng.random() < 0.3:
                text.append(new)
            else:
                text.replace(a, b, new)
            assert text.tokens() == library.encode_ordinary(text.text)


def test_prefixes_are_all_encoded_and_cut_keeps_them(vocabulary, library):
    data = b"unbelievablyunbelievable"
    table = Prefixes(vocabulary, data)
    for n in range(len(data), 0, -1):
        table.cut(n)
        assert table.tokens() == Prefixes(vocabulary, data[:n]).tokens() == library.encode_ordinary(data[:n].decode())


def test_memory_of_pieces_is_bounded(monkeypatch, vocabulary, library):
    monkeypatch.setattr(byte_bpe, "CACHED", 8)
    monkeypatch.setattr(byte_bpe, "PAIRS", 8)
    pieces = Pieces(vocabulary)
    for i in range(30):
        word = f"word{i}xyz"
        pieces.learn({word, "x" * 60})
        assert len(pieces) <= 10 and len(pieces.old) <= 10
        assert np.frombuffer(pieces["abc"], "<u4").tolist() == library.encode_ordinary("abc")


def test_unknown_bytes_and_large_files(tmp_path, monkeypatch):
    small = {b"a": 0, b"b": 1, b"ab": 2}
    v = Vocabulary(small, split_table(small))
    assert Prefixes(v, b"abba").tokens() == [2, 1, 0]
    with pytest.raises(ValueError, match="cannot encode"):
        Prefixes(v, b"abc")
    path = tmp_path / "ranks"
    path.write_text("YQ== 0\n")
    assert read_ranks(str(path)) == {b"a": 0}
    monkeypatch.setattr(byte_bpe, "VOCABULARY_BYTES", 3)
    with pytest.raises(ValueError, match="too large"):
        read_ranks(str(path))
