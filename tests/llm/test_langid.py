import random

import numpy as np

from quayside.llm.langid import held_out_identify, identify, mixture, train

SYLLABLES = {"aa": ["la", "ri", "mo", "ta", "né"], "bb": ["sch", "ung", "ver", "keit", "ß"], "cc": ["th", "ing", "ea", "nd", "wh"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def rows(seed=1, n=240):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        out.append((i, sentence(rng, lang, rng.randrange(8, 80)), lang))
    return out


def test_held_out_accuracy_and_contract(spark):
    data = rows()
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, " 12 !! ", "cc"), (1003, sentence(random.Random(2), "aa", 30), None), (None, sentence(random.Random(3), "bb", 30), "bb"), (1003, None, None)]
    docs = spark.createDataFrame([(*r, "s", 0.5) for r in data + odd], "doc_id bigint, text string, lang string, source string, score double").repartition(3)
    got = held_out_identify(docs.select("doc_id", "text", "lang")).collect()
    assert len(got) == len(data) + len(odd)
    truth = {i: lang for i, _, lang in data}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 for r in got)
    by_id = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in got}
    assert all(by_id[i, t] == ("und", 0.0) for i, t, _ in odd[:3])
    assert by_id[1003, odd[3][1]][0] == "aa" and by_id[None, odd[4][1]][0] == "bb"


def test_mixture_finds_both_languages(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame(rows(), "doc_id bigint, text string, lang string")
    model = train(docs)
    mixed = [(1, sentence(rng, "aa", 60) + " " + sentence(rng, "bb", 30)), (2, sentence(rng, "cc", 40))]
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(spark.createDataFrame(mixed, "doc_id bigint, text string"), model).collect()}
    assert got[1][0] == "aa" and 0.55 < got[1][1] < 0.8
    assert got[2][0] == "cc" and got[2][1] > 0.99


def test_penalised_selection_drops_languages_without_evidence():
    like = np.log(np.tile([[0.7, 0.3]], (200, 1))).astype(np.float32)
    pi = mixture(like, np.zeros(200, int), 2)
    assert pi[0].tolist() == [1.0, 0.0]
    even = np.log(np.array([[0.99, 0.01], [0.01, 0.99]] * 100)).astype(np.float32)
    assert abs(mixture(even, np.zeros(200, int), 1)[0, 0] - 0.5) < 0.01


def test_nothing_learned_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert [(r.lang_pred, r.score) for r in held_out_identify(docs).collect()] == [("und", 0.0)]
    assert held_out_identify(docs.limit(0)).collect() == []
