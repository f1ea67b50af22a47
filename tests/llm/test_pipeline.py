import os
import random

import corpus_pipeline as cp
from quayside.llm.queries import ORACLE, QUERIES

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(seed=1):
    rng = random.Random(seed)
    word = {"en": lambda: "".join(rng.choice(["th", "ing", "ea", "nd", "wh"]) for _ in range(rng.randrange(1, 4))),
            "de": lambda: "".join(rng.choice(["sch", "ung", "ver", "keit", "ß"]) for _ in range(rng.randrange(1, 4)))}
    rows = []
    for i in range(80):
        lang = rng.choice(["en", "de"])
        rows.append((i, "\n".join(" ".join(word[lang]() for _ in range(12)) + f" {i}" for _ in range(5)), lang, rng.choice(["a", "b", "c"]), 0))
    return rows, word, rng


def test_every_stage_on_planted_cases(spark, tmp):
    rows, word, rng = documents()
    item = " ".join(word["en"]() for _ in range(25))
    long = [word["en"]() for _ in range(60)]  # one line, so that line dedup leaves both
    near = [*long[:3], "changed", *long[4:]]
    rows += [(100, None, "en", "a", 0), (101, "12 34 !!", "en", "a", 0), (99, " ".join(long), "en", "a", 0), (102, " ".join(near), "en", "b", 0), (103, rows[7][1], "en", "b", 0),
             (104, rows[8][1] + "\nnew words " + item + " more words", rows[8][2], "c", 0), (105, "\n".join(word["en"]() + " a repeated line of text" for _ in range(1)), "en", None, 0)]
    line = "this line stands in many documents"
    rows = [(i, t + "\n" + line if t and i < 20 else t, *x) for i, t, *x in rows]
    spark.createDataFrame(rows, COLUMNS).write.parquet(os.path.join(tmp, "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(os.path.join(tmp, "benchmark.parquet"))
    docs, kept = spark.read.parquet(f"{tmp}/documents.parquet"), []
    for n, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, tmp)
        if n + 1 < len(cp.STAGES):
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp}/stage{n}")
        docs = spark.read.parquet(f"{tmp}/stage{n}")
        kept.append({r.doc_id: r for r in docs.collect()})
    ids = {i for i, *_ in rows}
    assert set(kept[0]) == ids - {100, 101}
    assert set(kept[1]) == set(kept[0])
    assert [i for i, r in kept[1].items() if line in r.text.split("\n")] == [0]
    assert all(r.n_chars == len(r.text) for r in kept[1].values())
    # 103 lost all its lines to 7, 102 is near 99
    assert set(kept[2]) == set(kept[1]) - {102}
    assert set(kept[3]) == set(kept[2]) - {104}
    last = kept[4]
    assert set(last) <= set(kept[3]) and all(0 < r.taken <= 2 * r.size for r in last.values())
    run = {(r.doc_id, r.taken) for r in cp.run(spark, tmp).collect()}
    assert run == {(i, r.taken) for i, r in last.items()}


def test_empty_documents(spark, tmp):
    spark.createDataFrame([], COLUMNS).write.parquet(os.path.join(tmp, "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(os.path.join(tmp, "benchmark.parquet"))
    assert cp.run(spark, tmp).collect() == []


def test_queries_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES) and len(cp.STAGES) == 5 and cp.ORACLE_SQL is None
