"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator to the whole table and derives the columns of
its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.byte_bpe import Codec
from quayside.llm.chat import format_chats
from quayside.llm.common import table
from quayside.llm.decontam import contained_items
from quayside.llm.html_text import extract
from quayside.llm.katz import katz_scores
from quayside.llm.langid import fold, held_out_identify
from quayside.llm.line_dedup import dedup_lines
from quayside.llm.mixing import fair_queue
from quayside.llm.near_dup import near_duplicates
from quayside.llm.quality import assess
from quayside.llm.spelling import spelling_groups
from quayside.llm.suffix_dedup import repeated_spans
from quayside.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


_SPACE = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op2_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(a, 1) AS idx, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)
), keyed AS (
  SELECT doc_id, idx, line, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), firsts AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, idx, line, coalesce(l.doc_id > first, FALSE) AS gone FROM keyed l LEFT JOIN firsts USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY idx) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op2_line_dedup(spark, sf_dir):
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op7_fair_mix", r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k, md5(CAST(doc_id AS VARCHAR)) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), src AS (
  SELECT k, CAST(sum(size) AS BIGINT) AS s, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY k) - 1) % 3] AS BIGINT) AS w FROM sized GROUP BY k
), pairs AS (
  -- with water level a.s / a.w: what is full below it, and the weights from it up
  SELECT a.k, a.s, a.w, (SELECT CAST(sum(s) AS BIGINT) FROM src) AS t,
         CAST(coalesce(sum(b.s) FILTER (WHERE b.s * a.w < a.s * b.w OR (b.s * a.w = a.s * b.w AND b.k < a.k)), 0) AS BIGINT) AS below,
         CAST(sum(b.w) FILTER (WHERE b.s * a.w > a.s * b.w OR (b.s * a.w = a.s * b.w AND b.k >= a.k)) AS BIGINT) AS weights
  FROM src a, src b GROUP BY a.k, a.s, a.w
), level AS (
  SELECT weights AS wl, 3 * t - 4 * below AS l FROM pairs WHERE 4 * s * weights >= w * (3 * t - 4 * below) ORDER BY weights DESC LIMIT 1
), targets AS (
  SELECT k, s, least(CAST(2 * s AS DOUBLE), CAST(w * l AS DOUBLE) / CAST(2 * wl AS DOUBLE)) AS target FROM src, level
), queued AS (
  SELECT doc_id, k, h, size, s, target, sum(size) OVER (PARTITION BY k ORDER BY h, doc_id) AS e FROM sized JOIN targets USING (k)
), packets AS (
  SELECT doc_id, k, h, size, p, CAST(e + p * s AS DOUBLE) / target AS finish FROM queued, (VALUES (0), (1)) v(p) WHERE size > 0
), served AS (
  SELECT doc_id, k, size, sum(size) OVER (ORDER BY finish, h, p, k) - size AS before FROM packets
), given AS (
  SELECT doc_id, k, CAST(sum(greatest(0, least(size, (SELECT sum(s) * 3 // 2 FROM src) - before))) AS BIGINT) AS taken FROM served GROUP BY doc_id, k
)
SELECT doc_id, size, s AS source_size, target, coalesce(taken, 0) AS taken
FROM queued LEFT JOIN given USING (doc_id, k)
""")
def op7_fair_mix(spark, sf_dir):
    return fair_queue(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_near_dup", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS sh
  FROM words
), sizes AS (
  SELECT doc_id, count(sh) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (min(x.n) + min(y.n) - count(*))
), reach AS (
  SELECT doc_id, doc_id AS seen FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.seen
), comp AS (
  SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id
)
SELECT s.doc_id, s.n AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sizes s JOIN comp c USING (doc_id)
""")
def op9_near_dup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op8_language_id")
def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return held_out_identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op3_quality")
def op3_quality(spark, sf_dir):
    out = assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score", "threshold")


@query("op5_katz_lm")
def op5_katz_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz_scores(docs, fold(docs, 10) == 0)


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark, sf_dir):
    out = repeated_spans(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


@query("op6_decontamination")
def op6_decontamination(spark, sf_dir):
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_html_text")
def op4_html_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


@query("op10_chat_format")
def op10_chat_format(spark, sf_dir):
    return format_chats(table(spark, sf_dir, "conversations")).select(
        "conv_id", "turn", "role", F.get("roles", F.lit(0)).alias("role_found"), F.size("roles").cast("bigint").alias("n_turns"), "n_lines", "rendered")


@query("op11_whitening")
def op11_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))


@query("op12_byte_bpe")
def op12_byte_bpe(spark, sf_dir):
    import public_tokenizers

    codec = Codec(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    decoded = codec.decode_ids(codec.encode_texts(table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", F.floor(F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_spelling")
def op13_spelling(spark, sf_dir):
    return spelling_groups(table(spark, sf_dir, "documents"))
