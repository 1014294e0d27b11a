"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from hanok.llm import audit, bpe, chat, decontaminate, licenses, lines, minhash, quality, search, secrets, simhash, urls, warc
from hanok.llm.shared import table


def tokenizer_source() -> str:
    """The JSON of the tokenizer file: LLM_TOKENIZER names it, else the installed public vocabulary is taken."""
    path = os.environ.get("LLM_TOKENIZER")
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Path(path).read_text(encoding="utf-8")


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(table(spark, sf, "documents"))


def op2_chat_perspectives(spark: SparkSession, sf: str) -> DataFrame:
    return chat.perspectives(table(spark, sf, "conversations"))


def op3_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"))


def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.tokenize(table(spark, sf, "documents"), tokenizer_source())


def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op6_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op7_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.licences(licenses.documents_as_files(table(spark, sf, "documents")))


def op8_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.compare_with_edited(table(spark, sf, "documents"))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf, "pages"))


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = lines.without_repeated(table(spark, sf, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_chat_perspectives": op2_chat_perspectives,
    "op3_url_filter": op3_url_filter,
    "op4_bpe": op4_bpe,
    "op5_decontaminate": op5_decontaminate,
    "op6_simhash": op6_simhash,
    "op7_license_scan": op7_license_scan,
    "op8_minhash": op8_minhash,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_filter_audit": op11_filter_audit,
    "op12_ranked_search": op12_ranked_search,
    "op13_line_dedup": op13_line_dedup,
}

OP5_SQL = r"""
WITH lowered AS (
  SELECT 0 AS side, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 1, item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), split AS (
  SELECT side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered
), item_windows AS (
  SELECT DISTINCT id AS item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM split WHERE side = 1 AND len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT id AS doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM split, sizes WHERE side = 0 AND len(w) >= n)
), hits AS (
  SELECT d.doc_id, d.i, d.n, m.item_id FROM doc_windows d JOIN item_windows m ON d.win = m.win AND d.n = m.n
), hit_words AS (
  SELECT doc_id, count(DISTINCT word_no) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word_no FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT s.id AS doc_id, CAST(len(s.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM split s LEFT JOIN hit_words h ON s.id = h.doc_id LEFT JOIN hit_items m ON s.id = m.doc_id
WHERE s.side = 0
"""

OP2_SQL = """
WITH said AS (
  SELECT conv_id, coalesce(CAST(turn AS BIGINT), -1) AS turn, coalesce(role, 'system') AS role, coalesce(text, '') AS said
  FROM conversations WHERE conv_id IS NOT NULL
), speakers AS (
  SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'
), pieces AS (
  SELECT t.conv_id, speaker, turn, role, said, role = speaker AS own,
         CASE WHEN role = speaker THEN '<|im_start|>assistant' WHEN role = 'system' THEN '<|im_start|>system'
              ELSE '<|im_start|>user name=' || role END || chr(10) AS head,
         row_number() OVER (PARTITION BY t.conv_id, speaker ORDER BY turn, role, said) AS nth
  FROM said t JOIN speakers s ON t.conv_id = s.conv_id
), placed AS (
  SELECT *, head || said || '<|im_end|>' || chr(10) AS piece,
         sum(length(head || said || '<|im_end|>' || chr(10))) OVER (PARTITION BY conv_id, speaker ORDER BY nth)
         - length(said || '<|im_end|>' || chr(10)) AS start
  FROM pieces
)
SELECT conv_id, CAST(0 AS BIGINT) AS part, speaker, string_agg(piece, '' ORDER BY nth) AS text,
       coalesce(string_agg(CASE WHEN own THEN CAST(start AS BIGINT) || ':' || CAST(start + length(said) AS BIGINT) END, ',' ORDER BY nth), '') AS masks,
       count(*) AS n_turns, CAST(sum(CASE WHEN own THEN 1 ELSE 0 END) AS BIGINT) AS n_own
FROM placed GROUP BY conv_id, speaker
"""

OP10_SQL = """
WITH sized AS (
  SELECT page_id, sha1(coalesce(html, '')) AS digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS size FROM pages
), latest AS (
  SELECT digest, max(page_id) AS latest FROM sized WHERE size >= 1000 GROUP BY digest
)
SELECT page_id, size AS payload_bytes, s.digest AS payload_digest,
       CASE WHEN latest IS NOT NULL AND page_id IS DISTINCT FROM latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN latest IS NOT NULL AND page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM sized s LEFT JOIN latest m ON s.digest = m.digest AND size >= 1000
"""

OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (SELECT t, min(doc_id) AS first FROM words GROUP BY t),
flags AS (
  SELECT doc_id, part,
         [CASE WHEN len(w) < 200 THEN 1 ELSE 0 END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 1 ELSE 0 END,
          CASE WHEN 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 3 * length(d.t) THEN 1 ELSE 0 END,
          CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 1 ELSE 0 END, CASE WHEN doc_id > first THEN 1 ELSE 0 END] AS f
  FROM words d JOIN firsts s ON d.t = s.t
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, f, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM flags d LEFT JOIN known k ON d.doc_id = k.doc_id GROUP BY part, f
), letters AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o, list_aggregate([substr('ABCDE', x, 1) for x in [a.i, b.i, c.i, d.i, e.i]], 'string_agg', '') AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), placed AS (SELECT o, filter_order, unnest(range(1, 6)) AS step FROM orders),
counted AS (
  SELECT part, filter_order, step, o[step] AS letter,
         sum(CASE WHEN list_sum([f[x] for x in o[1:step]]) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN f[o[step]] = 1 AND coalesce(list_sum([f[x] for x in o[1:step - 1]]), 0) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN f[o[step]] = 1 AND list_sum([f[x] for x in o[1:step - 1]]) > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN f[o[step]] = 1 AND list_sum(f) = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN f[o[step]] = 1 AND coalesce(list_sum([f[x] for x in o[1:step - 1]]), 0) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN f[o[step]] = 1 AND coalesce(list_sum([f[x] for x in o[1:step - 1]]), 0) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, placed GROUP BY part, filter_order, step, o
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""

OP12_SQL = r"""
WITH found AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), docs AS (SELECT row_no, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM found WHERE len(w) > 0),
whole AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), postings AS (
  SELECT row_no, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row_no, doc_id, n, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY row_no, doc_id, n, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, whole GROUP BY term, big_n
), impacts AS (
  SELECT row_no, doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // big_l))) AS added
  FROM postings p JOIN weights s ON p.term = s.term, whole
), scores AS (
  SELECT item_id, row_no, doc_id, CAST(sum(added) AS BIGINT) AS score FROM item_terms i JOIN impacts p ON i.term = p.term GROUP BY item_id, row_no, doc_id
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

OP13_SQL = r"""
WITH split AS (
  SELECT doc_id, row_no, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS nth
  FROM (SELECT coalesce(doc_id, -9223372036854775808) AS doc_id, coalesce(text, '') AS t, row_number() OVER () AS row_no FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split
), frequent AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT k.*, f.key IS NOT NULL AND last <> doc_id AS lost FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT nullif(doc_id, -9223372036854775808) AS doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN lost THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN lost THEN NULL ELSE line END, chr(10) ORDER BY nth), '')) AS kept_sha256
FROM judged GROUP BY doc_id, row_no
"""

SQL = {
    "op2_chat_perspectives": OP2_SQL,
    "op5_decontaminate": OP5_SQL,
    "op10_warc": OP10_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_ranked_search": OP12_SQL,
    "op13_line_dedup": OP13_SQL,
}
