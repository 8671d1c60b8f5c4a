"""The thin queries over the operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, common, decontam, html, minhash, periodic, quality, secrets, shard, simhash, tokenfile, warc, whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are worked on one by one."""
    return common.spread(_table(spark, sf_dir, name))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    done = chat.format_trees(chat.from_turns(own.unionByName(extra)))
    turns, lost = chat.parse(F.col("formatted")), chat.loss_text(F.col("formatted"), F.col("loss"))
    read = done.select(F.col("tree").alias("conv_id"), turns.alias("turns"), lost.alias("lost"), F.length("formatted").cast("long").alias("formatted_chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"), F.sha2("lost", 256).alias("loss_sha256"), "formatted_chars")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.report(_rows(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(_table(spark, sf_dir, "documents"), percent=85)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_rows(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder = common.scratch(spark, "warc")
    index = common.Stage(warc.write(pages, folder), "warc-index").df
    out = warc.read(index, folder, pages.schema["page_id"].dataType.simpleString())
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.scratch(spark, "tokens")
    index = common.Stage(tokenfile.write(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1), "tokens-index").df
    return tokenfile.read(index, folder)


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard.shards(_table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_rows(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _rows(spark, sf_dir, "documents")
    return quality.measure(docs, quality.plan(docs))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(_table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(_rows(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(periodic.with_periods(_rows(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_decontaminate, op3_near_duplicates, op4_byte_bpe, op5_warc, op6_token_files, op7_shards, op8_secrets, op9_quality, op10_main_text, op11_whitening, op12_simhash, op13_periodic_runs)}

_OP1 = r"""
WITH all_turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc AS (SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|</?SYS>>|/?(?:INST|ROLE|TEXT)\])', '\1\\\2\3', 'g')) AS n,
  CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE 33 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|</?SYS>>|/?(?:INST|ROLE|TEXT)\])', '\1\\\2\3', 'g')) END AS marks FROM all_turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + marks) AS BIGINT) AS formatted_chars
FROM esc GROUP BY conv_id"""

_OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, p, p + least(10, len(w)) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k)),
h AS (SELECT doc_id, dw.k, p, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.g = iw.g),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, coalesce(CAST(len(w) AS BIGINT), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)"""

_OP3 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM x JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS u FROM d UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT v, min(u) AS c FROM r GROUP BY v) m ON m.v = d.doc_id"""

_OP5 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, max(page_id) AS first FROM p GROUP BY h),
b AS (SELECT page_id, h, first, sha1(h) AS x FROM p JOIN f USING (h)),
k AS (SELECT *, array_to_string(list_transform(range(40), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', substr(x, CAST(i + 1 AS BIGINT), 1)) - 1) + 1, 4)), '') AS bits FROM b)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(16 * CAST(substr(bits, 5 * i + 1, 1) AS BIGINT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS BIGINT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS BIGINT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS BIGINT) + CAST(substr(bits, 5 * i + 5, 1) AS BIGINT) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM k"""

_OP9 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, p, array_to_string(list_slice(w, p, p + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)),
t AS (SELECT doc_id, g FROM g GROUP BY 1, 2 HAVING count(*) > 1),
r AS (SELECT doc_id, count(DISTINCT q) AS n_repeat FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM g JOIN t USING (doc_id, g)) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
a AS (SELECT doc_id, count(*) AS n_doubled FROM (SELECT doc_id, w, unnest(range(2, len(w) + 1)) AS p FROM d) WHERE w[p] = w[p - 1] GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
  length(regexp_replace(text, '[^!]', '', 'g')) AS shouts, coalesce(n_lines, 0) AS n_lines, coalesce(n_doubled, 0) AS n_doubled
  FROM d LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN a USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * shouts > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_dup_lines > 3 * n_lines OR 10 * n_doubled > 3 * n_words) AS kept
FROM b"""

_OP10 = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1), '</?(p|h1|br)>', ' ', 'g') AS x FROM pages),
b AS (SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM b"""

ORACLES = {"op1_chat_format": _OP1, "op2_decontaminate": _OP2, "op3_near_duplicates": _OP3, "op5_warc": _OP5, "op9_quality": _OP9, "op10_main_text": _OP10}
