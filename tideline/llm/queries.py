"""The operators on their whole tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import table
from tideline.llm.conversation_trie import conversation_trie
from tideline.llm.exact_dedup import exact_classes
from tideline.llm.fill_in_middle import fill_in_middle, restore
from tideline.llm.html_text import extract
from tideline.llm.near_dedup import near_classes
from tideline.llm.packing import pack_documents
from tideline.llm.quality_classifier import fit_classifier, held_out, score
from tideline.llm.quality_rules import quality_rules
from tideline.llm.token_files import read_token_files, write_token_files
from tideline.llm.secrets import scan
from tideline.llm.token_counts import token_counts
from tideline.llm.viterbi import encode
from tideline.llm.warc import archive_pages, read_warc, record_key
from tideline.sources.sinks import scratch_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(query: Callable[[SparkSession, str], DataFrame]):
    QUERIES[query.__name__] = query
    return query


@register
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_classes(table(spark, sf_dir, "documents"))


ORACLES["op2_exact_dedup"] = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM t WINDOW same AS (PARTITION BY body)
"""


@register
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@register
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=2)
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@register
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1, capacity=4096)


@register
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), PIECE_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


@register
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    archive_pages(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select(
        record_key("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        record_key("refers_to").alias("refers_to"),
    )


@register
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_classifier(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


# Base32 of SHA-1: eight characters from each ten hexadecimal digits.
ORACLES["op3_warc"] = """
WITH t AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT *, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first FROM t)
SELECT page_id, strlen(body) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
         ((CAST('0x' || substr(hex, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT)
           >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
"""


@register
def op10_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it (pieces can't tell U+2581 from a space)."""
    encoded = encode(table(spark, sf_dir, "documents"), PIECE_BPE, decoded=True)
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        F.char_length("text").cast("long").alias("decoded_chars"),
        F.crc32(F.encode("text", "UTF-8")).alias("decoded_crc32"),
    )


@register
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate with its verdict; values leave as digests only."""
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "end",
        F.sha2("value", 256).alias("value_sha256"),
        F.round("score", 6).alias("score"),
        "is_secret",
    )


@register
def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


@register
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    arranged = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    hashed = arranged.withColumn("output_sha256", F.sha2("output", 256))
    return restore(hashed).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        "output_sha256",
        F.sha2("text", 256).alias("restored_sha256"),
    )


ORACLES["op11_fill_in_middle"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
u AS (
  SELECT doc_id, body, regexp_extract_all(body,
           '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         CAST('0x' || substr(hex, 1, 8) AS BIGINT) AS h1,
         CAST('0x' || substr(hex, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(hex, 17, 8) AS BIGINT) AS h3,
         CAST('0x' || substr(hex, 25, 8) AS BIGINT) AS h4 FROM t),
v AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>')
                   OR contains(body, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
w AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
  FROM v),
x AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix,
         array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix FROM w)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
         AS output_sha256,
       sha256(body) AS restored_sha256
FROM x
"""


@register
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


# The pages of these tables mark the article by an element whose blocks hold only b and br,
# so that patterns find the same text.
ORACLES["op12_html_extraction"] = r"""
WITH t AS (
  SELECT page_id, url,
         regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS inside FROM pages),
b AS (
  SELECT page_id, url, list_transform(
    string_split_regex(inside, '</?(?:p|h1)>'),
    lambda x: trim(regexp_replace(
      replace(replace(replace(regexp_replace(replace(regexp_replace(x, '</?b>', '', 'g'), '<br>', ' '),
        '&amp;?', chr(1), 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
      '\s+', ' ', 'g'))) AS blocks FROM t),
x AS (
  SELECT page_id, url, replace(
    array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)), chr(1), '&') AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM x
"""


@register
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


# crc32 goes bit by bit over the digits; a conversation's turns are told apart by SHA-256.
ORACLES["op13_conversation_trie"] = """
WITH said AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, key, bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos FROM said),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(
        range(0, 8 * length(CAST(conv_id AS VARCHAR))),
        lambda k: CASE WHEN k % 8 = 0
          THEN CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(k // 8 + 1 AS BIGINT), 1)) AS BIGINT)
          ELSE CAST(0 AS BIGINT) END)),
      lambda s, e: CASE WHEN xor(s, e) % 2 = 1
        THEN xor(xor(s, e) // 2, CAST(3988292384 AS BIGINT)) ELSE xor(s, e) // 2 END),
    CAST(4294967295 AS BIGINT)) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, t.key, t.bytes, 0 AS part, t.pos
  FROM convs c JOIN turns t ON t.conv_id = c.base WHERE t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.key, t.bytes, 1, t.pos
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id WHERE t.pos > c.h),
paths AS (
  SELECT conv_id, list(key ORDER BY part, pos) AS keys, list(bytes ORDER BY part, pos) AS sizes
  FROM rebuilt GROUP BY conv_id
  UNION ALL SELECT conv_id, [], [] FROM convs WHERE conv_id NOT IN (SELECT conv_id FROM rebuilt)),
member AS (
  SELECT conv_id, unnest(range(0, len(keys) + 1)) AS depth, keys, sizes FROM paths),
node AS (
  SELECT array_to_string(keys[1:depth], '') AS path, depth, min(conv_id) AS conv_id,
         count(*) AS n_convs, max(CASE WHEN depth = 0 THEN 0 ELSE sizes[depth] END) AS bytes,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
           FILTER (WHERE depth = len(keys)), '') AS ends
  FROM member GROUP BY ALL),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM node k
          WHERE k.depth = n.depth + 1 AND substr(k.path, 1, 64 * n.depth) = n.path) AS n_children
  FROM node n LEFT JOIN node p
    ON p.depth = n.depth - 1 AND p.path = substr(n.path, 1, CAST(64 * (n.depth - 1) AS BIGINT))),
above AS (
  SELECT substr(path, 1, 64 * up) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM linked) GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM linked JOIN above USING (path)
"""
