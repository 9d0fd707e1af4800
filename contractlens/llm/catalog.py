"""Registered queries of the operators, each with its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from contractlens.llm import (
    bpe,
    chat,
    exact_dedup,
    langid,
    near_dedup,
    packing,
    phrases,
    repair,
    sharding,
    token_files,
    toxicity,
    vector_codes,
    warc,
)
from contractlens.llm.common import read


def op1_byte_bpe(spark, sf):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_texts(read(spark, sf, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode_ids(encoded, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_near_dedup(spark, sf):
    return near_dedup.near_duplicates(read(spark, sf, "documents"), words=4)


def op3_token_files(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = token_files.token_files(read(spark, sf, "documents"), path, end_id=2, keep_ids=False)
    return rows.select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


def op4_packing(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack_documents(read(spark, sf, "documents"), path, end_id=1)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "context",
        "step_group",
    )


def op5_jump_shards(spark, sf):
    return sharding.assign_shards(read(spark, sf, "documents"), 8)


def op6_warc(spark, sf):
    return warc.archive_pages(read(spark, sf, "pages"), min_bytes=0, every_row=True)


def op7_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(read(spark, sf, "documents"))


def op8_fingerprints(spark, sf):
    return phrases.compare_with_edits(read(spark, sf, "documents"))


def op9_chat_format(spark, sf):
    return chat.format_conversations(read(spark, sf, "conversations"))


def op10_toxicity(spark, sf):
    return toxicity.score_toxicity(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op11_vector_codes(spark, sf):
    return vector_codes.encode_vectors(read(spark, sf, "embeddings"), parts=8, entries=16, rounds=6)


def op12_repair(spark, sf):
    conversations = read(spark, sf, "conversations")
    return repair.repair_conversations(repair.damaged(conversations), conversations)


def op13_language(spark, sf):
    path = public_tokenizers.path("piece_bpe_32k.model")
    return langid.identify_languages(read(spark, sf, "documents"), path)


QUERIES = {
    query.__name__: query
    for query in (
        op1_byte_bpe,
        op2_near_dedup,
        op3_token_files,
        op4_packing,
        op5_jump_shards,
        op6_warc,
        op7_exact_dedup,
        op8_fingerprints,
        op9_chat_format,
        op10_toxicity,
        op11_vector_codes,
        op12_repair,
        op13_language,
    )
}

_NORMALISED = f"translate(coalesce(text, ''), '{exact_dedup.ASCII_UPPER}', '{exact_dedup.ASCII_LOWER}')"

# Groups of 20 bits of the hexadecimal digest give four letters each.
_BASE32 = """
  list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(digest, cast(i // 4 * 5 + 1 AS bigint), 5))::bigint >> (15 - 5 * (i % 4))::bigint) & 31) + 1, 1)),
    'string_agg', '')"""

ORACLES = {
    "op11_vector_codes": vector_codes.codes_sql("embeddings", 8, 16, 6),
    "op12_repair": repair.repair_sql("conversations"),
    "op2_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'UPPER', 'LOWER'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: list_aggregate(w[i:i + 3], 'string_agg', ' '))) END AS items
  FROM words),
items AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b USING (item)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT s.doc_id, len(s.items) AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT node, min(other) AS component_id FROM reached GROUP BY node) r ON s.doc_id = r.node
""".replace("UPPER", exact_dedup.ASCII_UPPER).replace("LOWER", exact_dedup.ASCII_LOWER),
    "op6_warc": f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(html) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads""",
    "op7_exact_dedup": f"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
  SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size, text_sha256
  FROM (SELECT doc_id, sha256({_NORMALISED}) AS text_sha256 FROM documents))""",
    "op9_chat_format": """
WITH placed AS (
  SELECT conv_id, alone, role, text,
    row_number() OVER (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text) AS place
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM conversations)),
whole AS (
  SELECT conv_id, alone, count(*) AS n_turns,
    string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY place) AS rendered,
    list(md5(role || chr(0) || text) ORDER BY place) AS turns
  FROM placed GROUP BY conv_id, alone),
proper AS (
  SELECT DISTINCT n, list_aggregate(turns[1:n], 'string_agg', '') AS start
  FROM (SELECT turns, unnest(generate_series(1, n_turns - 1)) AS n FROM whole)),
distinct_ones AS (
  SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_copies, min(rendered) AS rendered,
    list_aggregate(turns, 'string_agg', '') AS all_turns
  FROM whole GROUP BY turns, n_turns)
SELECT conv_id, n_turns, n_copies, rendered FROM distinct_ones d
WHERE NOT EXISTS (SELECT 1 FROM proper p WHERE p.n = d.n_turns AND p.start = d.all_turns)""",
}
