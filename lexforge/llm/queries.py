"""The registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm import bpe, chat, crosstoken, fingerprints, lines, ngram_join, packing, passages, periodic, quality, secrets, topk, warc
from lexforge.queries.base import Query, table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("masks", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return rendered.withColumn("masks", spans)


OP2_SQL = """
WITH people AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
faced AS (SELECT c.conv_id, perspective, turn, role, text, role IS NOT DISTINCT FROM perspective AS mine,
    '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant' WHEN role IS NULL THEN 'user'
        ELSE 'user name=' || translate(replace(role, '<|im_', '< |im_'), chr(13) || chr(10), '  ') END || chr(10) AS head
    FROM conversations c JOIN people p ON c.conv_id IS NOT DISTINCT FROM p.conv_id),
said AS (SELECT *, head || replace(coalesce(text, ''), '<|im_', '< |im_') || '<|im_end|>' || chr(10) AS line FROM faced),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i FROM said),
placed AS (SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY conv_id, perspective ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM numbered),
parted AS (SELECT *, CAST(before // 32768 AS BIGINT) AS part, CAST(min(before) OVER (PARTITION BY conv_id, perspective, before // 32768) AS BIGINT) AS start FROM placed)
SELECT conv_id, perspective, part, start, CAST(count(*) AS INT) AS n_turns, string_agg(line, '' ORDER BY i) AS text,
    coalesce(string_agg(CAST(CAST(before - start + length(head) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(before - start + length(line) - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY i)
        FILTER (WHERE mine), '') AS masks
FROM parted GROUP BY conv_id, perspective, part, start"""


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.piece_digests(packing.pack(docs, WORD_TOKENIZER))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM m"""


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.secret_digests(secrets.find_secrets(docs))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
    FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5"""


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, BYTE_RANKS, public_tokenizers.PATTERN).drop("text")
    return bpe.bpe_digests(bpe.decode(encoded, BYTE_RANKS))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.periodic_runs(table(spark, sf_dir, "documents"), edit=periodic.periodic_tail))


def op12_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = crosstoken.align(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_MODEL, digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(lines.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text")))


OP13_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, r.last IS NOT NULL AND k.doc_id < r.last AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


LLM = {
    "op1_quality": Query(op1_quality, None),
    "op2_chat": Query(op2_chat, OP2_SQL),
    "op3_packing": Query(op3_packing, None),
    "op4_ngram_join": Query(op4_ngram_join, None),
    "op5_warc": Query(op5_warc, OP5_SQL),
    "op6_fingerprints": Query(op6_fingerprints, None),
    "op7_passages": Query(op7_passages, None),
    "op8_secrets": Query(op8_secrets, None),
    "op9_top_k": Query(op9_top_k, OP9_SQL),
    "op10_bpe": Query(op10_bpe, None),
    "op11_periodic_runs": Query(op11_periodic_runs, None),
    "op12_cross_tokens": Query(op12_cross_tokens, None),
    "op13_lines": Query(op13_lines, OP13_SQL),
    "pipeline": Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
