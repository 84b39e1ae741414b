"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    clustering,
    conversations,
    decontaminate,
    html_extract,
    imatch,
    near_dup,
    oracle,
    packing,
    pii,
    records,
    token_counts,
    topk,
    toxicity,
    warc,
)
from tidemark.llm.common import read_table

WORD_FILE = "word_bpe_49k.json"
BYTE_FILE = "byte_bpe_50k.json"


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_FILE))


def op5_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_FILE), capacity=2048)


def op6_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_files(*warc.archive(read_table(spark, sf_dir, "pages")))
    return warc.read_back(warc.read_files(spark, files))


def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.read_all(records.write_records(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_FILE)))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(read_table(spark, sf_dir, "conversations")))


def op12_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(read_table(spark, sf_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64)


QUERIES = {f.__name__: f for f in (
    op1_exact_topk, op2_toxicity, op3_html_extract, op4_token_counts, op5_best_two_fit, op6_minhash_near_dup,
    op7_warc_archive, op8_binary_records, op9_pii, op10_decontaminate, op11_conversation_repair, op12_imatch, op13_centroid_clusters)}

ORACLE_SQL = {
    "op1_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS imp
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.imp, d.imp)::BIGINT AS score
            FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op7_warc_archive": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
        FROM f""",
    "op12_imatch": oracle.FINGERPRINTS,
    "op13_centroid_clusters": oracle.clusters(),
}
