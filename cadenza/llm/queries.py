"""The registered queries of this subpackage: one ``opN_<name>`` per operator.

Each is a thin digest over its operator, applied to the whole table with
production parameters. ``ORACLES`` holds DuckDB SQL where SQL can express a
result; the others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import filteraudit, idstore, langid, licences, multiindex, packing, pieces, pii, productgrid, quality, resample, simhash, warc

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).drop("row_hash")


def op3_byte_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).drop("row_hash")


def op4_keyed_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = idstore.write(table(spark, sf_dir, "documents"), BYTE_BPE)
    return idstore.read(store).select("doc_id", "start", "n_tokens", "ids_crc32", "occurrence")


def op5_warc_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_pages(spark, warc.archive(table(spark, sf_dir, "pages")))


def op6_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return multiindex.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op7_sentencepiece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), PIECE_BPE, ("n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return productgrid.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_licence_sentences,
        op2_quality_rules,
        op3_byte_gru_language,
        op4_keyed_id_store,
        op5_warc_source,
        op6_inverted_multi_index,
        op7_sentencepiece_spans,
        op8_personal_data,
        op9_simhash_near_dedup,
        op10_best_fit_packing,
        op11_embedding_near_dedup,
        op12_filter_audit,
        op13_importance_resampling,
    )
}

#: DuckDB SQL where SQL can express the result.
ORACLES: dict[str, str] = {
    "op1_licence_sentences": licences.oracle_sql(),
    "op5_warc_source": """
        WITH rows AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS payload_digest,
                   CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
            FROM pages
        ), latest AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS first
            FROM rows
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM latest
    """,
    "op12_filter_audit": filteraudit.ORACLE_SQL,
    "op13_importance_resampling": resample.ORACLE_SQL,
}
