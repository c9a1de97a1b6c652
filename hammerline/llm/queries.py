"""The operators bound to the given tables: one query each, and SQL where it can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hammerline.llm import bpe, exact_dedup, fingerprints, html_text, licenses, mixing, periodic_runs, secrets
from hammerline.llm import simhash_vp, suffix_dedup, toxicity, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vp.near_components(_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.summary(_table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op4_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(_table(spark, sf_dir, "documents"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.summary(_table(spark, sf_dir, "documents"))


def op6_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.summary(periodic_runs.planted(_table(spark, sf_dir, "documents")))


def op12_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_main_text": op3_main_text,
    "op4_linked_secrets": op4_linked_secrets,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_toxicity_grammar": op6_toxicity_grammar,
    "op7_warc_archive": op7_warc_archive,
    "op8_mix_sources": op8_mix_sources,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitened_embeddings": op12_whitened_embeddings,
    "op13_license_scan": op13_license_scan,
    "pipeline": pipeline,
}

# SHA-1 digits as base32: 40 bits at a time, five for each letter.
BASE32_SQL = " || ".join(
    f"substr('{warc.BASE32}', (('0x' || substr(digits, {10 * (i // 8) + 1}, 10))::BIGINT >> {35 - 5 * (i % 8)} & 31) + 1, 1)"
    for i in range(32)
)

ORACLES: dict[str, str] = {
    "op7_warc_archive": f"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digits,
                   row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC) AS nth,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
            FROM pages)
        SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
               {BASE32_SQL} AS payload_digest,
               CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN nth > 1 THEN last END AS refers_to
        FROM p
    """,
    "op10_exact_dedup": """
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS row, sha256(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC, row DESC) = 1 AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
}
