"""The registered queries of the corpus operators, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bm25, bpe, decontaminate, impacts, langid, licenses, ngrams, secrets, simhash, substrings, toxicity, vectorcodes, warc
from .common import held_out, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learn_dictionaries(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "margin_bytes", "rejected")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bm25.search(docs, bm25.every_fiftieth(docs))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ngrams.score_documents(docs, ngrams.learn(docs.filter(ngrams.for_training("doc_id"))))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impacts.search(impacts.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_substring_dedup, op2_secret_scan, op3_language_id, op4_toxicity, op5_byte_bpe, op6_license_scan, op7_topk_search, op8_simhash, op9_warc, op10_decontamination, op11_lm_scoring, op12_vector_codes, op13_ranked_search)
    return {f.__name__: f for f in found}


OP9_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (digest)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": substrings.ORACLE_SQL, "op7_topk_search": bm25.ORACLE_SQL, "op9_warc": OP9_SQL, "op10_decontamination": decontaminate.ORACLE_SQL, "op12_vector_codes": vectorcodes.ORACLE_SQL, "op13_ranked_search": impacts.ORACLE_SQL}
