"""The operators' registered queries: each over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, divergence, jaccard, language, lattice, licenses, lm, main_text, mixing, neighbours, oracles, secrets, token_counts, whitening
from .base import table

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digests(secrets.scan(docs, secrets.trained(docs, tokenizer=TOKENIZER)))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digests(decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), PIECES, rounds=2, whole=True)


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents and all pages: one of doc_id and page_id is null. The text model is fitted on the labelled documents."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs)
    of_docs = language.identify(docs, model, "doc_id", "text", declared_col="lang", host_col="source")
    of_pages = language.identify(table(spark, sf_dir, "pages"), model, "page_id", "html", url_col="url", markup=True)
    return of_docs.withColumnRenamed("id", "doc_id").unionByName(of_pages.withColumnRenamed("id", "page_id"), allowMissingColumns=True)


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secrets, op2_jaccard_join, op3_decontamination, op4_licenses, op5_token_counts, op6_near_vectors, op7_lm_scores, op8_main_text, op9_mixing, op10_language, op11_nearest, op12_source_divergence, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard_join": oracles.JACCARD_JOIN, "op3_decontamination": oracles.DECONTAMINATION, "op6_near_vectors": oracles.NEAR_VECTORS, "op12_source_divergence": oracles.SOURCE_DIVERGENCE}
