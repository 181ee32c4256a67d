"""A corpus pipeline: language ID, near-duplicates, decontamination, secrets, mixing.

Each stage takes the documents its predecessor kept and returns documents with the same columns; the
last returns what the mix takes of each. Decisions are on rows, named by a key of all their values:
rows without an id, or of different values under one id, are judged each by itself. Every stage's
rows are written to the shared folder and read again, so that each runs once and a lost executor
costs one stage at most.

Cases, for every stage: nulls may stand in any column; other columns, whatever their names, go
through; texts are read whole, however long; an empty table gives an empty table with its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import decontamination, jaccard, language, mixing, secrets
from skein.llm.base import KEY, keyed, materialize, once, table, without
from skein.llm.queries import TOKENIZER


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text is in none of the labelled languages (no letters, or less likely than random bytes).

    Null and empty texts have no language and go; without any label all stay; repeated rows are judged alike.
    """
    rows = keyed(docs)
    found = language.identify(rows, language.train(docs), KEY, "text", declared_col="lang", host_col="source")
    return without(rows, found.filter(~F.col("kept")).select("id"), KEY).drop(KEY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked documents: the least id's (rows without an id come last; ties go by the row's key).

    Null and empty texts link with nothing and stay; of repeated rows with words, one stays.
    """
    rows = keyed(docs)
    found = materialize(jaccard.groups(rows, KEY).filter("first_key IS NOT NULL"), "groups")
    first = F.col("key") == F.col("first_key")
    repeated = found.filter(first).groupBy("key").count().filter("count > 1").select("key")
    return once(without(rows, found.filter(~first).select("key"), KEY), repeated, KEY).drop(KEY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs.

    Null and empty texts hold none and stay; repeated rows are judged alike; an empty benchmark drops nothing.
    """
    rows = keyed(docs)
    found = decontamination.find(rows, table(spark, sf_dir, "benchmark"), KEY)
    return without(rows, found.filter(F.size("items") > 0).select("doc_id"), KEY).drop(KEY)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the secrets in the texts; n_chars follows the text.

    No row goes; null texts stay null, and repeated rows stay as many.
    """
    clean = secrets.redact(docs, secrets.trained(docs, tokenizer=TOKENIZER))
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document.

    Null and empty texts have size 0 and give nothing; a null source is one of its own; repeated rows count each.
    """
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
]

#: Trained models and rounding at random have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
