"""A corpus pipeline of five stages over the table of documents.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its result is written as Parquet and read again
as the docs of the next. All stages but the last return the columns of documents, whatever they are, and leave those that they do not decide by alone.

Defined cases, for every stage: a null text counts as empty (the first stage drops it, as it drops every text without a letter; the others keep one such row
as the representative of all empty texts, or as a document of the end id alone). Rows with a null or repeated id are rows of their own in the first, second,
fourth and last stage; in the third a row with a null id has no partner and stays, and rows that share an id go or stay together. Ties go to the smaller id.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import exact_dedup, language_id, minhash, packing, queries, secrets, token_file
from gridloom.llm._common import drop_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the language models reject, and those without a letter."""
    return language_id.keep_known(docs, queries.language_models(docs)).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact_dedup.exact_dedup(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: shingles of five words, similarity of 0.8 or more."""
    return minhash.near_dedup(docs, size=5, percent=80).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts and counts their characters again; no document goes."""
    masked = secrets.redact(docs, queries._tokenizer("byte_bpe_50k.tiktoken"), queries._pattern())
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the ids of the documents into sequences of 2048."""
    return packing.pack(docs, queries._tokenizer("word_bpe_49k.json"), end_id=1, window=2048)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

#: Stages train models and tokenise, which SQL cannot express; tests/llm/test_pipeline.py compares every stage and the whole with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again. A result is deleted once its successor is written; the
    last but one stays, as the returned rows are read from it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = token_file.fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
