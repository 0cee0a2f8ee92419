"""A training corpus from raw documents, in stages over the operators of fabspark.llm.

Each stage is given all documents its predecessor kept, as a table, and returns
the columns of ``documents``; the last one returns the encoded documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabspark.llm import bpe, minhash, mixing, pii, rules
from fabspark.session import settled

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BATCH_ROWS = 1_000  # whole texts that a Python worker is sent at a time; Spark's 10,000 are held by both sides
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _small_batches(spark: SparkSession) -> None:
    """The stages in Python share an executor's memory with what earlier stages left in the JVM."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    spark.conf.set(key, min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold the base rules and read like trusted ones."""
    _small_batches(spark)
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return rules.judge(docs, rules.fit(docs, trusted), keep=COLUMNS).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of smallest id."""
    _small_batches(spark)
    return minhash.deduplicated(docs).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by marks; ``n_chars`` follows the text."""
    out = pii.redacted(docs.select(*COLUMNS), pii.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 1, 2, 3 in turn: a document appears as often as it is taken, shards are shuffled."""
    return mixing.corpus(docs, mixing.cyclic_weights(docs)).select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes they decode to."""
    _small_batches(spark)
    return bpe.encode(docs, bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN, keep=["lang", "source"])


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_duplicates),
    ("pii", personal_data),
    ("source mix", mix_sources),
    ("byte-level bpe", byte_bpe),
]

#: Likelihood ratios, sketches and tokens have no SQL; the tests check each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        df = stage(spark, df, sf_dir)
        if n < len(STAGES) - 1:
            df = settled(df, "stage")
    return df
