"""From raw documents to token ids: quality, near-duplicates, benchmark passages, secrets, encoding.

Each stage takes (spark, docs, sf_dir) and returns what goes on; all but the last return the columns of
``documents``. ``run`` writes the result of each stage as Parquet and reads it back as the next one's docs.

In every stage a null text counts as empty, repeated rows and rows with a null doc_id are each treated as rows of their
own, ties go by the smaller doc_id, columns beyond doc_id and text are carried along unread up to the last stage, and an
empty table gives an empty one.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paygrain.llm import byte_bpe, decontaminate, minhash, quality, secrets
from paygrain.session import materialize, scratch_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, does not reject; all of them without any label.

    Empty texts share one score. Labels that are null or without a doc_id are left out.
    """
    return quality.without_bad(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8).

    The smallest doc_id stays, with all of its rows; empty texts and rows with a null doc_id stay.
    """
    return minhash.without_near_duplicates(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` stands, exactly or with a few edits; null or empty items count as none."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; a null text stays null."""
    folder = f"{scratch_dir(spark).rstrip('/')}/paygrain/pipeline-ledger-{uuid.uuid4().hex}"
    return secrets.redact(docs, folder)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, intact) of every document left; an empty text has no ids."""
    return byte_bpe.encode_checked(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", no_benchmark),
    ("secrets", no_secrets),
    ("byte_bpe", token_ids),
]

# SQL cannot express the classifier, approximate matching or the encoder; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
