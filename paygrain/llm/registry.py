"""The registered queries of the operators, thin forms with fixed result columns, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain.llm import (
    byte_bpe,
    decontaminate,
    embedding,
    fill_middle,
    hmm,
    minhash,
    page_text,
    quality,
    records,
    secrets,
    spelling,
    suffixes,
    token_counts,
)
from paygrain.llm.oracles import ORACLES  # noqa: F401  (read by the entry point)
from paygrain.session import scratch_dir

KINDS = ("assign", "access", "hex")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/paygrain/{name}-{uuid.uuid4().hex}"


@query
def op3_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), path)


@query
def op5_token_records(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = new_folder(spark, "records")
    return records.record_digests(table(spark, sf_dir, "documents"), path, folder)


@query
def op9_token_counts(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), path)
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op7_decontamination(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(docs, items)


@query
def op8_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.quality_scores(docs, labels)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op2_secrets(spark, sf_dir):
    versions = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    found = secrets.scan_versions(versions, new_folder(spark, "secret-ledger"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    def joined(spans):
        kind = F.substring_index
        texts = F.transform(
            spans, lambda s: F.concat_ws(":", kind(s["rule"], "/", 1), s["start"], s["end"])
        )
        return F.array_join(texts, ",")

    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op1_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)


@query
def op6_embedding(spark, sf_dir):
    return embedding.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op4_hmm(spark, sf_dir):
    return hmm.score_documents(table(spark, sf_dir, "documents"))


@query
def op10_suffix_dedup(spark, sf_dir):
    found = suffixes.repeated_bytes(table(spark, sf_dir, "documents"))
    removed = F.aggregate(
        F.zip_with("starts", "ends", lambda a, z: z - a), F.lit(0).cast("long"), lambda x, y: x + y
    )
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        "kept_sha256",
    )


@query
def op11_spelling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return spelling.variant_groups(docs, spelt=spelling.planted_typo)


@query
def op12_html(spark, sf_dir):
    return page_text.main_text(table(spark, sf_dir, "pages"))


@query
def op13_fill_middle(spark, sf_dir):
    cut = fill_middle.transform(table(spark, sf_dir, "documents"))
    text = fill_middle.restored(F.col("output"), F.col("form"))
    return cut.select(
        *[c for c in cut.columns if c != "output"],
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )
