"""The training-data pipeline: documents in, token ids out.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next stage's documents. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import jaccard_join, langid, poisson_mix, queries, secret_scan
from stratum.llm.common import scratch_path, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be determined go."""
    return langid.keep_identified(docs, queries.language_model(docs))


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return jaccard_join.keep_one_each(docs)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text and ``n_chars`` follows."""
    masked = secret_scan.mask_secrets(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated towards the sources' target weights and shuffled."""
    return poisson_mix.replicate(docs).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded bytes."""
    return queries.as_doc_id(queries.encoded(docs)).select(
        "doc_id", F.expr("cast(octet_length(ids) / 4 as bigint)").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("jaccard_dedup", jaccard_dedup),
    ("secret_masking", secret_masking),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs


#: No SQL: the first two stages cannot be expressed in it; tests hold them against brute force.
ORACLE_SQL = None
