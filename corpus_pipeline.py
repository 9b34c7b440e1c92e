"""Corpus pipeline over ``documents``: quality rules, near duplicates, secrets, mixing, tokens.

Every stage reads what the one before it wrote, works on all of it, and returns the columns of ``documents``;
the last returns the ids of the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import piece_viterbi, raking
from encore.llm.compression import keep_compressible
from encore.llm.multiorder_join import keep_one_per_group
from encore.llm.queries import MIX
from encore.llm.secret_cnn import redact_secrets, train
from encore.llm.textops import bounded_batches
from encore.session import ensure_session, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the compression bands; the others go."""
    bounded_batches(spark)
    return keep_compressible(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group of near copies."""
    bounded_batches(spark)
    ensure_session(spark)
    return keep_one_per_group(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mask, n_chars renewed where the text changed."""
    bounded_batches(spark)
    return redact_secrets(docs, train(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the raked mixture samples."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # whole, so no column name can clash
    asked = raking.with_topics(docs.select("doc_id", "source", "lang", "text", row))
    return raking.mix(asked, MIX).where("sampled").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the piece ids of every document."""
    bounded_batches(spark)
    vocabulary = piece_viterbi.read_vocabulary(piece_viterbi.model_path(spark))
    return piece_viterbi.encode(docs, vocabulary).select("doc_id", "lang", "source", "ids")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secret_scans", secret_scans),
          ("mixing", mixing), ("tokens", tokens)]

#: SQL can express neither zstandard ratios nor the trained scanner; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the session's shared folder and read again."""
    ensure_session(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
