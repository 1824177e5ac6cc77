"""Corpus pipeline over ``documents``: stages, each written as Parquet and reread by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.mixing import MAX_REPEAT, mix
from riskloom.llm.packing import pack
from riskloom.llm.quality_rules import keep_good
from riskloom.llm.simhash_dedup import one_per_component
from riskloom.llm.substring_dedup import dedup_substrings
from riskloom.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that base rule and learned list keep."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component one row: the smallest id's, null ids last; equal ids by text, equal rows once."""
    return one_per_component(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document before has; untouched texts keep their spacing."""
    out = dedup_substrings(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = out.withColumn("text", text).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("n_chars")).cast("long"))
    return changed.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the temperature mixture takes them."""
    return mix(docs, max_repeat=MAX_REPEAT).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("mixing", mixing),
    ("packing", packing),
]

#: The stages use hashes, a tokenizer and learned rules that DuckDB cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage's rows are written to the shared folder and read again."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        folder = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
