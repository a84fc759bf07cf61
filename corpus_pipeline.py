"""Corpus pipeline: rules, near-duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet to the shared checkpoint folder and read again as the next one's
docs; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallystone.llm import bpe, mixing, rules, secrets, simhash
from tallystone.llm.common import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class."""
    return simhash.drop_near_duplicates(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document with digests of ids and decoded bytes."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("secret scans", secret_scans),
    ("source mixing", source_mixing),
    ("byte-level bpe", byte_bpe),
]

#: The network, the rounding and the tokenizer have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
