"""Queries of the training-data operators with production parameters, and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm import (ann, bpe, collocations, fragments, lexical, mixing, oracles, ordinal, repeats, rules, secrets,
                            simhash, token_counts, wrappers)

QUERIES: dict = {}
ORACLE: dict[str, str] = {"op1_quality_rules": oracles.OP1, "op11_collocations": oracles.OP11, "op13_lexical_search": oracles.OP13}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark, sf_dir):
    """Every document's counts, base rules and risk-controlled verdict."""
    return rules.measure(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op2_learned_partitions(spark, sf_dir):
    """The 20 nearest of every twentieth vector."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


@query
def op3_secret_scans(spark, sf_dir):
    """Every document's secret spans: base patterns and the network's additions."""
    return secrets.scan(_table(spark, sf_dir, "documents"))


@query
def op4_ordinal_quality(spark, sf_dir):
    """Every document's expected grade and tail probability."""
    return ordinal.grade_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op5_simhash_dedup(spark, sf_dir):
    """Every document's fingerprint and near-duplicate component."""
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


@query
def op6_wrapper_extraction(spark, sf_dir):
    """Every page's main text."""
    return wrappers.extract(_table(spark, sf_dir, "pages"))


@query
def op7_token_counts(spark, sf_dir):
    """Every document's tokens, by section."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_byte_bpe(spark, sf_dir):
    """Every document encoded and decoded, as digests."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_source_mixing(spark, sf_dir):
    """Every document's share in the mix of sources."""
    return mixing.mixture(_table(spark, sf_dir, "documents"))


@query
def op10_suffix_dedup(spark, sf_dir):
    """Every document's bytes without repeated 400-byte strings; ``text`` is what remains (a cut character as U+FFFD)."""
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


@query
def op11_collocations(spark, sf_dir):
    """Each language's first 2,000 collocations."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


@query
def op12_fragment_bpe(spark, sf_dir):
    """Every document encoded in fragments and decoded, as digests."""
    return fragments.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_lexical_search(spark, sf_dir):
    """The 50 highest-scoring documents of every benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
