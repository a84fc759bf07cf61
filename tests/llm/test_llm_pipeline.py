"""The pipeline's stages against what their operators say, and its registration."""

import hashlib

import __spark_entry__ as E
import corpus_pipeline as C
from pyspark.sql import functions as F

from tallystone.llm import mixing, rules, secrets, simhash
from tallystone.llm.common import stage

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = E.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = {}
    for name, f in C.STAGES:
        out[name] = (docs, stage(f(spark, docs, SF), "test-pipeline"))
        if name != C.STAGES[-1][0]:
            assert out[name][1].columns == docs.columns
        docs = out[name][1]
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    given, kept = out["quality rules"]
    assert ids(kept) == ids(rules.measure(given, labels).where("kept"))
    given, kept = out["simhash near-dedup"]
    assert ids(kept) == ids(simhash.simhash_components(given).where("doc_id = component_id"))
    given, kept = out["secret scans"]
    with_spans = secrets.scan(given).where("spans <> ''")
    assert ids(kept.where(F.col("text").contains("[SECRET]"))) == ids(with_spans)
    given, kept = out["source mixing"]
    want = mixing.mixture(given).where("size > 0").select("doc_id", (F.col("taken") / F.col("size")).cast("long").alias("n"))
    assert {r["doc_id"]: r["count"] for r in kept.groupBy("doc_id").count().collect()} == {
        r["doc_id"]: r["n"] for r in want.where("n > 0").collect()}
    given, tokens = out["byte-level bpe"]
    digests = lambda df, c: sorted(r[c] for r in df.select(c).collect())
    assert digests(tokens, "decoded_sha256") == sorted(
        hashlib.sha256(r["text"].encode()).hexdigest() for r in given.select("text").collect())
    assert tokens.where("n_tokens <> size(ids)").count() == 0


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in C.STAGES:
        docs = f(spark, docs, SF)
    assert docs.count() == 0
