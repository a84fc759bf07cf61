import os
import tempfile

import numpy as np
import pytest

from tallystone.operators import store, vectors
from tallystone.session import shared_dir

COLS = ("cik string, concept string, period_start string, period_end string, form string, "
        "accession_number string, value double")


def test_log_roundtrip_idempotent(spark):
    base = shared_dir(spark, "store-test")
    log = f"{base}/log"
    l1 = spark.createDataFrame([("1", "c", "s", "e1", "10-Q", "a", 1.0), ("2", "c", "s", "e1", "10-Q", "a", 5.0)], COLS)
    l2 = spark.createDataFrame([("1", "c", "s", "e1", "10-Q", "a", 2.0)], COLS)
    store.append_load(l1, log, 1)
    store.append_load(l2, log, 2)
    store.append_load(l2, log, 2)              # a retried load rewrites its own folder
    cur = store.upsert_facts(store.read_log(spark, log))
    assert sorted((r.cik, r.value) for r in cur.collect()) == [("1", 2.0), ("2", 5.0)]
    store.compact(cur.drop("load_seq", "row_ord"), f"{base}/current")
    back = spark.read.parquet(f"{base}/current")
    assert back.filter("cik = '1'").first().value == 2.0


def test_pluggable_embedder(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "de")], "id long, chunk_text string")

    def emb(texts):
        assert len(texts) <= 100
        return np.array([[len(t), 1.0, 0.0] for t in texts])

    out = {r.id: r for r in vectors.embed_chunks(df, embedder=emb, model_id="len-3").collect()}
    assert out[1].embedding == [3.0, 1.0, 0.0] and out[2].embed_model == "len-3"
    own = vectors.require_model(vectors.embed_chunks(df, embedder=emb, model_id="len-3"), "len-3")
    assert {r.id: r.embedding for r in own.collect()} == {i: r.embedding for i, r in out.items()}
    with pytest.raises(Exception, match="query with len-3"):
        vectors.require_model(vectors.embed_chunks(df, dim=8), "len-3").collect()


def test_embedder_sees_batches_of_100(spark):
    seen = []
    df = spark.range(250).selectExpr("id", "cast(id as string) as chunk_text").coalesce(1)

    def emb(texts):
        assert len(texts) <= 100
        return np.array([[float(t), 0.0] for t in texts])

    rows = vectors.embed_chunks(df, embedder=emb, model_id="x").collect()
    assert all(r.embedding[0] == float(r.id) for r in rows) and len(rows) == 250
