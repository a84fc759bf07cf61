import numpy as np
from pyspark.sql import functions as F

from tallystone.operators import vectors


def test_vector_search_fixture(spark):
    items = spark.createDataFrame(
        [(1, [1.0, 1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [-1.0, 0.0]), (5, [0.0, 0.0]), (6, None),
         (7, [2.0, 0.0])], "id long, embedding array<float>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "qid int, embedding array<float>")
    got = [(r.rank, r.id, r.distance) for r in vectors.vector_search(items, q, k=10).orderBy("rank").collect()]
    assert got == [(1, 2, 0.0), (2, 7, 0.0), (3, 1, 0.292893), (4, 3, 1.0), (5, 4, 2.0)]


def test_topk_prefix_property(spark):
    rng = np.random.default_rng(3)
    items = spark.createDataFrame([(i, rng.normal(size=8).astype(float).tolist()) for i in range(300)],
                                  "id long, embedding array<double>").repartition(4)
    q = spark.createDataFrame([(j, rng.normal(size=8).astype(float).tolist()) for j in range(3)],
                              "qid int, embedding array<double>")
    k5 = {(r.qid, r.rank): r.id for r in vectors.vector_search(items, q, k=5).collect()}
    k6 = {(r.qid, r.rank): r.id for r in vectors.vector_search(items, q, k=6).collect()}
    assert all(k6[key] == v for key, v in k5.items())
    # exact against brute force
    data = {r.id: np.array(r.embedding) for r in items.collect()}
    for r in q.collect():
        qv = np.array(r.embedding)
        d = sorted((round(1 - qv @ v / (np.linalg.norm(qv) * np.linalg.norm(v)), 6), i) for i, v in data.items())
        assert [k6[(r.qid, n + 1)] for n in range(6)] == [i for _, i in d[:6]]


def test_hashing_embedder_unit_norm(spark):
    df = spark.createDataFrame([(1, "net sales grew"), (2, "")], "id long, chunk_text string")
    rows = {r.id: r for r in vectors.embed_chunks(df, dim=16).collect()}
    assert abs(np.linalg.norm(rows[1].embedding) - 1) < 1e-6
    assert rows[1].embed_model == "hashing-tf-l2-16"


def test_text_search_filters_and_model_check(spark):
    import pytest
    ch = spark.createDataFrame(
        [(1, "AAPL", "10-Q", "Item 2. Risk", 0, "net sales grew strongly"),
         (2, "MSFT", "10-Q", "Item 2. Risk", 0, "net sales grew strongly"),
         (3, "AAPL", "10-K", "Item 7. MD&A", 1, "cash and cash equivalents")],
        "chunk_id long, ticker string, form string, section string, chunk_index int, chunk_text string")
    emb = vectors.embed_chunks(ch, dim=32)
    q = spark.createDataFrame([(0, "net sales grew")], "qid int, text string")
    r = vectors.search(emb, q, k=3, tickers=["aapl"], dim=32).orderBy("rank").collect()
    assert [x.chunk_id for x in r] == [1, 3] and r[0].similarity_pct > r[1].similarity_pct
    r = vectors.search(emb, q, k=3, form="10-Q", section_contains="risk", dim=32).collect()
    assert sorted(x.chunk_id for x in r) == [1, 2]
    with pytest.raises(Exception, match="embedded with hashing-tf-l2-32, query with hashing-tf-l2-16"):
        vectors.search(emb, q, dim=16).collect()


def test_blocks_of_any_size_agree(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [rng.normal(size=4).astype(float).tolist() for _ in range(60)]
    items = spark.createDataFrame([(f"i{i:03d}", base[i % 60]) for i in range(200)],     # ties between copies
                                  "id string, embedding array<double>").repartition(3)
    q = spark.createDataFrame([(j, rng.normal(size=4).astype(float).tolist()) for j in range(30)],
                              "qid int, embedding array<double>")
    one = sorted(tuple(r) for r in vectors.vector_search(items, q, k=5).collect())
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 7)
    monkeypatch.setattr(vectors, "ITEM_BLOCK", 3)
    many = sorted(tuple(r) for r in vectors.vector_search(items, q, k=5).collect())
    assert many == one and len(one) == 150


def test_no_queries_odd_vectors_and_widths(spark):
    import pytest
    nan = float("nan")
    items = spark.createDataFrame([(1, [1.0, 1.0]), (2, []), (3, [nan, 1.0]), (4, [None, 1.0]), (5, None)],
                                  "id long, embedding array<double>")
    none = spark.createDataFrame([], "qid int, embedding array<double>")
    assert vectors.vector_search(items, none).collect() == []
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None)], "qid int, embedding array<double>")
    assert [(r.qid, r.id) for r in vectors.vector_search(items, q).collect()] == [(0, 1)]
    wide = spark.createDataFrame([(0, [1.0, 0.0, 0.0])], "qid int, embedding array<double>")
    with pytest.raises(Exception, match="width"):
        vectors.vector_search(items, wide).collect()


def test_declaring_a_search_runs_no_job(spark):
    items = spark.range(100).select("id", F.array(F.rand(1), F.rand(2)).alias("embedding"))
    q = items.select(F.col("id").alias("qid"), "embedding")
    spark.sparkContext.setJobGroup("declared", "declared")
    vectors.vector_search(items, q, k=3)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("declared")) == 0
