from pyspark.sql import functions as F

from tallystone.operators import store

COLS = ("cik string, concept string, period_start string, period_end string, form string, "
        "accession_number string, value double, load_seq int, row_ord long")


def test_upsert_last_write_wins(spark):
    rows = [("1", "c", "s", "K1", "10-Q", "a", 10.0, 1, 0), ("1", "c", "s", "K2", "10-Q", "a", 5.0, 1, 1),
            ("1", "c", "s", "K3", "10-Q", "a", 7.0, 1, 2), ("1", "c", "s", "K3", "10-Q", "a", 8.0, 1, 3),
            ("1", "c", "s", "K1", "10-Q", "a", 12.0, 2, 0)]
    cur = store.upsert_facts(spark.createDataFrame(rows, COLS))
    got = {r.period_end: r.value for r in cur.collect()}
    assert got == {"K1": 12.0, "K2": 5.0, "K3": 8.0}
    # loading the same batch again changes nothing
    again = spark.createDataFrame(rows + [r[:7] + (3, r[8]) for r in rows if r[7] == 2], COLS)
    assert {r.period_end: r.value for r in store.upsert_facts(again).collect()} == got


def test_upsert_strict_vs_compat(spark):
    rows = [("320193", "net_income", "2025-12-28", "2026-03-28", "10-Q", "a", 29578.0, 1, 0),
            ("320193", "net_income", "2025-09-28", "2026-03-28", "10-Q", "a", 71675.0, 1, 1)]
    df = spark.createDataFrame(rows, COLS)
    assert sorted(r.value for r in store.upsert_facts(df, "strict").collect()) == [29578.0, 71675.0]
    assert [r.value for r in store.upsert_facts(df, "compat").collect()] == [71675.0]


def test_upsert_chunks_modes(spark):
    log = spark.createDataFrame(
        [("a", i, 1, f"old{i}") for i in range(3)] + [("a", 0, 2, "new0")] + [("b", 0, 1, "b0")],
        "accession_number string, chunk_index int, load_seq int, chunk_text string")
    rep = sorted((r.accession_number, r.chunk_index, r.chunk_text) for r in store.upsert_chunks(log).collect())
    assert rep == [("a", 0, "new0"), ("b", 0, "b0")]
    key = sorted((r.accession_number, r.chunk_index, r.chunk_text)
                 for r in store.upsert_chunks(log, mode="key").collect())
    assert key == [("a", 0, "new0"), ("a", 1, "old1"), ("a", 2, "old2"), ("b", 0, "b0")]


def test_golden_upsert(spark):
    base = spark.createDataFrame([("AAPL-2026Q2-revenue", 1.0, 0, 0), ("AAPL-2026Q2-net_income", 2.0, 0, 1)],
                                 "id string, v double, load_seq int, pos long")
    batch = spark.createDataFrame([("AAPL-2026Q2-revenue", 9.0, 1, 0)], "id string, v double, load_seq int, pos long")
    keep = {r.id: r.v for r in store.golden_upsert(base, batch, overwrite=False).collect()}
    assert keep == {"AAPL-2026Q2-revenue": 1.0, "AAPL-2026Q2-net_income": 2.0}
    ow = store.golden_upsert(base, batch, overwrite=True).orderBy("load_seq", "pos").collect()
    assert [(r.id, r.v) for r in ow] == [("AAPL-2026Q2-net_income", 2.0), ("AAPL-2026Q2-revenue", 9.0)]


def test_latest_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = store.latest_by_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_upsert_chunks_over_union_of_spread_inputs(spark):
    """Regression: two chunk generations of the same documents, unioned."""
    from tallystone.operators import chunks
    texts = spark.createDataFrame([(i, " ".join(["w"] * (100 + 37 * i)), "en" if i % 2 else "fr")
                                   for i in range(40)], "doc_id long, text string, lang string")
    g1 = chunks.token_windows(texts, size=50, overlap=5).withColumn("load_seq", F.lit(1))
    g2 = chunks.token_windows(texts.filter(F.col("lang") == "en"), size=80, overlap=10) \
        .withColumn("load_seq", F.lit(2))
    log = g1.unionByName(g2).withColumnRenamed("window_index", "chunk_index")
    saved = spark.conf.get("spark.sql.unionOutputPartitioning")
    try:
        spark.conf.set("spark.sql.unionOutputPartitioning", "true")      # the driver's default
        cur = store.upsert_chunks(log, doc_col="doc_id").collect()
    finally:
        spark.conf.set("spark.sql.unionOutputPartitioning", saved)
    newest = {}
    for r in cur:
        newest.setdefault(r.doc_id, set()).add(r.load_seq)
    assert all(v == ({2} if d % 2 else {1}) for d, v in newest.items()) and len(newest) == 40
