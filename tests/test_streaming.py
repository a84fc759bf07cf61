import tempfile


from tallystone.streaming.incremental import current_view, loads_in_log, run_incremental_load


def test_incremental_runs_are_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="tallystone-stream-")
    land, log, ck = f"{base}/landing", f"{base}/log", f"{base}/ck"
    schema = "k string, v long"
    first = spark.createDataFrame([("a", 1), ("b", 1)], schema)
    first.write.parquet(f"{land}/drop=0")
    run_incremental_load(spark, land, log, ck, first.schema, timeout_s=300)
    spark.createDataFrame([("a", 2)], schema).write.parquet(f"{land}/drop=1")
    run_incremental_load(spark, land, log, ck, first.schema, timeout_s=300)
    run_incremental_load(spark, land, log, ck, first.schema, timeout_s=300)   # nothing new
    loads = sorted((r.load_seq, r.n_rows) for r in loads_in_log(spark, log).collect())
    assert loads == [(0, 2), (1, 1)]
    cur = {r.k: r.v for r in current_view(spark, log, ["k"]).collect()}
    assert cur == {"a": 2, "b": 1}
    # a fresh checkpoint takes every file again, as a newer load; the old ones stay
    run_incremental_load(spark, land, log, f"{base}/ck2", first.schema, timeout_s=300)
    assert sorted((r.load_seq, r.n_rows) for r in loads_in_log(spark, log).collect()) == [(0, 2), (1, 1), (2, 3)]
