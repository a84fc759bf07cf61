"""Snapshot plus tail, stable survivors, and incremental ratios."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from tallystone.operators import facts, snapshot, store
from tallystone.session import shared_dir
from tallystone.sources import filings
from tallystone.streaming.incremental import current_view, loads_in_log

ROW = "k string, c string, v double, at long, extra map<string,string>"


def load(spark, rng, n):
    rows = [(rng.choice(["a", "b", "c", None, "d"]), rng.choice("xy"), float(rng.randint(0, 9)), rng.randint(0, 3), None) for _ in range(n)]
    return spark.createDataFrame(rows, ROW)


def rows(df):
    return sorted((str(r) for r in df.select(*sorted(c for c in df.columns if c != "extra")).collect()))


def test_snapshot_and_tail_equal_the_whole_log(spark):
    rng, base = random.Random(1), shared_dir(spark, "snapshot-test")
    log, snaps, keys = f"{base}/log", f"{base}/snaps", ["k", "c"]
    for n in range(6):
        store.append_load(load(spark, rng, 20), log, n)
        whole = rows(current_view(spark, log, keys, ["at"]))
        assert rows(current_view(spark, log, keys, ["at"], snapshot_dir=snaps)) == whole
        if n in (1, 2, 4):
            assert snapshot.compact_log(spark, log, snaps, keys, ["at"]) == n
            assert snapshot.compact_log(spark, log, snaps, keys, ["at"]) == n          # nothing new
            assert rows(current_view(spark, log, keys, ["at"], snapshot_dir=snaps)) == whole
    files = current_view(spark, log, keys, ["at"], snapshot_dir=snaps).inputFiles()
    assert files and all("/upto=4/" in f or "/load_seq=5/" in f for f in files)       # nothing older is read
    assert snapshot.compact_log(spark, log, snaps, keys, ["at"], whole=True) == 5
    assert rows(current_view(spark, log, keys, ["at"], snapshot_dir=snaps)) == rows(current_view(spark, log, keys, ["at"]))


def test_a_snapshot_cut_short_is_ignored(spark):
    rng, base = random.Random(2), shared_dir(spark, "snapshot-test")
    log, snaps = f"{base}/log", f"{base}/snaps"
    store.append_load(load(spark, rng, 9), log, 0)
    load(spark, rng, 3).withColumn("load_seq", F.lit(7)).withColumn("row_ord", F.lit(0)).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{snaps}/upto=7")
    assert snapshot.newest_snapshot(spark, snaps) == (None, None)
    assert rows(current_view(spark, log, ["k"], snapshot_dir=snaps)) == rows(current_view(spark, log, ["k"]))


def test_the_survivor_is_the_same_under_any_partitioning(spark):
    rng, base = random.Random(3), shared_dir(spark, "snapshot-test")
    df, seen = load(spark, rng, 200).cache(), set()
    for parts in (1, 3, 8):
        log = f"{base}/log-{parts}"
        store.append_load(df.repartition(parts, F.rand(parts)), log, 0)
        seen.add(tuple(rows(current_view(spark, log, ["k"], []))))
    assert len(seen) == 1
    strict = [rows(store.upsert_facts(df.withColumn("load_seq", F.lit(0)).withColumn("row_ord", F.lit(0)).repartition(p), keys=["k"])) for p in (1, 7)]
    assert strict[0] == strict[1]


def test_csv_rows_keep_their_place_however_the_file_is_split(spark):
    base = tempfile.mkdtemp(prefix="tallystone-position-")
    os.makedirs(f"{base}/csv"), os.makedirs(f"{base}/side")
    names = [f.name for f in filings.FACT_CSV.fields]
    for t in ("AAA", "BB"):
        with open(f"{base}/csv/{t}_xbrl_facts.csv", "w") as f:
            f.write(",".join(names) + "\n")
            for i in range(4000):
                row = {"concept": "c", "tag_used": "t", "value": float(i), "unit": "USD", "start": "2026-01-01", "end": "2026-03-31",
                       "form": "10-Q", "accession_number": "a", "fiscal_year": 2026.0, "fiscal_period": "Q1", "filed_date": "2026-05-01"}
                f.write(",".join(str(row.get(n, "")) for n in names) + "\n")
        with open(f"{base}/side/{t}_companyfacts_raw.json", "w") as f:
            f.write('{"cik": %d, "entityName": "%s"}' % (len(t), t))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "16k", "7k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            loaded, _ = filings.load_fact_csvs(spark, f"{base}/csv", f"{base}/side")
            got = {r.ticker: r.value for r in store.upsert_facts(loaded, mode="compat").collect()}
            assert got == {"AAA": 3999.0, "BB": 3999.0}                              # the last line wins
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_ratios_follow_changed_keys_only(spark):
    cols = "k string, concept string, value double"
    first = spark.createDataFrame([("a", "gross_profit", 1.0), ("a", "revenue", 2.0), ("b", "gross_profit", 1.0), ("b", "revenue", 4.0),
                                   (None, "gross_profit", 1.0), (None, "revenue", 1.0)], cols)
    newer = spark.createDataFrame([("b", "revenue", 8.0), ("c", "gross_profit", 3.0), ("c", "revenue", 3.0), (None, "revenue", 2.0)], cols)
    previous = facts.derived_ratio(first, ["k"]).withColumn("ratio", F.when(F.col("k") == "a", 77.0).otherwise(F.col("ratio")))
    now = store.latest_by_key(first.withColumn("n", F.lit(0)).unionByName(newer.withColumn("n", F.lit(1))), ["k", "concept"], ["n"])
    got = {r.k: r.ratio for r in snapshot.refresh_ratios(previous, now.drop("n"), newer, ["k"]).collect()}
    assert got == {"a": 77.0, "b": 12.5, "c": 100.0, None: 50.0}                      # a was not computed again


def test_loads_keep_counting(spark):
    base = shared_dir(spark, "snapshot-test")
    store.append_load(spark.createDataFrame([("a", 1)], "k string, v long"), f"{base}/log", 3)
    assert [(r.load_seq, r.n_rows) for r in loads_in_log(spark, f"{base}/log").collect()] == [(3, 1)]
