"""Plans: filters reach the Parquet scan, only needed columns are read."""

import __spark_entry__ as E
from tallystone.operators import lookup

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_filters_pushed_to_scan(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan_of(lookup.latest_fact(o, keys=["o_custkey"], order=["o_orderdate"], concept="1-URGENT",
                                   concept_col="o_orderpriority"))
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in p


def test_ratio_reads_only_needed_columns(spark):
    p = plan_of(E.queries()["derived_ratio"](spark, SF))
    scan = [ln for ln in p.splitlines() if "ReadSchema" in ln or "FileScan parquet" in ln][0]
    assert "props" not in scan and "event_id" not in scan
    assert "In(event_type" in p or "event_type IN" in p


def test_text_and_search_plans_have_no_pair_joins(spark):
    for name in ("html_to_text", "token_windows", "build_chunks", "reconcile_snippets"):
        p = plan_of(E.queries()[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_vector_search_pairs_blocks_only(spark):
    p = plan_of(E.queries()["vector_search"](spark, SF))
    joins = [ln for ln in p.splitlines() if "CartesianProduct" in ln or "NestedLoopJoin" in ln]
    # one join, of packed blocks on both sides: two packing steps below it, the scoring above
    assert len(joins) == 1 and p.count("MapInArrow") == 3
    below = p[p.index(joins[0]):]
    assert below.count("MapInArrow pack(") == 2
