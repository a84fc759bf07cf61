"""Versions, near misses, optional tags and odd queries: cases in which a plain pick goes wrong."""

import numpy as np
import pytest

from tallystone.functions.text import html_to_text_expr
from tallystone.operators import facts as fo
from tallystone.operators import lookup, reconcile, tables, vectors
from pyspark.sql import functions as F


def test_ratio_takes_one_version_of_each_side(spark):
    rows = [("c", "revenue", 100.0, "2026-01-01"), ("c", "revenue", 100.0, "2026-02-01"), ("c", "gross_profit", 40.0, "2026-01-01"),
            ("c", "gross_profit", 30.0, "2025-12-01")]
    df = spark.createDataFrame(rows, "cik string, concept string, value double, filed_date string")
    r = fo.derived_ratio(df, ["cik"], order=["filed_date"]).first()
    assert (r["num_value"], r["den_value"], r["ratio"]) == (40.0, 100.0, 40.0)


def test_golden_and_claims_meet_the_shortest_newest_fact(spark):
    facts = spark.createDataFrame([("net_income", "2026-03-28", "2025-09-28", "2026-05-01", 71675.0),
                                   ("net_income", "2026-03-28", "2025-12-28", "2026-05-01", 29578.0),
                                   ("net_income", "2026-03-28", "2025-12-28", "2026-04-01", 99999.0)],
                                  "concept string, period_end string, period_start string, filed_date string, value double")
    golden = spark.createDataFrame([("net_income", "2026-03-28", 29578.0)], "concept string, period_end string, expected_value double")
    assert reconcile.golden_eval(golden, facts, ["concept", "period_end"]).first()["match"]
    claims = golden.withColumnRenamed("expected_value", "claimed_value")
    assert reconcile.verify_claims(claims, facts, ["concept", "period_end"]).first()["verdict"] == "verified"


def test_reconcile_number_boundaries(spark):
    cases = [(1e9, "Total net sales 21", False), (5.0, "rose to 15", False), (5.0, "rose to 5.", True), (5.0, "5,000", False),
             (1.53, "Diluted 1.53", True), (1.53, "Diluted 11.53", False), (46.9, "margin 46.9%", True), (-157030.0, "(157,030\n)", True),
             (157030.0, "$157,030 of", True), (1500.0, "1,500.00", True), (5.0, None, False)]
    df = spark.createDataFrame([(i, v, t) for i, (v, t, _) in enumerate(cases)], "i int, value double, text string")
    got = [r["verified"] for r in reconcile.reconcile_auto(df).orderBy("i").collect()]
    assert got == [w for _, _, w in cases]


def text_of(spark, html):
    return spark.createDataFrame([(html,)], "h string").select(html_to_text_expr(F.col("h"))).first()[0]


def test_html_text_one_pass(spark):
    assert text_of(spark, "<p>a</p><!-- <script> --><p>kept</p><script>x</script><p>b</p>").split() == ["a", "kept", "b"]
    assert text_of(spark, "<p title=\"1>2\">x</p>").split() == ["x"]
    assert text_of(spark, "<p title='1>2\">x</p>tail").split()[-1] == "tail"
    assert text_of(spark, "<p>a</p><script>never closed").split() == ["a"]


def test_tables_optional_end_tags_and_spans():
    grid = lambda h: {(r, c): x for _, r, c, x in tables.parse_tables(h)}
    assert grid("<table><tr><td>a<td>b<tr><td>c") == {(0, 0): "a", (0, 1): "b", (1, 0): "c"}
    tall = grid("<table><tr><td rowspan=1500>a</td></tr></table>")
    assert len(tall) == 1500 and set(tall.values()) == {"a"}


def test_compare_takes_lower_case_requests(spark):
    facts = spark.createDataFrame([("AAPL", "2026-01-01", 1.0), ("AAPL", "2026-02-01", 2.0), ("MSFT", "2026-01-01", 3.0)],
                                  "ticker string, period_end string, value double")
    asked = spark.createDataFrame([(0, "msft"), (1, "aapl"), (2, "ZZZ"), (3, "AAPL")], "ord int, ticker string")
    got = [(r["ord"], r["value"]) for r in lookup.compare_concept(facts, asked, order=["period_end"]).collect()]
    assert got == [(0, 3.0), (1, 2.0), (3, 2.0)]


def test_yoy_meets_52_and_53_week_years(spark):
    rows = [("c", "x", "2019-02-03", "2020-02-01", 100.0), ("c", "x", "2020-02-02", "2021-01-30", 150.0), ("c", "x", "2022-01-30", "2023-01-28", 9.0)]
    df = spark.createDataFrame([(*r, "f", "a") for r in rows], "cik string, concept string, s string, e string, value double, "
                               "filed_date string, accession_number string")
    df = df.withColumn("period_start", F.to_date("s")).withColumn("period_end", F.to_date("e"))
    got = {str(r["period_end"]): r["growth_pct"] for r in fo.fact_yoy(df).collect()}
    assert got == {"2020-02-01": None, "2021-01-30": 50.0, "2023-01-28": None}


def test_vector_search_odd_query_sets(spark, monkeypatch):
    items = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], "id long, embedding array<float>")
    none = spark.createDataFrame([], "qid long, embedding array<float>")
    assert vectors.vector_search(items, none).count() == 0
    mixed = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "qid long, embedding array<float>")
    with pytest.raises(Exception, match="width"):
        vectors.vector_search(items, mixed).collect()
    one_id = spark.createDataFrame([(7, [float(x), 1.0]) for x in range(12)], "qid long, embedding array<float>")
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 4)
    monkeypatch.setattr(vectors, "ITEM_BLOCK", 2)
    assert vectors.vector_search(items, one_id, k=2).count() == 2
    assert np.isfinite(vectors.vector_search(items, one_id, k=2).toPandas()["distance"]).all()
