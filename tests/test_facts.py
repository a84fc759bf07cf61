import json


from tallystone.operators import facts as fo
from tallystone.sources import filings


def doc(cik, tags):
    return json.dumps({"cik": cik, "entityName": f"Co{cik}", "facts": {"us-gaap": {
        t: {"label": t, "units": units} for t, units in tags.items()}}})


def row(end, val, accn="0000000001-26-000001", start=None):
    return {"start": start, "end": end, "val": val, "accn": accn, "fy": 2026, "fp": "Q2",
            "form": "10-Q", "filed": "2026-05-01", "frame": None}


def test_tag_fallback_fixture(spark):
    docs = [
        doc(1, {"A": {"USD": [row("2026-03-28", 1), row("2026-06-28", 2)]},
                "B": {"USD": [row("2026-03-28", i) for i in range(5)]}}),
        doc(2, {"A": {"USD": [], "EUR": [row("2026-03-28", i) for i in range(3)]},
                "B": {"USD": [row("2026-03-28", 9)]}}),
        '{"cik": 3, "entityName": "Co3", "facts": {"us-gaap": {"A": {"label": "A", "units": '
        '{"EUR": [' + json.dumps(row("2026-03-28", 7)) + '], "USD/shares": ['
        + json.dumps(row("2026-03-28", 8)) + ',' + json.dumps(row("2026-06-28", 8)) + ']}}}}}',
        doc(4, {"C": {"USD": [row("2026-03-28", 1)]}}),
    ]
    parsed = filings.parse_company_facts(spark.createDataFrame([(d,) for d in docs], "value string"))
    tidy = fo.tag_fallback_doc(parsed, {"x": ["A", "B"]})
    got = {}
    for r in tidy.collect():
        got.setdefault(r.cik, []).append((r.tag_used, r.unit, r.value))
    assert got[1] == [("A", "USD", 1.0), ("A", "USD", 2.0)]
    assert got[2] == [("B", "USD", 9.0)]           # empty USD does not fall to EUR
    assert got[3] == [("A", "EUR", 7.0)]           # first unit in document order
    assert 4 not in got
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,)], "cik long")      # 4 has no fact at all
    unc = fo.uncovered_concepts(tidy, ["x"], entities=asked)
    assert sorted((r.cik, r.concept) for r in unc.collect()) == [(4, "x")]


def facts_df(spark, rows):
    return spark.createDataFrame(rows, "cik string, concept string, start string, end string, "
                                       "form string, accession_number string, value double")


def test_derived_ratio_strict(spark):
    a = "0000320193-26-000013"
    rows = [("c", "revenue", "2026-01-01", "2026-03-28", "10-Q", a, 100.0),
            ("c", "revenue", "2025-10-01", "2026-03-28", "10-Q", a, 250.0),
            ("c", "gross_profit", "2026-01-01", "2026-03-28", "10-Q", a, 40.0),
            ("c", "gross_profit", "2025-10-01", "2026-03-28", "10-Q", a, 90.0),
            ("d", "revenue", "2026-01-01", "2026-03-28", "10-Q", a, 0.0),
            ("d", "gross_profit", "2026-01-01", "2026-03-28", "10-Q", a, 5.0)]
    g = fo.gross_margin(facts_df(spark, rows))
    got = sorted((r.cik, r.start, r.value) for r in g.collect())
    assert got == [("c", "2025-10-01", 36.0), ("c", "2026-01-01", 40.0), ("d", "2026-01-01", None)]
    assert {r.concept for r in g.collect()} == {"gross_margin_pct"}
    both = fo.with_derived(facts_df(spark, rows))
    assert both.count() == len(rows) + 3            # derived rows appended once


def test_yoy_growth_needs_exact_previous_year(spark):
    df = spark.createDataFrame([("a", 2020, 100.0), ("a", 2021, 110.0), ("a", 2023, 121.0)],
                               "s string, year int, v double")
    got = {r.year: r.growth_pct for r in fo.yoy_growth(df, ["s"], "year", "v").collect()}
    assert got == {2020: None, 2021: 10.0, 2023: None}


def test_gross_margin_inherits_period(spark):
    rows = [("c", "revenue", "2026-01-01", "2026-03-28", "10-Q", "a", 100.0, 2026, "Q2"),
            ("c", "gross_profit", "2026-01-01", "2026-03-28", "10-Q", "a", 40.0, 2026, "Q2")]
    df = spark.createDataFrame(rows, "cik string, concept string, start string, end string, form string, "
                                     "accession_number string, value double, fiscal_year int, fiscal_period string")
    plain = fo.gross_margin(df).first()
    assert (plain.fiscal_year, plain.fiscal_period) == (None, None)
    inh = fo.gross_margin(df, inherit_period=True).first()
    assert (inh.value, inh.fiscal_year, inh.fiscal_period) == (40.0, 2026, "Q2")


def test_facts_to_store_with_derived_rows(spark):
    r = {"start": "2026-01-01", "end": "2026-03-28", "accn": "0000320193-26-000013", "fy": 2026, "fp": "Q2",
         "form": "10-Q", "filed": "2026-05-01", "frame": None}
    d = {"cik": 320193, "entityName": "Apple Inc.", "facts": {"us-gaap": {
        "Revenues": {"label": "r", "units": {"USD": [dict(r, val=100.0)]}},
        "GrossProfit": {"label": "g", "units": {"USD": [dict(r, val=40.0)]}}}}}
    docs = filings.parse_company_facts(spark.createDataFrame([(json.dumps(d),)], "value string"))
    tick = spark.createDataFrame([(320193, "aapl")], "cik long, ticker string")
    rows = {x.concept: x for x in fo.facts_to_store(docs, tick).collect()}
    assert set(rows) == {"revenue", "gross_profit", "gross_margin_pct"}
    gm = rows["gross_margin_pct"]
    assert (gm.cik, gm.ticker, gm.company_name, gm.value, gm.unit) == ("0000320193", "AAPL", "Apple Inc.", 40.0, "percent")
    assert rows["revenue"].period_end.isoformat() == "2026-03-28" and rows["revenue"].fiscal_year == 2026
