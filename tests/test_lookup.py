import datetime as dt

from tallystone.operators import lookup

SCHEMA = ("ticker string, concept string, value double, period_start date, period_end date, "
          "filed_date date, accession_number string, form string, fiscal_year int, fiscal_period string")


def d(s):
    return dt.date.fromisoformat(s) if s else None


def facts(spark):
    rows = [("AAPL", "rev", 1.0, None, None, d("2026-06-01"), "a9", "10-Q", 2026, "Q3"),
            ("AAPL", "rev", 2.0, None, d("2026-03-28"), d("2026-05-01"), "a1", "10-Q", 2026, "Q2"),
            ("AAPL", "rev", 3.0, None, d("2026-03-28"), d("2026-08-01"), "a2", "10-Q", 2026, "Q2"),
            ("AAPL", "rev", 4.0, None, d("2025-12-27"), d("2026-02-01"), "a0", "10-Q", 2026, "Q1"),
            ("MSFT", "rev", 5.0, None, d("2026-03-31"), d("2026-04-29"), "m1", "10-Q", 2026, "Q3")]
    return spark.createDataFrame(rows, SCHEMA)


def test_latest_ignores_null_end_and_breaks_ties(spark):
    r = lookup.latest_fact(facts(spark), ticker="aapl", concept="rev").collect()
    assert [x.value for x in r] == [3.0]
    per = {x.ticker: x.value for x in lookup.latest_fact(facts(spark), keys=["ticker"]).collect()}
    assert per == {"AAPL": 3.0, "MSFT": 5.0}


def test_history_oldest_first_nulls_last(spark):
    h = lookup.fact_history(facts(spark), ticker="AAPL", concept="rev").collect()
    assert [x.value for x in h][0] == 4.0 and h[-1].period_end is None


def test_compare_keeps_request_order_and_repeats(spark):
    req = spark.createDataFrame([(0, "MSFT"), (1, "AAPL"), (2, "ZZZ"), (3, "AAPL")], "ord int, ticker string")
    got = [(r.ord, r.ticker) for r in lookup.compare_concept(facts(spark), req, concept="rev").collect()]
    assert got == [(0, "MSFT"), (1, "AAPL"), (3, "AAPL")]
