import json
import os
import tempfile


from tallystone.sources import filings


def tmpdir():
    return tempfile.mkdtemp(prefix="tallystone-test-")


def test_directory_first_match_and_misses(spark):
    d = {"0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple"},
         "1": {"cik_str": 789019, "ticker": "MSFT", "title": "Microsoft"},
         "2": {"cik_str": 1, "ticker": "aapl", "title": "Dup"}}
    directory = filings.parse_directory(spark.createDataFrame([(json.dumps(d),)], "value string"))
    req = spark.createDataFrame([(0, "aapl"), (1, "ZZZ")], "ord int, ticker string")
    got = {r.ord: (r.cik, r.company_name, r.status) for r in filings.resolve_tickers(directory, req).collect()}
    assert got == {0: ("0000320193", "Apple", "ok"), 1: (None, None, "not_found")}


def test_recent_filings_document_order(spark):
    sub = {"cik": "0000320193", "filings": {"recent": {
        "form": ["8-K", "10-Q", "10-K", "10-Q"], "accessionNumber": ["a-1", "b-2", "c-3", "d-4"],
        "filingDate": ["d1", "d2", "d3", "d4"], "reportDate": ["r1", "r2", "r3", "r4"],
        "primaryDocument": ["p1", "p2", "p3", "p4"], "primaryDocDescription": ["x", "y", "z", "w"]}}}
    subs = filings.parse_submissions(spark.createDataFrame([(json.dumps(sub),)], "value string"))
    got = [(r.form, r.accession_number, r.accession_no_dashes) for r in
           filings.recent_filings(subs, limit=2).orderBy("pos").collect()]
    assert got == [("10-Q", "b-2", "b2"), ("10-K", "c-3", "c3")]


def test_load_fact_csvs_files_layout(spark):
    base = tmpdir()
    header = "concept,tag_used,value,unit,start,end,fiscal_year,fiscal_period,form,filed_date,accession_number,frame\n"
    with open(os.path.join(base, "AAPL_xbrl_facts.csv"), "w") as f:
        f.write(header + "revenue,Revenues,100.0,USD,2025-12-28,2026-03-28,2026.0,Q2,10-Q,2026-05-01,a,\n"
                         "revenue,Revenues,,USD,,bad-date,,Q2,10-Q,2026-05-01,a,\n")
    with open(os.path.join(base, "AAPL_companyfacts_raw.json"), "w") as f:
        json.dump({"cik": 320193, "entityName": "Apple Inc."}, f)
    with open(os.path.join(base, "MSFT_xbrl_facts.csv"), "w") as f:
        f.write(header + "revenue,Revenues,1.0,USD,,2026-03-31,2026,Q3,10-Q,2026-04-29,m,\n")
    with open(os.path.join(base, "NOPE_xbrl_facts.csv"), "w") as f:
        f.write(header)
    with open(os.path.join(base, "NOPE_companyfacts_raw.json"), "w") as f:
        json.dump({"cik": 5}, f)
    facts, report = filings.load_fact_csvs(spark, base, base)
    rows = facts.orderBy("value").collect()
    assert [(r.ticker, r.cik, r.company_name, r.value, r.fiscal_year) for r in rows] == [
        ("AAPL", "0000320193", "Apple Inc.", None, None), ("AAPL", "0000320193", "Apple Inc.", 100.0, 2026)]
    assert rows[1].period_end.isoformat() == "2026-03-28" and rows[0].period_end is None
    rep = {r.ticker: (r.status, r.n_rows) for r in report.collect()}
    assert rep == {"AAPL": ("loaded", 2), "MSFT": ("failed", 1), "NOPE": ("empty", 0)}
    summary = {r.status: r.n_units for r in filings.summarize_outcomes(report).collect()}
    assert summary == {"loaded": 1, "failed": 1, "empty": 1}


def test_watch_list_and_golden(spark):
    base = tmpdir()
    p = os.path.join(base, "watch.txt")
    with open(p, "w") as f:
        f.write("aapl\n\n# comment\n #kept\n msft \n")
    assert [r.ticker for r in filings.read_watch_list(spark, p).collect()] == ["AAPL", "#KEPT", "MSFT"]
    assert filings.read_golden(spark, os.path.join(base, "missing.json")).count() == 0
    g = os.path.join(base, "golden.json")
    with open(g, "w") as f:
        json.dump({"_readme": "r", "records": [{"id": "AAPL-2026Q2-revenue", "ticker": "AAPL",
                                                "expected_value": 111184000000, "fiscal_year": 2026}]}, f, indent=2)
    r = filings.read_golden(spark, g).first()
    assert (r.pos, r.id, r.expected_value, r.fiscal_year) == (0, "AAPL-2026Q2-revenue", 111184000000.0, 2026)
