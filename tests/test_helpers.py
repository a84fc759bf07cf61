import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tallystone.functions import ids
from tallystone.functions.fmt import format_value
from tallystone.operators import facts as fo
from tallystone.operators import lookup, reconcile, vectors
from tallystone.sources import filings, sinks


def test_format_value(spark):
    df = spark.createDataFrame([(1234567.4, "USD"), (12.345, "percent"), (1.5, "USD/shares")], "v double, u string")
    got = [r.f for r in df.select(format_value(F.col("v"), F.col("u")).alias("f")).collect()]
    assert got == ["$1,234,567", "12.35%", "1.5000 USD/shares"]


def test_golden_record_id(spark):
    df = spark.createDataFrame([("aapl", 2026, "Q2", "revenue")], "t string, y int, p string, c string")
    assert df.select(ids.golden_record_id(F.col("t"), F.col("y"), F.col("p"), F.col("c"))).first()[0] \
        == "AAPL-2026Q2-revenue"


def test_match_text_files_dashed_or_not(spark):
    facts = spark.createDataFrame([("0000320193-26-000013",), ("0000000001-26-000001",)], "accession_number string")
    texts = spark.createDataFrame([("AAPL_10-Q_2026-05-01_000032019326000013.txt", "t1"),
                                   ("AAPL_10-Q_2026-05-01_0000320193-26-000013.txt", "t0")],
                                  "file_name string, text string")
    got = {r.accession_number: r.text for r in reconcile.match_text_files(facts, texts).collect()}
    assert got == {"0000320193-26-000013": "t0", "0000000001-26-000001": None}


def test_search_filters_and_preview(spark):
    items = spark.createDataFrame(
        [(1, [1.0, 0.0], "AAPL", "10-Q", "Item 2. Risk"), (2, [1.0, 0.1], "MSFT", "10-Q", "Item 1. Legal"),
         (3, [1.0, 0.2], "AAPL", "10-K", "Item 1A. risk factors")],
        "id long, embedding array<float>, ticker string, form string, section string")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "qid int, embedding array<float>")
    r = vectors.vector_search(items, q, k=5, payload=["ticker", "form", "section"],
                              any_of={"ticker": ["AAPL"]}, ilike={"section": "RISK"}).orderBy("rank").collect()
    assert [x.id for x in r] == [1, 3]
    r = vectors.vector_search(items, q, k=5, any_of={"ticker": []}, equals={"form": "10-Q"}).collect()
    assert sorted(x.id for x in r) == [1, 2]
    res = spark.createDataFrame([(0.25, "s" * 70, "a\nb")], "distance double, section string, chunk_text string")
    p = vectors.search_preview(vectors.with_similarity(res)).first()
    assert (p.similarity_pct, len(p.section_preview), p.text_preview) == (75.0, 60, "a b")


def test_fact_yoy_on_stored_facts(spark):
    d = dt.date.fromisoformat
    rows = [("c", "rev", d("2025-01-01"), d("2025-03-31"), 100.0, d("2025-05-01"), "a1"),
            ("c", "rev", d("2026-01-01"), d("2026-03-31"), 110.0, d("2026-05-01"), "a2"),
            ("c", "rev", d("2025-04-01"), d("2026-03-31"), 400.0, d("2026-05-01"), "a2")]
    df = spark.createDataFrame(rows, "cik string, concept string, period_start date, period_end date, "
                                     "value double, filed_date date, accession_number string")
    got = {(r.bucket, r.value): r.growth_pct for r in fo.fact_yoy(df).collect()}
    assert got[("Q", 110.0)] == 10.0 and got[("FY", 400.0)] is None


def test_concept_list_and_writers_roundtrip(spark):
    base = tempfile.mkdtemp(prefix="tallystone-sink-")
    tidy = spark.createDataFrame([("AAPL", "revenue", "Revenues", 1.0, "USD", None, "2026-03-28", 2026.0, "Q2",
                                   "10-Q", "2026-05-01", "a", None)],
                                 "ticker string, concept string, tag_used string, value double, unit string, "
                                 "start string, end string, fiscal_year double, fiscal_period string, form string, "
                                 "filed_date string, accession_number string, frame string")
    ident = spark.createDataFrame([("AAPL", 320193, "Apple"), ("MSFT", 789019, "Microsoft")],
                                  "ticker string, cik long, entityName string")
    sinks.write_fact_files(tidy, ident, base)
    assert not os.path.exists(f"{base}/sidecars/ticker=MSFT")        # no facts -> no sidecar
    loaded, report = filings.load_fact_csvs(spark, f"{base}/csv", f"{base}/sidecars", layout="partitioned")
    r = loaded.first()
    assert (r.cik, r.company_name, r.fiscal_year) == ("0000320193", "Apple", 2026)
    assert [x.concept for x in lookup.concept_list(loaded).collect()] == ["revenue"]


def test_read_html_by_ticker_and_newest(spark):
    base = tempfile.mkdtemp(prefix="tallystone-html-")
    for name, body in [("AAPL_10-Q_2026-05-01_1.html", "<p>a</p>\n<p>b</p>\n"),
                       ("MSFT_10-Q_2026-04-29_2.html", "<p>m</p>")]:
        with open(os.path.join(base, name), "w") as f:
            f.write(body)
    os.utime(os.path.join(base, "AAPL_10-Q_2026-05-01_1.html"), (1, 1))
    rows = filings.read_html(spark, base, ticker="aapl").collect()
    assert [(r.stem, r.html) for r in rows] == [("AAPL_10-Q_2026-05-01_1", "<p>a</p>\n<p>b</p>\n")]
    assert [r.stem for r in filings.read_html(spark, base, newest_only=True).collect()] == ["MSFT_10-Q_2026-04-29_2"]
