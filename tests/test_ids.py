from pyspark.sql import functions as F

from tallystone.functions import ids


def test_parse_filename(spark):
    stems = ["AAPL_10-Q_2026-05-01_000032019326000013", "BRK.B_10-K_2026-02-20_000000000026000001",
             "AAPL_8-K_2026-05-01_000032019326000013"]
    df = spark.createDataFrame([(s,) for s in stems], "stem string")
    strict = df.select(*[c.alias(k) for k, c in ids.parse_filename_cols(F.col("stem")).items()]).collect()
    assert tuple(strict[0])[:4] == ("AAPL", "10-Q", "2026-05-01", "0000320193-26-000013")
    assert [r.valid for r in strict] == [True, False, False]
    ext = df.select(ids.parse_filename_cols(F.col("stem"), strict=False)["valid"].alias("v")).collect()
    assert [r.v for r in ext] == [True, True, False]


def test_normalize_cik(spark):
    df = spark.createDataFrame([("320193",), ("CIK320193",), (" cik320193 ",), ("12345678901",)], "c string")
    got = [r.n for r in df.select(ids.normalize_cik(F.col("c")).alias("n")).collect()]
    assert got == ["0000320193", "0000320193", "0000320193", "12345678901"]


def test_accession_and_urls(spark):
    df = spark.createDataFrame([("0000320193", "0000320193-26-000013", "a.htm")], "cik string, a string, d string")
    u = df.select(*[c.alias(k) for k, c in ids.filing_urls(F.col("cik"), F.col("a"), F.col("d")).items()],
                  ids.accession_dash(ids.accession_undash(F.col("a"))).alias("back")).first()
    assert u.archive_base == "https://www.sec.gov/Archives/edgar/data/320193/000032019326000013"
    assert u.primary_document_url.endswith("/000032019326000013/a.htm")
    assert u.complete_submission_text_url.endswith("/000032019326000013/0000320193-26-000013.txt")
    assert u.filing_detail_page_url == "https://www.sec.gov/Archives/edgar/data/320193/0000320193-26-000013-index.html"
    assert u.back == "0000320193-26-000013"
