"""The reconciliation flow, golden records, the chunk outcome report, and text, table and golden sinks."""

import json
import os

from tallystone.operators import lookup, metadata, reconcile
from tallystone.sources import filings, sinks

FACT_T = ("ticker string, concept string, value double, unit string, period_start string, period_end string, "
          "filed_date string, accession_number string, fiscal_year int, fiscal_period string, form string")


def _fact(ticker, concept, value, accn, end="2026-03-28", unit="USD"):
    return (ticker, concept, value, unit, None, end, end, accn, 2026, "Q2", "10-Q")


def test_reconcile_newest_and_golden(spark):
    a, b, c = ("0000000001-26-000001", "0000000001-26-000002", "0000000001-26-000003")
    facts = spark.createDataFrame([
        _fact("AAPL", "revenue", 95359e6, a, "2025-03-29"),            # older: not looked up
        _fact("AAPL", "revenue", 111184e6, b),
        _fact("AAPL", "net_income", 5.0, b),                           # near miss: 15 holds a 5
        _fact("AAPL", "total_assets", 1.0, b),                         # no keyword in the text
        _fact("AAPL", "eps_diluted", 1.53, b, unit="USD/shares"),
        _fact("MSFT", "revenue", 7e6, c),                              # no text
        _fact(None, "revenue", 111184e6, b),                           # a NULL ticker is a key
    ], FACT_T)
    body = "Total net\nsales 111,184\nNet income rose to 15\nDiluted earnings per share 1.53"
    texts = spark.createDataFrame([("AAPL_10-Q_2026-04-30_000000000126000002.txt", body)], "file_name string, text string")
    flow = reconcile.reconcile_newest(facts, texts, reconcile.concept_keyword_list())
    got = {(r.ticker, r.concept): r for r in flow.collect()}
    assert {k: r.verdict for k, r in got.items()} == {
        ("AAPL", "revenue"): "verified", ("AAPL", "net_income"): "not_found", ("AAPL", "total_assets"): "no_occurrence",
        ("AAPL", "eps_diluted"): "verified", ("MSFT", "revenue"): "no_text", (None, "revenue"): "verified"}
    r = got[("AAPL", "revenue")]
    assert (r.shown, r.matched_scale, r.n_snippets) == ("$111,184,000,000", 1e6, 2) and "111,184" in r.evidence
    gold = {g.id: g for g in reconcile.golden_records(flow.where("ticker is not null"), "2026-05-01").collect()}
    assert set(gold) == {"AAPL-2026Q2-revenue", "AAPL-2026Q2-eps_diluted"}
    g = gold["AAPL-2026Q2-revenue"]
    assert (g.expected_value, g.verified_by, g.verified_date, g.cik) == (111184e6, "manual_reconciliation", "2026-05-01", None)


def test_reconcile_newest_empty_tables(spark):
    facts = spark.createDataFrame([], FACT_T)
    texts = spark.createDataFrame([], "file_name string, text string")
    assert reconcile.reconcile_newest(facts, texts, reconcile.concept_keyword_list()).collect() == []


def test_chunk_report(spark):
    good = "AAPL_10-Q_2026-04-30_0000000001260000{:02d}"
    texts = spark.createDataFrame([
        (good.format(1), "word " * 600), (good.format(2), "  "), (good.format(3), None), ("notes", "word"), (None, "word"),
        (good.format(4), "Item 1. Risk\n" + "a " * 50 + "\nItem 2. Legal\n" + "b " * 50)], "stem string, text string")
    report = metadata.chunk_report(texts)
    got = {r.file: (r.status, r.error, r.n_sections, r.n_chunks) for r in report.collect()}
    bad = ("failed", "file name not understood", None, None)
    assert got == {good.format(1): ("ok", None, 1, 2), good.format(2): ("empty", None, 1, 0),
                   good.format(3): ("failed", "no text", None, None), "notes": bad, None: bad,
                   good.format(4): ("ok", None, 2, 2)}
    total = {(r.status, r.error): r.n_files for r in metadata.summarize_chunk_report(report).collect()}
    assert total[("failed", "file name not understood")] == 2 and total[("ok", None)] == 2


def test_text_files_and_text_sink(spark, tmp_path):
    for name, raw in (("AAPL_a.txt", b"caf\xc3\xa9 \xff1"), ("MSFT_b.txt", b"two\nlines")):
        (tmp_path / name).write_bytes(raw)
    texts = filings.read_texts(spark, str(tmp_path))
    assert {r.stem: r.text for r in texts.collect()} == {"AAPL_a": "caf\u00e9 1", "MSFT_b": "two\nlines"}
    assert [r.file_name for r in filings.read_texts(spark, str(tmp_path), ticker="aapl").collect()] == ["AAPL_a.txt"]
    sinks.write_texts(texts, str(tmp_path / "out"))
    assert {r.file_name: r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {
        "AAPL_a.txt": "caf\u00e9 1", "MSFT_b.txt": "two\nlines"}


def test_table_cell_sink(spark, tmp_path):
    cells = spark.createDataFrame([("f", 0, 0, 0, "(5)", -5.0), ("f", 2, 0, 1, "x", None)],
                                  "file_name string, table_idx int, row_idx int, col_idx int, cell string, num double")
    sinks.write_table_cells(cells, str(tmp_path / "cells"))
    back = spark.read.parquet(str(tmp_path / "cells"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cells.collect()))


def test_golden_file_round_trip(spark, tmp_path):
    rows = [("k2", "MSFT", 2.0, None, 1, 0), ("k1", "AAPL", 1.0, "n", 0, 3), ("k0", "AAPL", 3.0, "", 0, 1)]
    recs = spark.createDataFrame(rows, "id string, ticker string, expected_value double, notes string, load_seq int, pos long")
    out = str(tmp_path / "golden")
    filings.write_golden_file(recs, out)
    text = "".join(open(f"{out}/{f}").read() for f in sorted(os.listdir(out)) if f.startswith("part"))
    doc = json.loads(text)
    assert set(doc) == {"_readme", "records"} and [r["id"] for r in doc["records"]] == ["k0", "k1", "k2"]
    assert doc["records"][2]["notes"] is None
    back = filings.read_golden(spark, out).orderBy("pos").collect()
    assert [(r.pos, r.id, r.expected_value) for r in back] == [(0, "k0", 3.0), (1, "k1", 1.0), (2, "k2", 2.0)]
    filings.write_golden(recs, str(tmp_path / "lines"))
    lines = filings.read_golden(spark, str(tmp_path / "lines"), lines=True).orderBy("load_seq", "pos").collect()
    assert [r.id for r in lines] == ["k0", "k1", "k2"]


def test_tidy_order(spark):
    rows = [("b", "2026-01-01", "x"), ("a", None, "x"), ("a", "2026-01-01", None), ("a", "2026-01-01", "w"), ("a", "2025-01-01", "z")]
    got = [tuple(r) for r in lookup.order_tidy(spark.createDataFrame(rows, "concept string, end string, filed_date string")).collect()]
    assert got == [("a", "2025-01-01", "z"), ("a", "2026-01-01", "w"), ("a", "2026-01-01", None), ("a", None, "x"),
                   ("b", "2026-01-01", "x")]
