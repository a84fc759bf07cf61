"""Number mentions: the grammar, their readings, and the join with facts."""

import pytest
from pyspark.sql import functions as F

from tallystone.operators import mentions, reconcile, tables

M, B, K = 1e6, 1e9, 1e3
# text -> (number, unit, own scale, declared scale, negative) of each mention
CASES = [
    ("Item 7. See page 5 of this report", []),
    ("Item 1. Business, Note 3, Level 2, Part II, Form 10-K, Q2 and notes 4", []),
    ("May 1, 2026; 2026-05-01; 0000320193-26-000013; 5/1/2026; 1 June 2025; 1.2.3; x12; 12x; 1,2345", []),
    ("(in millions) Net sales 111,184 95,359", [(111184, None, None, M, False), (95359, None, None, M, False)]),
    ("$111.2 billion, up 16.6%", [(111.2, "USD", B, None, False), (16.6, "percent", None, None, False)]),
    ("(1,717) and $(5.2) and - 3.5 and (157,030\n)", [(1717, None, None, None, True), (5.2, "USD", None, None, True),
                                                     (3.5, None, None, None, True), (157030, None, None, None, True)]),
    ("5M 3.2bn 7 million 12 basis points", [(5, None, M, None, False), (3.2, None, B, None, False), (7, None, M, None, False),
                                            (12, "bps", None, None, False)]),
    ("$ 29,578 $ 24,780", [(29578, "USD", None, None, False), (24780, "USD", None, None, False)]),
    ("(In thousands, except per share) 5 (in millions) 6", [(5, None, None, K, False), (6, None, None, M, False)]),
    ("1,200-1,300 and (5 employees", [(1200, None, None, None, False), (1300, None, None, None, False), (5, None, None, None, False)]),
    ("€3.5 million £2 JPY 500 .5%", [(3.5, "EUR", M, None, False), (2, "GBP", None, None, False), (500, "JPY", None, None, False),
                                     (0.5, "percent", None, None, False)]),
    ("May 1,200 units", [(1200, None, None, None, False)]),
    ("", []), (None, []),
]


def test_grammar(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    got = {}
    for r in mentions.number_mentions(df).orderBy("doc_id", "mention_idx").collect():
        got.setdefault(r.doc_id, []).append((r.number, r.unit, r.scale, r.declared, r.negative))
    for i, (text, want) in enumerate(CASES):
        assert got.get(i, []) == want, text


@pytest.mark.parametrize("value, text, scale", [
    (1e9, "Item 1. Business", None), (5e6, "see page 5 of this report", None), (2024e6, "in 2024 we", None), (2024.0, "in 2024", None),
    (5.0, "see 5 of them", 1.0), (5.0, "see note 5", None), (5.0, "$5 each", 1.0), (1.53, "earnings of 1.53", 1.0),
    (111184e6, "Total net sales 111,184 95,359", M), (111184e6, "Total net sales 111,185", None), (111184e6, "2,111,184", None),
    (5e6, "(in millions) 5", M), (5e6, "net 5", None), (5e6, "(in thousands) 5", None), (5e6, "5,000,000", 1.0),
    (5e6, "5,000", None), (5.2e6, "about 5.2 million", M), (5.24e6, "about 5.2 million", M), (5.26e6, "about 5.2 million", None),
    (-1717e6, "(1,717)", M), (-1717e6, "1,717", None), (1717e6, "dividends (1,717)", M), (1717e6, "- 1,717", None),
    (16.6, "up 16.6%", 1.0), (16.6e6, "(in millions) up 16.6%", None), (0.0, "0 and 0.0", None), (None, "5,000", None),
    (5e6, None, None)])
def test_readings_of_one_value(spark, value, text, scale):
    r = reconcile.reconcile_auto(spark.createDataFrame([(value, text)], "value double, text string")).first()
    assert (r.matched_scale, r.verified) == (scale, scale is not None)


def test_band_join_with_facts(spark):
    texts = spark.createDataFrame([("a", "(in millions) sales 111,184; loss (25); cash $1.2 billion; see page 9"),
                                   ("b", "sales 5,123 and 5,123"), (None, "sales 5,123")], "accession_number string, text string")
    rows = [("a", "x", 111184e6, "USD"), ("a", "y", 111185e6, "USD"), ("a", "z", -25.3e6, "USD"), ("a", "c", 1.24e9, "USD"),
            ("a", "c2", 1.24e9, "EUR"), ("a", "p", 9e6, None), ("b", "x", 5123e3, None), ("b", "x", 5123e3, None),
            ("b", "n", None, "USD"), ("b", "0", 0.0, "USD"), (None, "x", 5123.0, "USD"), ("none", "x", 5123.0, "USD")]
    facts = spark.createDataFrame(rows, "accession_number string, concept string, value double, unit string")
    said = mentions.number_mentions(texts, id_cols=("accession_number",))
    got = mentions.reconcile_mentions(facts, said, unit_col="unit")
    assert got.columns == [*facts.columns, "n_agreeing", "matched_scale", "evidence", "matched_raw", "verified"]
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert len(found) == len(rows)
    verified = [(r[0], r[1], r[4], r[5], r[6], r[7]) for r in found if r[8]]
    assert verified == [("a", "c", 1, B, "stated", "$1.2 billion"), ("a", "x", 1, M, "declared", "111,184"),
                        ("a", "z", 1, M, "declared", "(25)"), ("b", "x", 2, K, "implied", "5,123"),
                        ("b", "x", 2, K, "implied", "5,123")]


def test_every_reading_meets_its_bucket(spark):
    """The join finds what comparing all pairs finds."""
    texts = spark.range(200).select(F.lit("k").alias("accession_number"), F.concat_ws(
        " ", F.format_number((F.col("id") * 7919) % 100_003 / 10, 1), F.lit("million")).alias("text"))
    texts = texts.unionByName(spark.createDataFrame([("k", "(in billions) 1 2 9 0.5 (in thousands) 1 3")], texts.schema))
    said = mentions.number_mentions(texts, id_cols=("accession_number",))
    facts = spark.range(3000).select(F.lit("k").alias("accession_number"), (F.pow(F.lit(1.011), F.col("id")) * 700).alias("value"))
    got = {r.value: r.verified for r in mentions.reconcile_mentions(facts, said).collect()}
    m = F.struct("number", "decimals", "significant", "unit", "scale", "declared", "year")
    bands = [(r.low, r.high) for r in said.select(F.explode(mentions.readings(m)).alias("r")).select("r.*").collect()]
    assert got == {v: any(a <= v <= b for a, b in bands) for v in got} and 10 < sum(got.values()) < 2990


def test_cell_mentions_take_the_tables_scale(spark):
    html = ("<table><tr><td>(In millions)<td>2026<tr><td>Net income<td>$<td>29,578<tr><td>Other<td>(157,030<td>)</table>"
            "<table><tr><td>Rate<td>2.00%<td>12</table>")
    cells = tables.html_tables(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string"))
    got = sorted((r.table_idx, r.row_idx, r.number, r.declared, r.negative) for r in mentions.cell_mentions(cells).collect())
    assert got == [(0, 0, 2026.0, M, False), (0, 1, 29578.0, M, False), (0, 2, 157030.0, M, True),
                   (1, 0, 2.0, None, False), (1, 0, 12.0, None, False)]
    facts = spark.createDataFrame([(1, 29578e6), (1, 2026e6), (1, -157030e6), (1, 157029e6)], "page_id long, value double")
    said = mentions.cell_mentions(cells)
    assert [r.verified for r in mentions.reconcile_mentions(facts, said, ("page_id",)).orderBy("value").collect()] == [True, False, True, False]


def test_numbers_cut_by_a_snippet_are_no_evidence(spark):
    texts = spark.createDataFrame([("T_10-K_2026-01-01_000000000000000001.txt", "Net income " + "x" * 189 + " 295,780,123")],
                                  "file_name string, text string")
    facts = spark.createDataFrame([("T", "net_income", v, "USD", "0000000000-00-000001") for v in (295e6,)],
                                  "ticker string, concept string, value double, unit string, accession_number string")
    facts = facts.select("*", *[F.lit(None).cast("date").alias(c) for c in ("period_start", "period_end", "filed_date")])
    got = reconcile.reconcile_newest(facts, texts, [("net_income", 0, "Net income")]).collect()
    assert [r.verdict for r in got] == ["not_found"]
