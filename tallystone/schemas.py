"""Schemas of the filing data model and the fixed lookup tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results).
# Curated concepts and their candidate XBRL tags, in priority order.
# ---------------------------------------------------------------------------
CONCEPT_TAGS = {
    "revenue": [
        "RevenueFromContractWithCustomerExcludingAssessedTax",
        "Revenues",
        "SalesRevenueNet",
    ],
    "cost_of_revenue": ["CostOfGoodsAndServicesSold", "CostOfRevenue"],
    "gross_profit": ["GrossProfit"],
    "research_and_development_expense": ["ResearchAndDevelopmentExpense"],
    "operating_income": ["OperatingIncomeLoss"],
    "net_income": ["NetIncomeLoss"],
    "total_assets": ["Assets"],
    "total_liabilities": ["Liabilities"],
    "cash_and_equivalents": ["CashAndCashEquivalentsAtCarryingValue"],
    "eps_diluted": ["EarningsPerShareDiluted"],
}

# Filing-text keywords per concept, in search order.
CONCEPT_KEYWORDS = {
    "revenue": ["net sales", "total net sales", "net revenue", "total revenue"],
    "cost_of_revenue": ["cost of sales", "cost of revenue"],
    "gross_profit": ["gross margin", "gross profit"],
    "research_and_development_expense": ["research and development"],
    "operating_income": ["operating income"],
    "net_income": ["net income"],
    "total_assets": ["total assets"],
    "total_liabilities": ["total liabilities"],
    "cash_and_equivalents": ["cash and cash equivalents"],
    "eps_diluted": ["diluted earnings per share", "earnings per share"],
    "gross_margin_pct": ["gross margin"],
}

# Other constants of the reference.
TAXONOMY = "us-gaap"
PREFERRED_UNIT = "USD"
DERIVED_CONCEPT = "gross_margin_pct"
DERIVED_TAG = "derived:gross_profit/revenue"
DERIVED_UNIT = "percent"
DEFAULT_CHUNK_SIZE = 500
DEFAULT_CHUNK_OVERLAP = 50
DEFAULT_MIN_SECTION_TOKENS = 40
DEFAULT_TOP_K = 5
EMBEDDING_BATCH_SIZE = 100
PREAMBLE_TITLE = "Cover Page / Table of Contents"
FULL_DOCUMENT_TITLE = "Full Document"
SNIPPET_BEFORE = 20
SNIPPET_AFTER = 200
GOLDEN_VERIFIED_BY = "manual_reconciliation"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
FACT_ROW = T.StructType([
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
    T.StructField("val", T.DoubleType()),
    T.StructField("accn", T.StringType()),
    T.StructField("fy", T.IntegerType()),
    T.StructField("fp", T.StringType()),
    T.StructField("form", T.StringType()),
    T.StructField("filed", T.StringType()),
    T.StructField("frame", T.StringType()),
])

TAG_ENTRY = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("units", T.MapType(T.StringType(), T.ArrayType(FACT_ROW))),
])

COMPANY_FACTS = T.StructType([
    T.StructField("cik", T.LongType()),
    T.StructField("entityName", T.StringType()),
    T.StructField("facts", T.MapType(T.StringType(), T.MapType(T.StringType(), TAG_ENTRY))),
])

DIRECTORY_ENTRY = T.StructType([
    T.StructField("cik_str", T.LongType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("title", T.StringType()),
])
DIRECTORY = T.MapType(T.StringType(), DIRECTORY_ENTRY)

SUBMISSIONS = T.StructType([
    T.StructField("cik", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("filings", T.StructType([
        T.StructField("recent", T.StructType([
            T.StructField("form", T.ArrayType(T.StringType())),
            T.StructField("accessionNumber", T.ArrayType(T.StringType())),
            T.StructField("filingDate", T.ArrayType(T.StringType())),
            T.StructField("reportDate", T.ArrayType(T.StringType())),
            T.StructField("primaryDocument", T.ArrayType(T.StringType())),
            T.StructField("primaryDocDescription", T.ArrayType(T.StringType())),
        ])),
    ])),
])

TIDY_FACT = T.StructType([
    T.StructField("concept", T.StringType()),
    T.StructField("tag_used", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
    T.StructField("fiscal_year", T.IntegerType()),
    T.StructField("fiscal_period", T.StringType()),
    T.StructField("form", T.StringType()),
    T.StructField("filed_date", T.StringType()),
    T.StructField("accession_number", T.StringType()),
    T.StructField("frame", T.StringType()),
])

# CSV as the tidy table is written (fiscal_year read as DOUBLE: "2026.0").
FACT_CSV = T.StructType([
    f if f.name != "fiscal_year" else T.StructField("fiscal_year", T.DoubleType())
    for f in TIDY_FACT.fields
])

STORED_FACT = T.StructType([
    T.StructField("cik", T.StringType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("concept", T.StringType()),
    T.StructField("tag_used", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("period_start", T.DateType()),
    T.StructField("period_end", T.DateType()),
    T.StructField("fiscal_year", T.IntegerType()),
    T.StructField("fiscal_period", T.StringType()),
    T.StructField("form", T.StringType()),
    T.StructField("filed_date", T.DateType()),
    T.StructField("accession_number", T.StringType()),
])

GOLDEN_RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("cik", T.StringType()),
    T.StructField("concept", T.StringType()),
    T.StructField("tag_used", T.StringType()),
    T.StructField("expected_value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("period_end", T.StringType()),
    T.StructField("fiscal_year", T.IntegerType()),
    T.StructField("fiscal_period", T.StringType()),
    T.StructField("form", T.StringType()),
    T.StructField("accession_number", T.StringType()),
    T.StructField("source_snippet", T.StringType()),
    T.StructField("verified_by", T.StringType()),
    T.StructField("verified_date", T.StringType()),
    T.StructField("notes", T.StringType()),
])

GOLDEN_FILE = T.StructType([
    T.StructField("_readme", T.StringType()),
    T.StructField("records", T.ArrayType(GOLDEN_RECORD)),
])
