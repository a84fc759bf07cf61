"""Identifier normalisation and filing URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystone.functions.text import WS

# Archive host and file-name conventions.
SEC_BASE = "https://www.sec.gov"
FILENAME_STRICT = r"^([A-Z]+)_(10-[KQ](?:/A)?)_([0-9]{4}-[0-9]{2}-[0-9]{2})_([0-9]+)$"
# Tickers with dots/dashes/digits and an amendment marker usable in a path.
FILENAME_EXTENDED = r"^([A-Z0-9.\-]+)_(10-[KQ](?:_?A|/A)?)_([0-9]{4}-[0-9]{2}-[0-9]{2})_([0-9]+)$"


def normalize_cik(c: Column) -> Column:
    """Upper-case, drop 'CIK', strip, zero-fill to 10 (longer input kept)."""
    s = F.regexp_replace(F.regexp_replace(F.upper(c.cast("string")), "CIK", ""),
                         f"^[{WS}]+|[{WS}]+$", "")
    return F.when(F.length(s) < 10, F.lpad(s, 10, "0")).otherwise(s)


def cik_unpadded(c: Column) -> Column:
    return c.cast("bigint").cast("string")


def accession_undash(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def accession_dash(nodash: Column) -> Column:
    """10-2-6 slices joined by dashes, exactly as string slicing would."""
    return F.concat_ws("-", F.substring(nodash, 1, 10), F.substring(nodash, 11, 2),
                       F.substring(nodash, 13, 6))


def filing_urls(cik: Column, accession: Column, primary_document: Column) -> dict[str, Column]:
    """Archive folder, primary document, full submission text, detail page."""
    unpadded = cik_unpadded(cik)
    nodash = accession_undash(accession)
    base = F.concat_ws("/", F.lit(SEC_BASE + "/Archives/edgar/data"), unpadded, nodash)
    return {
        "archive_base": base,
        "primary_document_url": F.concat_ws("/", base, primary_document),
        "complete_submission_text_url": F.concat(base, F.lit("/"), accession, F.lit(".txt")),
        "filing_detail_page_url": F.concat(F.lit(SEC_BASE + "/Archives/edgar/data/"), unpadded,
                                           F.lit("/"), accession, F.lit("-index.html")),
    }


def parse_filename_cols(stem: Column, strict: bool = True) -> dict[str, Column]:
    """ticker/form/filing_date/accession_number from a file stem; ``valid``."""
    pat = FILENAME_STRICT if strict else FILENAME_EXTENDED
    ok = stem.rlike(pat)

    def g(i: int) -> Column:
        return F.when(ok, F.regexp_extract(stem, pat, i))

    return {
        "ticker": g(1),
        "form": g(2),
        "filing_date": g(3),
        "accession_number": F.when(ok, accession_dash(F.regexp_extract(stem, pat, 4))),
        "valid": ok,
    }


def golden_record_id(ticker: Column, fiscal_year: Column, fiscal_period: Column,
                     concept: Column) -> Column:
    """``{TICKER}-{year}{period}-{concept}`` (P16); the ticker is upper-cased
    first so ids compare the way the stored ticker is written."""
    return F.concat(F.upper(ticker), F.lit("-"), fiscal_year.cast("string"), fiscal_period,
                    F.lit("-"), concept)
