"""Filing metadata for chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_metadata(chunks: DataFrame, facts: DataFrame, ticker_col: str = "ticker",
                   accn_col: str = "accession_number",
                   company_cols: Sequence[str] = ("cik", "company_name"),
                   filing_cols: Sequence[str] = ("fiscal_year", "fiscal_period")) -> DataFrame:
    """Attach company and filing attributes to each chunk row.

    Exact (ticker, accession) match -> company and filing attributes of that
    filing; else any fact of the ticker -> company attributes with NULL
    filing attributes; else all NULL. ``match`` says which. "Any row" is made
    deterministic: the greatest (filing..., company...) tuple, NULLs lowest,
    so a derived row with NULL year never hides a real one (T8).
    The fact side is pre-aggregated to one row per key before each left
    join, so a chunk never meets more than one partner.
    """
    fc, cc = list(filing_cols), list(company_cols)
    exact = (facts.groupBy(ticker_col, accn_col)
             .agg(F.max(F.struct(*fc, *cc)).alias("_e"), F.max(F.struct(*cc)).alias("_c")))
    by_ticker = exact.groupBy(ticker_col).agg(F.max("_c").alias("_t"))
    j = (chunks.join(exact.drop("_c"), [ticker_col, accn_col], "left")
         .join(by_ticker, ticker_col, "left"))
    has_e, has_t = F.col("_e").isNotNull(), F.col("_t").isNotNull()
    out = j
    for c in cc:
        out = out.withColumn(c, F.when(has_e, F.col("_e." + c)).when(has_t, F.col("_t." + c)))
    for c in fc:
        out = out.withColumn(c, F.when(has_e, F.col("_e." + c)))
    out = out.withColumn("match", F.when(has_e, "exact").when(has_t, "ticker").otherwise("none"))
    return out.drop("_e", "_t")


CHUNK_COLS = ["cik", "ticker", "company_name", "form", "fiscal_year", "fiscal_period",
              "accession_number", "section", "chunk_index", "chunk_text"]


def filing_chunks(texts: DataFrame, facts: DataFrame, stem_col: str = "stem",
                  text_col: str = "text", strict_names: bool = True, size: int = 500,
                  overlap: int = 50, min_tokens: int = 40, embed_dim: int | None = None) -> DataFrame:
    """Filing texts -> rows of the chunk table (the narrative flow).

    Identity from the file stem (files whose name does not parse are left
    out; ``parse_filename_cols`` reports them), filing metadata from the fact
    store (exact filing, else company) for the distinct identities, joined to
    the file rows before the cut, so that chunks are never shuffled; then chunks
    per filing, and vectors when ``embed_dim`` is given.
    """
    from tallystone.functions.ids import parse_filename_cols
    from tallystone.operators.chunks import build_chunks
    from tallystone.operators.vectors import embed_chunks

    ident = parse_filename_cols(F.col(stem_col), strict=strict_names)
    named = (texts.select(*[c.alias(k) for k, c in ident.items()], F.col(text_col).alias("_text"))
             .filter(F.col("valid")))
    key = ["ticker", "accession_number"]
    meta = chunk_metadata(named.select(*key).distinct(), facts, company_cols=("cik", "company_name"),
                          filing_cols=("fiscal_year", "fiscal_period"))
    filed = named.join(meta, key, "left")
    ids = [c for c in CHUNK_COLS if c not in ("section", "chunk_index", "chunk_text")]
    out = build_chunks(filed, "_text", ids, size, overlap, min_tokens).select(*CHUNK_COLS)
    if embed_dim:
        out = embed_chunks(out, dim=embed_dim)
    return out


def chunk_report(texts: DataFrame, stem_col: str = "stem", text_col: str = "text",
                 strict_names: bool = True, size: int = 500, overlap: int = 50,
                 min_tokens: int = 40) -> DataFrame:
    """Outcome of the narrative flow for every file: ``file, status, error,
    n_sections, n_chunks``.

    ``status`` is ``ok``, ``empty`` (a text without words) or ``failed`` (name
    not understood, no text); a failed file has NULL counts and stops no other.
    Narrow: sections and windows are counted inside the file's row.
    """
    from tallystone.functions.ids import parse_filename_cols
    from tallystone.operators.chunks import token_count, window_count, with_sections

    df = texts.select(F.col(stem_col).alias("file"), F.col(text_col).alias("_text"),
                      parse_filename_cols(F.col(stem_col), strict=strict_names)["valid"].alias("_valid"))
    df = with_sections(df, "_text", "_secs", min_tokens)
    error = (F.when(~F.coalesce("_valid", F.lit(False)), "file name not understood")
             .when(F.col("_text").isNull(), "no text"))
    n_chunks = F.aggregate("_secs", F.lit(0), lambda n, s: n + window_count(token_count(s["text"]), size, size - overlap))
    df = df.select("file", error.alias("error"), F.size("_secs").alias("_s"), n_chunks.alias("_c"))
    good = F.col("error").isNull()
    return df.select("file", F.when(~good, "failed").when(F.col("_c") == 0, "empty").otherwise("ok").alias("status"),
                     "error", F.when(good, F.col("_s")).alias("n_sections"), F.when(good, F.col("_c")).alias("n_chunks"))


def summarize_chunk_report(report: DataFrame) -> DataFrame:
    """Files, sections and chunks by status and error."""
    return report.groupBy("status", "error").agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("n_sections"), F.lit(0)).alias("n_sections"),
        F.coalesce(F.sum("n_chunks"), F.lit(0)).alias("n_chunks"))
