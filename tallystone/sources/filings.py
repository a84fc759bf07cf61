"""Sources S1-S10: directory, filing index, facts JSON/CSV, HTML, text, golden.

All readers take explicit schemas (no inference) and return lazy
DataFrames. Whole-file readers (``wholetext``) treat one file as one row:
the natural unit of a filing document.
"""

from __future__ import annotations

import csv
import io
import itertools
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.functions.ids import filing_urls, normalize_cik
from tallystone.schemas import (COMPANY_FACTS, DIRECTORY, FACT_CSV, GOLDEN_FILE, GOLDEN_RECORD,
                                SUBMISSIONS)


def read_whole_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file_name, file_path, modified, value): one row per file."""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    # ``text()`` applies its own keyword defaults, so wholetext goes here
    return r.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"),
                               F.col("_metadata.file_path").alias("file_path"),
                               F.col("_metadata.file_modification_time").alias("modified"),
                               "value")


# --- S1 / J4: company directory --------------------------------------------
def parse_directory(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Directory JSON objects (ordinal -> {cik_str, ticker, title}) to rows.

    ``ord`` keeps document order (the ordinal key), so "first match" is
    defined without relying on file order.
    """
    m = F.from_json(F.col(json_col), DIRECTORY)
    return (df.select(F.explode(m).alias("k", "e"))
            .select(F.col("k").cast("long").alias("ord"), "e.cik_str", "e.ticker", "e.title"))


def read_company_directory(spark: SparkSession, path: str) -> DataFrame:
    return parse_directory(read_whole_files(spark, path))


def resolve_tickers(directory: DataFrame, requests: DataFrame, ticker_col: str = "ticker",
                    ord_col: str = "ord") -> DataFrame:
    """Ticker -> zero-padded CIK for each request.

    Case-insensitive equality; the first directory entry (lowest ordinal)
    wins. Unknown tickers stay, with ``status = 'not_found'``: the report
    the reference raises as an error, without stopping the other requests.
    """
    d = (directory.withColumn("_t", F.upper("ticker"))
         .groupBy("_t").agg(F.min(F.struct("ord", "cik_str", "title")).alias("_d")))
    r = requests.withColumn("_t", F.upper(F.col(ticker_col)))
    j = r.join(d, "_t", "left")
    return (j.select(ord_col, F.col("_t").alias("ticker"),
                     normalize_cik(F.col("_d.cik_str")).alias("cik"),
                     F.col("_d.title").alias("company_name"),
                     F.when(F.col("_d").isNull(), "not_found").otherwise("ok").alias("status")))


# --- S2 / O4 / P4 / J5: filing index -----------------------------------------
FILING_FIELDS = ["form", "accessionNumber", "filingDate", "reportDate", "primaryDocument",
                 "primaryDocDescription"]


def recent_filings(subs: DataFrame, forms: Sequence[str] = ("10-K", "10-Q"), limit: int = 5,
                   cik_col: str = "cik", doc_seq_col: str | None = None) -> DataFrame:
    """First ``limit`` filings of the wanted forms, in document order.

    ``subs`` holds parsed submission documents (``filings.recent`` parallel
    arrays). One document per company: pure in-row work (zip, filter,
    slice, explode). Several documents per company (paged indexes) with
    ``doc_seq_col`` giving their order: ``row_number() <= limit`` per
    company, reduced per task before the shuffle.
    """
    if limit < 1:
        raise ValueError("limit must be >= 1")
    rec = F.col("filings.recent")
    zipped = F.arrays_zip(*[rec.getField(f).alias(f) for f in FILING_FIELDS])
    wanted = F.filter(zipped, lambda x: x["form"].isin(list(forms)))
    keep = [cik_col] + ([doc_seq_col] if doc_seq_col else [])
    if doc_seq_col is None:
        rows = subs.select(*keep, F.posexplode_outer(F.slice(wanted, 1, limit)).alias("pos", "f"))
    else:
        rows = subs.select(*keep, F.posexplode_outer(wanted).alias("pos", "f"))
    rows = rows.filter(F.col("f").isNotNull())
    if doc_seq_col is not None:
        w = Window.partitionBy(cik_col).orderBy(doc_seq_col, "pos")
        rows = rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit) \
            .withColumn("pos", F.col("_rn") - 1).drop("_rn")
    return rows.select(
        cik_col, "pos", F.col("f.form").alias("form"), F.col("f.filingDate").alias("filing_date"),
        F.col("f.reportDate").alias("report_date"),
        F.col("f.accessionNumber").alias("accession_number"),
        F.replace(F.col("f.accessionNumber"), F.lit("-"), F.lit("")).alias("accession_no_dashes"),
        F.col("f.primaryDocument").alias("primary_document"),
        F.col("f.primaryDocDescription").alias("primary_doc_description"))


def filing_records(filings: DataFrame, companies: DataFrame, cik_col: str = "cik") -> DataFrame:
    """Attach ticker/company name and the four archive URLs.

    ``companies`` is one row per CIK (the directory), joined on the CIK.
    """
    j = filings.join(companies.select(cik_col, "ticker", "company_name"), cik_col, "left")
    urls = filing_urls(F.col(cik_col), F.col("accession_number"), F.col("primary_document"))
    return j.select("ticker", "company_name", cik_col, "form", "filing_date", "report_date",
                    "accession_number", "accession_no_dashes", "primary_document",
                    "primary_doc_description", *[u.alias(k) for k, u in urls.items()], "pos")


def parse_submissions(df: DataFrame, json_col: str = "value") -> DataFrame:
    return df.select(F.from_json(F.col(json_col), SUBMISSIONS).alias("s")).select("s.*")


# --- S3: company facts ---------------------------------------------------------
def parse_company_facts(df: DataFrame, json_col: str = "value") -> DataFrame:
    return df.select(F.from_json(F.col(json_col), COMPANY_FACTS).alias("d")).select("d.*")


def read_company_facts(spark: SparkSession, path: str, glob: str = "*_companyfacts_raw.json") -> DataFrame:
    files = read_whole_files(spark, path, glob)
    return files.select("file_name", F.from_json("value", COMPANY_FACTS).alias("d")) \
        .select("file_name", "d.*")


def flatten_company_facts(docs: DataFrame, keep: Sequence[str] = ("cik", "entityName")) -> DataFrame:
    """Every reported row of every taxonomy/tag/unit, with its list position."""
    t = docs.select(*keep, F.explode_outer("facts").alias("taxonomy", "tags")).filter(F.col("tags").isNotNull())
    g = t.select(*keep, "taxonomy", F.explode_outer("tags").alias("tag", "entry")).filter(F.col("entry").isNotNull())
    u = g.select(*keep, "taxonomy", "tag", F.explode_outer("entry.units").alias("unit", "rows")) \
        .filter(F.col("rows").isNotNull())
    r = u.select(*keep, "taxonomy", "tag", "unit", F.posexplode_outer("rows").alias("row_ord", "r")) \
        .filter(F.col("r").isNotNull())
    return r.select(*keep, "taxonomy", "tag", "unit", "row_ord", "r.*")


# --- S4 / S5 / S11 / P9 / A9: fact CSVs with identity sidecars ----------------
SIDECAR = T.StructType([T.StructField("cik", T.LongType()),
                        T.StructField("entityName", T.StringType())])


def stored_fact_rows(tidy: DataFrame) -> DataFrame:
    """Tidy CSV columns -> the store's columns (rename, NULLs, types)."""
    def num(c: str) -> Column:
        return F.when(~F.isnan(F.col(c)), F.col(c))

    return tidy.select(
        "cik", "ticker", "company_name", "concept", "tag_used", num("value").alias("value"), "unit",
        F.try_to_date(F.col("start")).alias("period_start"),
        F.try_to_date(F.col("end")).alias("period_end"),
        num("fiscal_year").cast("int").alias("fiscal_year"), "fiscal_period", "form",
        F.try_to_date(F.col("filed_date")).alias("filed_date"), "accession_number",
        *[c for c in ("load_seq", "row_block", "row_ord", "file_name") if c in tidy.columns])


def load_fact_csvs(spark: SparkSession, csv_dir: str, sidecar_dir: str,
                   csv_glob: str = "*_xbrl_facts.csv",
                   sidecar_glob: str = "*_companyfacts_raw.json",
                   load_seq: int = 0, layout: str = "files") -> tuple[DataFrame, DataFrame]:
    """Load fact CSVs with their identity sidecars; returns ``(facts, report)``.

    ``layout="files"``: ``{ticker}_xbrl_facts.csv`` next to
    ``{ticker}_companyfacts_raw.json`` (the reference's layout; ticker from
    the file name). ``layout="partitioned"``: folders ``ticker=T/`` as Spark
    writes them. CIK and company name come from the sidecar (name falls back
    to the ticker). A unit without a sidecar is not loaded and is reported
    ``failed``; a unit without rows is ``empty``; one bad unit never stops
    the others. The report has one row per unit (ticker).
    """
    if layout not in ("files", "partitioned"):
        raise ValueError("layout must be 'files' or 'partitioned'")
    csv_reader = spark.read.schema(FACT_CSV).option("header", "true")
    side_reader = spark.read.schema(SIDECAR)
    # file listing only: binaryFile prunes the unread ``content`` column
    text_reader = spark.read.format("binaryFile")
    if layout == "files":
        csv_reader = csv_reader.option("pathGlobFilter", csv_glob).option("recursiveFileLookup", "true")
        side_reader = side_reader.option("multiLine", "true").option("pathGlobFilter", sidecar_glob) \
            .option("recursiveFileLookup", "true")
        text_reader = text_reader.option("pathGlobFilter", csv_glob).option("recursiveFileLookup", "true")

        def ticker_of(pattern: str) -> Column:
            return F.upper(F.regexp_extract(F.col("_metadata.file_name"), pattern, 1))
        csv_t, side_t = ticker_of(r"^(.*)_xbrl_facts\.csv$"), ticker_of(r"^(.*)_companyfacts_raw\.json$")
    else:
        csv_t = side_t = F.upper(F.col("ticker").cast("string"))
    # a company's rows are in one file (or folder): block and number inside it are their position
    facts = (csv_reader.csv(csv_dir).withColumn("file_name", F.col("_metadata.file_name")).withColumn("ticker", csv_t)
             .withColumn("row_block", F.col("_metadata.file_block_start"))
             .withColumn("row_ord", F.monotonically_increasing_id()))
    side = side_reader.json(sidecar_dir).select(side_t.alias("ticker"), normalize_cik(F.col("cik")).alias("cik"),
                                                F.col("entityName"))
    side = side.groupBy("ticker").agg(F.min(F.struct("cik", "entityName")).alias("_s")) \
        .select("ticker", "_s.cik", "_s.entityName")
    loaded = (facts.join(side, "ticker", "inner")
              .withColumn("company_name", F.coalesce("entityName", "ticker"))
              .withColumn("load_seq", F.lit(load_seq)))
    if layout == "partitioned":
        text_reader = text_reader.option("pathGlobFilter", "*.csv")
    units = text_reader.load(csv_dir).select(csv_t.alias("ticker")).distinct()
    counts = facts.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"))
    n = F.coalesce("n_rows", F.lit(0)).cast("bigint")
    report = (units.join(counts, "ticker", "left").join(side.select("ticker", "cik"), "ticker", "left")
              .select("ticker", n.alias("n_rows"),
                      F.when(F.col("cik").isNull(), "failed").when(n == 0, "empty")
                      .otherwise("loaded").alias("status"),
                      F.when(F.col("cik").isNull(), F.concat(F.lit("no identity sidecar for "),
                                                            F.col("ticker"))).alias("error")))
    return stored_fact_rows(loaded), report


def summarize_outcomes(report: DataFrame, status_col: str = "status") -> DataFrame:
    """Batch outcome summary (A9): units and rows per status."""
    return report.groupBy(status_col).agg(F.count(F.lit(1)).alias("n_units"),
                                          F.sum("n_rows").alias("n_rows"))


# --- S6 / S7: HTML and text files ------------------------------------------------
def _drop_invalid(df: DataFrame, col: str) -> DataFrame:
    # a file's bytes are kept as they are; in one that is no UTF-8, what does not
    # decode becomes U+FFFD and goes, as for a reader that ignores decoding errors
    made = F.replace(F.make_valid_utf8(col), F.lit("\ufffd"), F.lit(""))
    return df.withColumn(col, F.when(F.is_valid_utf8(col), F.col(col)).otherwise(made))


def read_html(spark: SparkSession, path: str, ticker: str | None = None, newest_only: bool = False,
              drop_invalid: bool = True) -> DataFrame:
    """Filing HTML files (one row per file); ``ticker`` selects ``{T}_*.html``.

    ``newest_only`` keeps the most recently modified file. Files are UTF-8;
    with ``drop_invalid`` bytes that do not decode are dropped.
    """
    glob = f"{ticker.upper()}_*.html" if ticker else "*.html"
    df = read_whole_files(spark, path, glob).withColumnRenamed("value", "html")
    if drop_invalid:
        df = _drop_invalid(df, "html")
    if newest_only:
        df = df.orderBy(F.col("modified").desc(), F.col("file_name").desc()).limit(1)
    return df.withColumn("stem", F.regexp_extract("file_name", r"^(.*)\.html?$", 1))


def read_texts(spark: SparkSession, path: str, ticker: str | None = None,
               drop_invalid: bool = True) -> DataFrame:
    """Filing text files (one row per file) with their stem."""
    glob = f"{ticker.upper()}_*.txt" if ticker else "*.txt"
    df = read_whole_files(spark, path, glob).withColumnRenamed("value", "text")
    if drop_invalid:
        df = _drop_invalid(df, "text")
    return df.withColumn("stem", F.regexp_extract("file_name", r"^(.*)\.txt$", 1))


# --- S9 / S14: golden file --------------------------------------------------------
def read_golden(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Golden records in file order (``pos``); a missing file gives no rows.

    ``lines=True`` reads the JSON-lines form written by ``write_golden``.
    """
    try:
        if lines:
            return spark.read.schema(T.StructType(GOLDEN_RECORD.fields + [
                T.StructField("load_seq", T.IntegerType()), T.StructField("pos", T.LongType())])).json(path)
        doc = spark.read.schema(GOLDEN_FILE).option("multiLine", "true").json(path)
        return doc.select(F.posexplode_outer("records").alias("pos", "r")) \
            .filter(F.col("r").isNotNull()).select("pos", "r.*")
    except Exception as e:  # noqa: BLE001 - only a missing path is tolerated
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], T.StructType([T.StructField("pos", T.IntegerType())]
                                                      + GOLDEN_RECORD.fields))


def write_golden(records: DataFrame, path: str) -> None:
    """Write golden records as JSON lines in (load_seq, pos) order.

    Spark writes the records in parallel; ``read_golden`` reads this form as
    well as the single-document file of the reference.
    """
    cols = [f.name for f in GOLDEN_RECORD.fields if f.name in records.columns]
    (records.orderBy("load_seq", "pos").select(*cols, "load_seq", "pos")
     .write.mode("overwrite").json(path))


GOLDEN_README = "Golden dataset of verified filing facts."


def write_golden_file(records: DataFrame, path: str, readme: str = GOLDEN_README) -> None:
    """Write the golden set as one ``{_readme, records}`` document, records in
    (load_seq, pos) order (S14).

    The format is a single JSON object, so one task writes it: for hand-verified
    sets. ``write_golden`` is the parallel form.
    """
    cols = [f.name for f in GOLDEN_RECORD.fields if f.name in records.columns]
    packed = records.agg(F.sort_array(F.collect_list(F.struct(
        "load_seq", "pos", F.struct(*cols).alias("r")))).alias("l"))
    doc = F.struct(F.lit(readme).alias("_readme"), F.transform("l", lambda x: x["r"]).alias("records"))
    (packed.select(F.to_json(doc, {"ignoreNullFields": "false"}).alias("value"))
     .coalesce(1).write.mode("overwrite").text(path))


# --- S10: watch list -----------------------------------------------------------------
def read_watch_list(spark: SparkSession, path: str) -> DataFrame:
    """One ticker per line: blank lines and lines starting with '#' dropped
    (tested before stripping, like the reference), then stripped, upper-cased."""
    lines = spark.read.text(path)
    return (lines.filter(~F.col("value").startswith("#"))
            .select(F.upper(F.trim("value")).alias("ticker"))
            .filter(F.col("ticker") != ""))


# --- S8: parsed-table CSV files --------------------------------------------------------
_CELLS = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("row_idx", T.IntegerType()),
                       T.StructField("col_idx", T.IntegerType()), T.StructField("cell", T.StringType())])


def read_table_csvs(spark: SparkSession, path: str, glob: str = "*.csv",
                    header: bool = True) -> DataFrame:
    """Ragged table CSVs as long cells: file_name, table_idx, row_idx, col_idx, cell, num.

    A file is read whole (rows keep their order and may have any number of
    cells; Spark's CSV reader wants one width) and parsed with quotes first, so commas,
    line ends and doubled quotes inside a quoted cell belong to it. The header line
    (column numbers) is skipped; a blank line is a row of one empty cell. ``table_idx``
    comes from a ``_table_N`` suffix of the file name (else 0); an empty file
    yields no cells and shows up as missing in the profile.
    """
    def cells(batches):
        csv.field_size_limit(2**31 - 1)
        for pdf in batches:
            rows = ((name, i, j, cell) for name, text in zip(pdf["file_name"], pdf["value"])
                    for i, line in enumerate(csv.reader(io.StringIO((text or "").rstrip("\r\n"), newline="")), -int(header))
                    if i >= 0 for j, cell in enumerate(line or [""]))
            while part := list(itertools.islice(rows, 20_000)):
                yield pd.DataFrame(part, columns=_CELLS.names)

    from tallystone.operators.tables import cell_number_expr
    found = read_whole_files(spark, path, glob).select("file_name", "value").mapInPandas(cells, _CELLS)
    tidx = F.regexp_extract("file_name", r"_table_(\d+)\.csv$", 1)
    return found.select("file_name", F.when(tidx != "", tidx.cast("int")).otherwise(0).alias("table_idx"),
                        "row_idx", "col_idx", "cell", cell_number_expr(F.col("cell")).alias("num"))
