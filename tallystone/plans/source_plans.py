"""Source, identifier and file-format bindings.

Inputs in the filing formats (directory JSON, submissions, company facts,
fact CSVs, file names) are produced by Spark from the driver tables, then
read back through the library's readers, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone.functions import ids
from tallystone.functions.text import HTML_HIDDEN, HTML_TAG, WS
from tallystone.operators import facts as facts_ops
from tallystone.operators import dom, tables
from tallystone.plans.registry import register, table
from tallystone.plans.text_plans import HTML_TEXT_SQL, WS_SQL, _sql_str, entities_sql
from tallystone.session import shared_dir
from tallystone.sources import filings, sinks


def _ticker(col):
    """Letters-only ticker made from a numeric key (0 -> A ... 9 -> J)."""
    return F.translate(col.cast("string"), "0123456789", "ABCDEFGHIJ")


_TICKER_SQL = "translate({}::VARCHAR, '0123456789', 'ABCDEFGHIJ')"
_FORM_SQL = "CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '10-Q' ELSE '8-K' END"


def _form(status):
    return F.when(status == "F", "10-K").when(status == "O", "10-Q").otherwise("8-K")


# --- company_directory: one directory JSON object per customer, parsed back.
def _directory_json(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    entry = F.struct(F.col("c_custkey").alias("cik_str"), _ticker(F.col("c_custkey")).alias("ticker"),
                     F.col("c_name").alias("title"))
    return c.select(F.to_json(F.create_map(F.col("c_custkey").cast("string"), entry)).alias("value"),
                    "c_mktsegment")


@register("company_directory", sql=f"""
SELECT c_custkey AS ord, c_custkey AS cik_str, {_TICKER_SQL.format('c_custkey')} AS ticker,
       c_name AS title FROM customer
""")
def q_company_directory(spark, sf_dir):
    return filings.parse_directory(_directory_json(spark, sf_dir))


# --- ticker_to_cik: every order asks for its customer's ticker (lower case);
# the directory lists the customers outside the HOUSEHOLD segment, so some
# requests are not found.
@register("ticker_to_cik", sql=f"""
WITH d AS (SELECT c_custkey, upper({_TICKER_SQL.format('c_custkey')}) AS t, c_name FROM customer
           WHERE c_mktsegment <> 'HOUSEHOLD'),
dd AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY t ORDER BY c_custkey) = 1)
SELECT o.o_orderkey AS ord, upper(lower({_TICKER_SQL.format('o.o_custkey')})) AS ticker,
       CASE WHEN dd.c_custkey IS NULL THEN NULL
            WHEN length(dd.c_custkey::VARCHAR) < 10 THEN lpad(dd.c_custkey::VARCHAR, 10, '0')
            ELSE dd.c_custkey::VARCHAR END AS cik,
       dd.c_name AS company_name,
       CASE WHEN dd.c_custkey IS NULL THEN 'not_found' ELSE 'ok' END AS status
FROM orders o LEFT JOIN dd ON dd.t = upper({_TICKER_SQL.format('o.o_custkey')})
""")
def q_ticker_to_cik(spark, sf_dir):
    d = filings.parse_directory(_directory_json(spark, sf_dir).filter(F.col("c_mktsegment") != "HOUSEHOLD"))
    o = table(spark, sf_dir, "orders")
    req = o.select(F.col("o_orderkey").alias("ord"), F.lower(_ticker(F.col("o_custkey"))).alias("ticker"))
    return filings.resolve_tickers(d, req)


# --- recent_filings: one submissions document per order (a paged index);
# forms 10-K (status F) and 10-Q (status O) kept, newest 3 per company.
def _accession(o):
    return F.concat(F.lpad(o["o_custkey"].cast("string"), 10, "0"), F.lit("-"),
                    F.date_format("o_orderdate", "yy"), F.lit("-"),
                    F.lpad(o["o_orderkey"].cast("string"), 6, "0"))


_ACCN_SQL = ("lpad(o_custkey::VARCHAR, 10, '0') || '-' || strftime(o_orderdate, '%y') || '-' || "
             "lpad(o_orderkey::VARCHAR, 6, '0')")


@register("recent_filings", sql=f"""
WITH f AS (
  SELECT lpad(o_custkey::VARCHAR, 10, '0') AS cik, o_custkey, o_orderkey, o_orderdate,
         {_FORM_SQL} AS form, {_ACCN_SQL} AS accession_number,
         strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS filing_date,
         strftime(o_orderdate, '%Y-%m-%d') AS report_date,
         'doc' || o_orderkey || '.htm' AS primary_document, o_orderpriority AS primary_doc_description
  FROM orders),
r AS (SELECT *, (row_number() OVER (PARTITION BY cik ORDER BY o_orderdate DESC, o_orderkey) - 1)::INT AS pos
      FROM f WHERE form IN ('10-K', '10-Q') QUALIFY pos < 3)
SELECT {_TICKER_SQL.format('c.c_custkey')} AS ticker, c.c_name AS company_name, r.cik, r.form,
       r.filing_date, r.report_date, r.accession_number,
       replace(r.accession_number, '-', '') AS accession_no_dashes, r.primary_document,
       r.primary_doc_description,
       'https://www.sec.gov/Archives/edgar/data/' || r.cik::BIGINT || '/' || replace(r.accession_number, '-', '') AS archive_base,
       'https://www.sec.gov/Archives/edgar/data/' || r.cik::BIGINT || '/' || replace(r.accession_number, '-', '') || '/' || r.primary_document AS primary_document_url,
       'https://www.sec.gov/Archives/edgar/data/' || r.cik::BIGINT || '/' || replace(r.accession_number, '-', '') || '/' || r.accession_number || '.txt' AS complete_submission_text_url,
       'https://www.sec.gov/Archives/edgar/data/' || r.cik::BIGINT || '/' || r.accession_number || '-index.html' AS filing_detail_page_url,
       r.pos
FROM r LEFT JOIN customer c ON c.c_custkey = r.o_custkey
""")
def q_recent_filings(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    recent = F.struct(*[F.array(c).alias(n) for n, c in [
        ("form", _form(F.col("o_orderstatus"))), ("accessionNumber", _accession(o)),
        ("filingDate", F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd")),
        ("reportDate", F.date_format("o_orderdate", "yyyy-MM-dd")),
        ("primaryDocument", F.concat(F.lit("doc"), F.col("o_orderkey").cast("string"), F.lit(".htm"))),
        ("primaryDocDescription", F.col("o_orderpriority"))]])
    doc = F.to_json(F.struct(F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"),
                             F.struct(recent.alias("recent")).alias("filings")))
    subs = o.select(doc.alias("value"),
                    F.struct((-F.unix_date(F.to_date("o_orderdate"))).alias("d"),
                             F.col("o_orderkey").alias("k")).alias("doc_seq"))
    parsed = subs.select(F.from_json("value", filings.SUBMISSIONS).alias("s"), "doc_seq") \
        .select("s.*", "doc_seq")
    recent_rows = filings.recent_filings(parsed, limit=3, doc_seq_col="doc_seq").drop("doc_seq")
    c = table(spark, sf_dir, "customer")
    companies = c.select(F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("cik"),
                         _ticker(F.col("c_custkey")).alias("ticker"), F.col("c_name").alias("company_name"))
    return filings.filing_records(recent_rows, companies)


_ROWS_T = ("array<struct<start:string,end:string,val:double,accn:string,fy:int,fp:string,"
           "form:string,filed:string,frame:string>>")


# --- facts_from_json: one company-facts document per order (its priority is
# the tag), parsed back with the explicit schema and flattened.
def _facts_docs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    end = F.to_date("o_orderdate")
    row = F.struct(F.date_format(F.date_sub(end, 90), "yyyy-MM-dd").alias("start"),
                   F.date_format(end, "yyyy-MM-dd").alias("end"), F.col("o_totalprice").alias("val"),
                   _accession(o).alias("accn"), F.year(end).alias("fy"),
                   F.concat(F.lit("Q"), F.quarter(end).cast("string")).alias("fp"),
                   _form(F.col("o_orderstatus")).alias("form"),
                   F.date_format(F.date_add(end, 30), "yyyy-MM-dd").alias("filed"),
                   F.concat(F.lit("CY"), F.year(end).cast("string"), F.lit("Q"),
                            F.quarter(end).cast("string")).alias("frame"))
    unit = F.when(F.col("o_orderstatus") == "P", "EUR").otherwise("USD")
    entry = F.struct(F.col("o_orderpriority").alias("label"),
                     F.create_map(unit, F.array(row)).alias("units"))
    empty = F.struct(F.lit("Empty").alias("label"),
                     F.create_map(F.lit("USD"), F.array().cast(_ROWS_T)).alias("units"))
    doc = F.struct(F.col("o_custkey").alias("cik"), F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("entityName"),
                   F.create_map(F.lit("us-gaap"), F.create_map(F.col("o_orderpriority"), entry,
                                                               F.lit("EmptyTag"), empty)).alias("facts"))
    return o.select(F.to_json(doc).alias("value"))


_FACT_COLS_SQL = f"""
  o_custkey AS cik, 'Company ' || o_custkey AS entityName,
  strftime(o_orderdate::DATE - INTERVAL 90 DAY, '%Y-%m-%d') AS "start",
  strftime(o_orderdate, '%Y-%m-%d') AS "end", o_totalprice AS val, {_ACCN_SQL} AS accn,
  year(o_orderdate)::INT AS fy, 'Q' || quarter(o_orderdate) AS fp, {_FORM_SQL} AS form,
  strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS filed,
  'CY' || year(o_orderdate) || 'Q' || quarter(o_orderdate) AS frame,
  CASE WHEN o_orderstatus = 'P' THEN 'EUR' ELSE 'USD' END AS unit"""


@register("facts_from_json", sql=f"""
SELECT cik, entityName, 'us-gaap' AS taxonomy, o_orderpriority AS tag, unit, 0 AS row_ord,
       "start", "end", val, accn, fy, fp, form, filed, frame
FROM (SELECT o_orderpriority, {_FACT_COLS_SQL} FROM orders)
""")
def q_facts_from_json(spark, sf_dir):
    return filings.flatten_company_facts(filings.parse_company_facts(_facts_docs(spark, sf_dir)))


# --- tidy_facts: in-row tag fallback on the same documents. Candidates:
# EmptyTag (an empty USD list: skipped, never falls to another unit), then
# 1-URGENT, 2-HIGH; status-P documents carry EUR (the first unit).
TIDY_TAGS = {"c": ["EmptyTag", "1-URGENT", "2-HIGH"]}


@register("tidy_facts", sql=f"""
SELECT cik, entityName, 'c' AS concept, o_orderpriority AS tag_used, val AS value, unit,
       "start", "end", fy AS fiscal_year, fp AS fiscal_period, form, filed AS filed_date,
       accn AS accession_number, frame, 0 AS row_ord
FROM (SELECT o_orderpriority, {_FACT_COLS_SQL} FROM orders)
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def q_tidy_facts(spark, sf_dir):
    docs = filings.parse_company_facts(_facts_docs(spark, sf_dir))
    return facts_ops.tag_fallback_doc(docs, TIDY_TAGS)


# --- load_facts / load_report: tidy facts of every order land as CSV, one
# unit (ticker) per market segment, each with an identity sidecar except the
# HOUSEHOLD unit, which therefore fails without stopping the others.
def _seg_ticker(seg):
    return F.upper(F.substring(seg, 1, 4))


def _land_fact_files(spark, sf_dir):
    base = shared_dir(spark, "landed-facts")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    end = F.to_date("o_orderdate")
    tidy = o.join(c, "o_custkey").select(
        _seg_ticker(F.col("c_mktsegment")).alias("ticker"),
        F.col("o_orderpriority").alias("concept"), F.lit("Tag").alias("tag_used"),
        F.col("o_totalprice").alias("value"), F.lit("USD").alias("unit"),
        F.date_format(F.date_sub(end, 90), "yyyy-MM-dd").alias("start"),
        F.date_format(end, "yyyy-MM-dd").alias("end"), F.year(end).cast("double").alias("fiscal_year"),
        F.concat(F.lit("Q"), F.quarter(end).cast("string")).alias("fiscal_period"),
        _form(F.col("o_orderstatus")).alias("form"),
        F.date_format(F.date_add(end, 30), "yyyy-MM-dd").alias("filed_date"),
        _accession(o).alias("accession_number"), F.lit(None).cast("string").alias("frame"))
    side = (c.filter(F.col("c_mktsegment") != "HOUSEHOLD").groupBy("c_mktsegment")
            .agg(F.min("o_custkey").alias("cik"))
            .select(_seg_ticker(F.col("c_mktsegment")).alias("ticker"), "cik",
                    F.col("c_mktsegment").alias("entityName")))
    sinks.write_fact_files(tidy, side, base)
    return filings.load_fact_csvs(spark, f"{base}/csv", f"{base}/sidecars", layout="partitioned")


_LANDED_SQL = f"""
seg AS (SELECT c_custkey, c_mktsegment, upper(substring(c_mktsegment, 1, 4)) AS ticker FROM customer),
side AS (SELECT ticker, min(c_custkey) AS cik, any_value(c_mktsegment) AS entityName
         FROM seg WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY ticker),
rows AS (SELECT seg.ticker, o.* FROM orders o JOIN seg ON seg.c_custkey = o.o_custkey)"""


@register("load_facts", sql=f"""
WITH {_LANDED_SQL}
SELECT lpad(side.cik::VARCHAR, 10, '0') AS cik, rows.ticker, side.entityName AS company_name,
       o_orderpriority AS concept, 'Tag' AS tag_used, o_totalprice AS value, 'USD' AS unit,
       (o_orderdate::DATE - INTERVAL 90 DAY)::DATE AS period_start, o_orderdate::DATE AS period_end,
       year(o_orderdate)::INT AS fiscal_year, 'Q' || quarter(o_orderdate) AS fiscal_period,
       {_FORM_SQL} AS form, (o_orderdate + INTERVAL 30 DAY)::DATE AS filed_date,
       {_ACCN_SQL} AS accession_number, 0 AS load_seq
FROM rows JOIN side USING (ticker)
""")
def q_load_facts(spark, sf_dir):
    loaded, _ = _land_fact_files(spark, sf_dir)
    return loaded.drop("row_block", "row_ord", "file_name")


@register("load_report", sql=f"""
WITH {_LANDED_SQL}
SELECT rows.ticker, count(*)::BIGINT AS n_rows,
       CASE WHEN any_value(side.cik) IS NULL THEN 'failed' ELSE 'loaded' END AS status,
       CASE WHEN any_value(side.cik) IS NULL THEN 'no identity sidecar for ' || rows.ticker END AS error
FROM rows LEFT JOIN side USING (ticker) GROUP BY rows.ticker
""")
def q_load_report(spark, sf_dir):
    _, report = _land_fact_files(spark, sf_dir)
    return report


# --- parse_filename: file stems built from orders; status P gives an 8-K
# (rejected), urgent open orders carry the "/A" amendment marker.
_STEM_SQL = (f"{_TICKER_SQL.format('o_custkey')} || '_' || {_FORM_SQL} || "
             "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN '/A' ELSE '' END || '_' || "
             "strftime(o_orderdate, '%Y-%m-%d') || '_' || lpad(o_orderkey::VARCHAR, 18, '0')")
_FN_RE = "'^([A-Z]+)_(10-[KQ](?:/A)?)_([0-9]{4}-[0-9]{2}-[0-9]{2})_([0-9]+)$'"


@register("parse_filename", sql=f"""
WITH s AS (SELECT o_orderkey, {_STEM_SQL} AS stem FROM orders)
SELECT o_orderkey, stem,
       CASE WHEN regexp_matches(stem, {_FN_RE}) THEN regexp_extract(stem, {_FN_RE}, 1) END AS ticker,
       CASE WHEN regexp_matches(stem, {_FN_RE}) THEN regexp_extract(stem, {_FN_RE}, 2) END AS form,
       CASE WHEN regexp_matches(stem, {_FN_RE}) THEN regexp_extract(stem, {_FN_RE}, 3) END AS filing_date,
       CASE WHEN regexp_matches(stem, {_FN_RE}) THEN
         substring(regexp_extract(stem, {_FN_RE}, 4), 1, 10) || '-' ||
         substring(regexp_extract(stem, {_FN_RE}, 4), 11, 2) || '-' ||
         substring(regexp_extract(stem, {_FN_RE}, 4), 13, 6) END AS accession_number,
       regexp_matches(stem, {_FN_RE}) AS valid
FROM s
""")
def q_parse_filename(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    amend = F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"), "/A") \
        .otherwise("")
    stem = F.concat(_ticker(F.col("o_custkey")), F.lit("_"), _form(F.col("o_orderstatus")), amend,
                    F.lit("_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_"),
                    F.lpad(F.col("o_orderkey").cast("string"), 18, "0"))
    s = o.select("o_orderkey", stem.alias("stem"))
    return s.select("o_orderkey", "stem", *[c.alias(k) for k, c in ids.parse_filename_cols(F.col("stem")).items()])


# --- normalize_ids: CIK-like strings in several shapes from customer keys,
# and 18-digit accession numbers re-dashed.
_RAW_CIK_SQL = ("CASE c_mktsegment WHEN 'BUILDING' THEN 'CIK' || c_custkey "
                "WHEN 'MACHINERY' THEN ' cik' || c_custkey || ' ' "
                "WHEN 'AUTOMOBILE' THEN (c_custkey * 10000000)::VARCHAR ELSE c_custkey::VARCHAR END")


@register("normalize_ids", sql=f"""
WITH r AS (SELECT c_custkey, {_RAW_CIK_SQL} AS cik_raw, lpad(c_custkey::VARCHAR, 18, '0') AS nd FROM customer),
s AS (SELECT *, regexp_replace(replace(upper(cik_raw), 'CIK', ''), '^[{WS}]+|[{WS}]+$', '', 'g') AS s FROM r)
SELECT c_custkey, cik_raw,
       CASE WHEN length(s) < 10 THEN lpad(s, 10, '0') ELSE s END AS cik,
       substring(nd, 1, 10) || '-' || substring(nd, 11, 2) || '-' || substring(nd, 13, 6) AS accession_number,
       nd AS accession_nodash
FROM s
""")
def q_normalize_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    seg, key = F.col("c_mktsegment"), F.col("c_custkey")
    raw = (F.when(seg == "BUILDING", F.concat(F.lit("CIK"), key.cast("string")))
           .when(seg == "MACHINERY", F.concat(F.lit(" cik"), key.cast("string"), F.lit(" ")))
           .when(seg == "AUTOMOBILE", (key * 10000000).cast("string"))
           .otherwise(key.cast("string")))
    r = c.select("c_custkey", raw.alias("cik_raw"), F.lpad(key.cast("string"), 18, "0").alias("nd"))
    dashed = ids.accession_dash(F.col("nd"))
    return r.select("c_custkey", "cik_raw", ids.normalize_cik(F.col("cik_raw")).alias("cik"),
                    dashed.alias("accession_number"),
                    ids.accession_undash(dashed).alias("accession_nodash"))


# --- html_tables / table_profile: the pages' lists become one-column
# tables (ul -> table, li -> row with one cell) after hidden subtrees and
# comments are removed; end tags of rows and cells are left out, so that the tree
# construction has to imply them.
def _list_tables(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    h = F.regexp_replace(F.col("html"), HTML_HIDDEN, "")
    h = F.regexp_replace(h, r"(?i)<ul\b", "<table")
    h = F.regexp_replace(h, r"(?i)</ul\s*>", "</table>")
    h = F.regexp_replace(h, r"(?i)<li\b([^>]*)>", "<tr><td$1>")
    h = F.regexp_replace(h, r"(?i)</li\s*>", "")
    return tables.html_tables(p.select("page_id", h.alias("html")))


_CELLS_SQL = f"""
l AS (SELECT page_id, unnest(l) AS l, generate_subscripts(l, 1) - 1 AS table_idx FROM (
        SELECT page_id, regexp_extract_all(regexp_replace(html, {_sql_str(HTML_HIDDEN)}, '', 'g'),
                                           '(?is)<ul\\b[^>]*>(.*?)</ul\\s*>', 1) AS l FROM pages)),
i AS (SELECT page_id, table_idx, unnest(i) AS i, generate_subscripts(i, 1) - 1 AS row_idx FROM (
        SELECT page_id, table_idx, regexp_extract_all(l, '(?is)<li\\b[^>]*>(.*?)</li\\s*>', 1) AS i FROM l)),
c AS (SELECT page_id, table_idx, row_idx, trim(regexp_replace({entities_sql(f"regexp_replace(i, {_sql_str(HTML_TAG)}, '', 'g')")},
                                                              {WS_SQL}, ' ', 'g')) AS c FROM i),
cells AS (SELECT page_id, table_idx::INT AS table_idx, row_idx::INT AS row_idx, 0 AS col_idx,
                 CASE WHEN regexp_full_match(c, '-?[0-9]{{1,3}}(,[0-9]{{3}})+([.][0-9]+)?') THEN replace(c, ',', '') ELSE c END AS cell,
                 trim(regexp_replace(c, '[$,%]', '', 'g')) AS t FROM c),
nums AS (SELECT * EXCLUDE (t), CASE WHEN regexp_full_match(n, '-?[0-9]+([.][0-9]+)?')
                                   THEN n::DOUBLE * CASE WHEN starts_with(t, '(') THEN -1 ELSE 1 END END AS num
         FROM (SELECT *, trim(regexp_replace(t, '^[()]+|[()]+$', '', 'g')) AS n FROM cells))"""


@register("html_tables", sql=f"WITH {_CELLS_SQL} SELECT * EXCLUDE (n) FROM nums")
def q_html_tables(spark, sf_dir):
    return _list_tables(spark, sf_dir)


@register("table_profile", sql=f"""
WITH {_CELLS_SQL}
SELECT page_id, table_idx, (max(row_idx) + 1)::INT AS n_rows, (max(col_idx) + 1)::INT AS n_cols, count(*) AS n_cells,
       count(num) AS n_numeric, string_agg(cell, chr(10) ORDER BY row_idx, col_idx) FILTER (row_idx < 10) AS preview
FROM nums GROUP BY page_id, table_idx
""")
def q_table_profile(spark, sf_dir):
    profile = tables.table_profile(_list_tables(spark, sf_dir))
    return profile.withColumn("preview", F.array_join(F.transform("preview", lambda x: x["cell"]), "\n"))


# --- html_outline / html_tree_text: the pages' trees; elements by tag, and the
# same text as html_to_text, read from the nodes.
@register("html_outline", sql=f"""
SELECT page_id, lower(t) AS tag, count(*) AS n_elements
FROM (SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, {_sql_str(HTML_HIDDEN)}, '', 'g'),
                                                '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS t FROM pages)
GROUP BY ALL
""")
def q_html_outline(spark, sf_dir):
    nodes = dom.html_nodes(table(spark, sf_dir, "pages"))
    return (nodes.where("tag IS NOT NULL AND NOT hidden AND NOT again")
            .groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n_elements")))


@register("html_tree_text", sql=HTML_TEXT_SQL)
def q_html_tree_text(spark, sf_dir):
    return dom.nodes_text(dom.html_nodes(table(spark, sf_dir, "pages")))


# --- fact_store_rows: the numeric flow end to end on the same documents:
# tag fallback, derived rows, store columns; tickers from the customer
# directory. No document holds both ratio concepts, so no derived rows arise.
@register("fact_store_rows", sql=f"""
SELECT lpad(o_custkey::VARCHAR, 10, '0') AS cik, {_TICKER_SQL.format('o_custkey')} AS ticker,
       'Company ' || o_custkey AS company_name, 'c' AS concept, o_orderpriority AS tag_used,
       o_totalprice AS value, CASE WHEN o_orderstatus = 'P' THEN 'EUR' ELSE 'USD' END AS unit,
       (o_orderdate::DATE - INTERVAL 90 DAY)::DATE AS period_start, o_orderdate::DATE AS period_end,
       year(o_orderdate)::INT AS fiscal_year, 'Q' || quarter(o_orderdate) AS fiscal_period,
       {_FORM_SQL} AS form, (o_orderdate + INTERVAL 30 DAY)::DATE AS filed_date,
       {_ACCN_SQL} AS accession_number, 0 AS load_seq
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def q_fact_store_rows(spark, sf_dir):
    docs = filings.parse_company_facts(_facts_docs(spark, sf_dir))
    c = table(spark, sf_dir, "customer")
    tickers = c.select(F.col("c_custkey").alias("cik"), _ticker(F.col("c_custkey")).alias("ticker"))
    return facts_ops.facts_to_store(docs, tickers, TIDY_TAGS).drop("row_ord")
