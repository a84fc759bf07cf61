"""Narrative-half bindings: HTML to text, sections, merge, windows, chunks.

``conversations`` stand in for filings: each conversation is assembled into
one document row (a table of contents of its turn headers, then every turn
under an "Item {turn}. {role}" header), which gives the header split real
repeated headers, keep-last semantics and a preamble to work on.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone.functions.text import (HTML_HIDDEN, HTML_TAG, LB, SECTION_HEADER, SP,
                                       WS, WS_RUN)
from tallystone.operators import chunks
from tallystone.operators.html import html_to_text
from tallystone.plans.registry import ORACLE, register, table

MERGE_MIN_WORDS = 120


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# DuckDB versions of the shared pieces -------------------------------------
HDR_SQL = _sql_str(SECTION_HEADER)
WS_SQL = _sql_str(WS_RUN)
STRIP_SQL = _sql_str(f"^[{WS}]+|[{WS}]+$")


def _tokens_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {WS_SQL}), lambda t: t <> '')"


def _norm_sql(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, {WS_SQL}, ' ', 'g')))"


def entities_sql(x: str) -> str:
    """Decoding of the references that the pages use: legacy names with or without
    ";" (HTML5), and &amp last so that one pass never decodes twice."""
    x = f"replace({x}, '&#39;', '\'\'')"
    for name, char in [("quot", "'\"'"), ("copy", "'©'"), ("middot", "'·'"), ("lt", "'<'"), ("gt", "'>'"),
                       ("nbsp", "chr(160)"), ("amp", "'&'")]:
        x = f"regexp_replace({x}, '&{name};?', {char}, 'g')"
    return x


# --- html_to_text: pages -----------------------------------------------------
HTML_TEXT_SQL = f"""
WITH s0 AS (
  SELECT page_id,
    regexp_replace(regexp_replace(html, {_sql_str(HTML_HIDDEN)}, chr(10), 'g'),
       {_sql_str(HTML_TAG)}, chr(10), 'g') AS s
  FROM pages),
s1 AS (
  -- the references the pages use; legacy names decode with or without ";"
  -- (HTML5), and &amp is last so that one pass never decodes twice
  SELECT page_id, {entities_sql('s')} AS s
  FROM s0),
s2 AS (
  SELECT page_id, regexp_replace(regexp_replace(s, {_sql_str(f"\r\n|[{LB}]")}, chr(10), 'g'),
                                 {_sql_str(f"[{SP}]+")}, ' ', 'g') AS s FROM s1)
SELECT page_id,
  regexp_replace(regexp_replace(s, ' *' || chr(10) || '[ ' || chr(10) || ']*', chr(10), 'g'),
                 '^[ ' || chr(10) || ']+|[ ' || chr(10) || ']+$', '', 'g') AS text
FROM s2
"""


@register("html_to_text", sql=HTML_TEXT_SQL)
def q_html_to_text(spark, sf_dir):
    return html_to_text(table(spark, sf_dir, "pages"))


# --- token_windows: documents, 500 words with 50 overlap ---------------------
TOKEN_WINDOWS_SQL = f"""
WITH t AS (SELECT doc_id, {_tokens_sql('text')} AS toks FROM documents),
w AS (SELECT doc_id, toks,
        CASE WHEN len(toks) = 0 THEN 0
             ELSE greatest(0, ceil((len(toks) - 500) / 450.0))::BIGINT + 1 END AS nwin
      FROM t),
i AS (SELECT doc_id, toks, unnest(range(nwin)) AS window_index FROM w)
SELECT doc_id, window_index::INT AS window_index, (window_index * 450)::INT AS token_start,
       len(toks[window_index * 450 + 1 : window_index * 450 + 500])::INT AS n_tokens,
       array_to_string(toks[window_index * 450 + 1 : window_index * 450 + 500], ' ') AS chunk_text
FROM i
"""


@register("token_windows", sql=TOKEN_WINDOWS_SQL)
def q_token_windows(spark, sf_dir):
    return chunks.token_windows(table(spark, sf_dir, "documents"), size=500, overlap=50)


# --- conversations as filing documents ----------------------------------------
def conversation_docs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    g = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "text"))).alias("t"))
    head = lambda x: F.concat(F.lit("Item "), x["turn"].cast("string"), F.lit(". "), x["role"])
    toc = F.array_join(F.transform("t", head), "\n")
    body = F.array_join(F.transform("t", lambda x: F.concat(head(x), F.lit("\n"), x["text"])), "\n")
    return g.select("conv_id", F.concat(toc, F.lit("\n"), body).alias("text"))


CONV_DOCS_SQL = """
conv_docs AS (
  SELECT conv_id,
    string_agg('Item ' || turn || '. ' || role, chr(10) ORDER BY turn) || chr(10) ||
    string_agg('Item ' || turn || '. ' || role || chr(10) || text, chr(10) ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id)"""

# Raw (unmerged) sections: mark headers, split, keep the last of each
# normalised title, number sections by a running count of kept headers.
RAW_SECTIONS_SQL = f"""
marked AS (
  SELECT conv_id, text,
         string_split(regexp_replace(text, {HDR_SQL}, chr(1) || '\\1', 'g'), chr(1)) AS segs
  FROM conv_docs),
u AS (SELECT conv_id, segs, unnest(segs) AS seg, generate_subscripts(segs, 1) AS pos FROM marked),
h AS (SELECT *, regexp_extract(seg, '^' || {HDR_SQL}, 1) AS head FROM u WHERE pos > 1),
k AS (SELECT *, {_norm_sql('head')} AS norm FROM h),
k2 AS (SELECT *, pos = max(pos) OVER (PARTITION BY conv_id, norm) AS keep FROM k),
k3 AS (SELECT *, sum(keep::INT) OVER (PARTITION BY conv_id ORDER BY pos) AS sid FROM k2),
body AS (
  SELECT conv_id, sid, string_agg(seg, '' ORDER BY pos) AS section_text,
         regexp_replace(max(CASE WHEN keep THEN head END), {STRIP_SQL}, '', 'g') AS title
  FROM k3 GROUP BY conv_id, sid),
pre AS (
  SELECT m.conv_id, m.segs[1] || coalesce(b.section_text, '') AS section_text
  FROM marked m LEFT JOIN body b ON b.conv_id = m.conv_id AND b.sid = 0),
raw AS (
  SELECT conv_id, 0 AS ord, 'Cover Page / Table of Contents' AS title, section_text
  FROM pre WHERE length(section_text) > 0
  UNION ALL
  SELECT conv_id, sid AS ord, title, section_text FROM body WHERE sid > 0
  UNION ALL
  SELECT conv_id, 0, 'Full Document', text FROM marked WHERE len(segs) = 1)"""


def _merge_sql(src: str, min_tokens: int) -> str:
    """Fold of (conv_id, idx 1..n, title, section_text) as a recursive CTE."""
    comb = "CASE WHEN r.bx <> '' THEN r.bx || chr(10) || s.section_text ELSE s.section_text END"
    small = f"len({_tokens_sql(comb)}) < {min_tokens}"
    return f"""
ms AS (SELECT conv_id, idx, title, section_text FROM {src}),
rec AS (
  SELECT conv_id, 0 AS idx, NULL::VARCHAR AS bt, '' AS bx, false AS emit,
         NULL::VARCHAR AS et, NULL::VARCHAR AS ex
  FROM (SELECT DISTINCT conv_id FROM ms)
  UNION ALL
  SELECT s.conv_id, s.idx,
         CASE WHEN {small} THEN coalesce(r.bt, s.title) END,
         CASE WHEN {small} THEN {comb} ELSE '' END,
         NOT ({small}),
         CASE WHEN NOT ({small}) THEN coalesce(r.bt, s.title) END,
         CASE WHEN NOT ({small}) THEN {comb} END
  FROM rec r JOIN ms s ON s.conv_id = r.conv_id AND s.idx = r.idx + 1),
last_state AS (
  SELECT conv_id, bt, bx FROM rec
  QUALIFY idx = max(idx) OVER (PARTITION BY conv_id)),
emitted AS (
  SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY idx) - 1)::INT AS section_idx,
         et AS title, ex AS section_text,
         idx = max(idx) OVER (PARTITION BY conv_id) AS is_last
  FROM rec WHERE emit),
merged AS (
  SELECT e.conv_id, e.section_idx, e.title,
         CASE WHEN e.is_last AND l.bx <> '' THEN e.section_text || chr(10) || l.bx
              ELSE e.section_text END AS section_text
  FROM emitted e JOIN last_state l USING (conv_id)
  UNION ALL
  SELECT l.conv_id, 0, l.bt, l.bx FROM last_state l
  WHERE l.bx <> '' AND NOT EXISTS (SELECT 1 FROM emitted e WHERE e.conv_id = l.conv_id))"""


SPLIT_SECTIONS_SQL = f"""
WITH RECURSIVE {CONV_DOCS_SQL}, {RAW_SECTIONS_SQL},
numbered AS (
  SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY ord) )::INT AS idx,
         title, section_text FROM raw),
{_merge_sql('numbered', 40)},
nohdr AS (SELECT conv_id FROM marked WHERE len(segs) = 1)
SELECT conv_id, section_idx, title, section_text FROM merged
WHERE conv_id NOT IN (SELECT conv_id FROM nohdr)
UNION ALL
SELECT conv_id, 0, 'Full Document', text FROM marked WHERE len(segs) = 1
"""


@register("split_sections", sql=SPLIT_SECTIONS_SQL)
def q_split_sections(spark, sf_dir):
    return chunks.split_sections(conversation_docs(spark, sf_dir), id_cols=("conv_id",))


# --- merge_sections: every turn is a section titled "{role} {turn}",
# merged below 120 words.
MERGE_SECTIONS_SQL = f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn))::INT AS idx,
         role || ' ' || turn AS title, text AS section_text
  FROM conversations),
{_merge_sql('turns', MERGE_MIN_WORDS)}
SELECT conv_id, section_idx, title, section_text FROM merged
"""


@register("merge_sections", sql=MERGE_SECTIONS_SQL)
def q_merge_sections(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    secs = c.select("conv_id", F.col("turn").alias("section_idx"),
                    F.concat_ws(" ", "role", F.col("turn").cast("string")).alias("title"),
                    F.col("text").alias("section_text"))
    return chunks.merge_sections(secs, id_cols=("conv_id",), min_tokens=MERGE_MIN_WORDS)


# --- build_chunks: conversation documents -> sections -> 500/50 windows ----
BUILD_CHUNKS_SQL = f"""
WITH RECURSIVE {CONV_DOCS_SQL}, {RAW_SECTIONS_SQL},
numbered AS (
  SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY ord))::INT AS idx,
         title, section_text FROM raw),
{_merge_sql('numbered', 40)},
secs AS (
  SELECT conv_id, section_idx, title, section_text FROM merged
  WHERE conv_id NOT IN (SELECT conv_id FROM marked WHERE len(segs) = 1)
  UNION ALL
  SELECT conv_id, 0, 'Full Document', text FROM marked WHERE len(segs) = 1),
t AS (SELECT conv_id, section_idx, title, {_tokens_sql('section_text')} AS toks FROM secs),
w AS (SELECT *, CASE WHEN len(toks) = 0 THEN 0
                     ELSE greatest(0, ceil((len(toks) - 500) / 450.0))::BIGINT + 1 END AS nwin FROM t),
i AS (SELECT conv_id, section_idx, title, toks, unnest(range(nwin)) AS wi FROM w)
SELECT conv_id,
       (row_number() OVER (PARTITION BY conv_id ORDER BY section_idx, wi) - 1)::INT AS chunk_index,
       title AS section,
       array_to_string(toks[wi * 450 + 1 : wi * 450 + 500], ' ') AS chunk_text,
       len(toks[wi * 450 + 1 : wi * 450 + 500])::INT AS n_tokens
FROM i
"""


@register("build_chunks", sql=BUILD_CHUNKS_SQL)
def q_build_chunks(spark, sf_dir):
    return chunks.build_chunks(conversation_docs(spark, sf_dir), id_cols=("conv_id",))


# --- split_sections_docs / build_chunks_docs: every document becomes a
# filing-shaped text in its own row (no grouping): a table of contents of
# "Item {k}. Part {first word of paragraph k}" headers, then every paragraph
# under its header. The contents lines are earlier mentions of the same
# headers, so keep-last moves them into the preamble, and short paragraphs
# are merged below 40 words.
def filing_shaped_docs(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.split("text", "\n", -1)
    heads = F.transform(lines, lambda ln, i: F.concat(
        F.lit("Item "), (i + 1).cast("string"), F.lit(". Part "), F.split(ln, " ", -1)[0]))
    d = d.withColumn("_heads", heads).withColumn("_lines", lines)
    body = F.array_join(F.zip_with("_heads", "_lines", lambda h, ln: F.concat(h, F.lit("\n"), ln)), "\n")
    return d.select("doc_id", F.concat(F.array_join("_heads", "\n"), F.lit("\n"), body).alias("text"))


FILING_DOCS_SQL = """
conv_docs AS (
  SELECT doc_id AS conv_id,
         array_to_string(h, chr(10)) || chr(10) ||
         array_to_string(list_transform(h, lambda x, i: x || chr(10) || ls[i]), chr(10)) AS text
  FROM (SELECT doc_id, ls,
               list_transform(ls, lambda l, i: 'Item ' || i || '. Part ' || split_part(l, ' ', 1)) AS h
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))"""


@register("split_sections_docs", sql=f"""
WITH RECURSIVE {FILING_DOCS_SQL}, {RAW_SECTIONS_SQL},
numbered AS (
  SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY ord))::INT AS idx,
         title, section_text FROM raw),
{_merge_sql('numbered', 40)}
SELECT conv_id AS doc_id, section_idx, title, section_text FROM merged
WHERE conv_id NOT IN (SELECT conv_id FROM marked WHERE len(segs) = 1)
UNION ALL
SELECT conv_id, 0, 'Full Document', text FROM marked WHERE len(segs) = 1
""")
def q_split_sections_docs(spark, sf_dir):
    return chunks.split_sections(filing_shaped_docs(spark, sf_dir))


@register("build_chunks_docs", sql=BUILD_CHUNKS_SQL.replace(
    f"WITH RECURSIVE {CONV_DOCS_SQL}", f"WITH RECURSIVE {FILING_DOCS_SQL}").replace(
    "SELECT conv_id,\n       (row_number()", "SELECT conv_id AS doc_id,\n       (row_number()"))
def q_build_chunks_docs(spark, sf_dir):
    return chunks.build_chunks(filing_shaped_docs(spark, sf_dir))


# --- chunk_report: the same filing-shaped documents as files, one in seven with
# a name that does not parse; sections and chunks of every file that does.
@register("chunk_report", sql=f"""
WITH s AS (SELECT doc_id, count(*)::INT AS n FROM ({ORACLE["split_sections_docs"]}) GROUP BY doc_id),
c AS (SELECT doc_id, count(*)::INT AS n FROM ({ORACLE["build_chunks_docs"]}) GROUP BY doc_id),
f AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'draft_' ELSE 'ABC_10-K_2026-01-01_' END
             || lpad(doc_id::VARCHAR, 18, '0') AS file,
             CASE WHEN doc_id % 7 = 0 THEN 'file name not understood' WHEN text IS NULL THEN 'no text' END AS error
      FROM documents)
SELECT file, CASE WHEN error IS NOT NULL THEN 'failed' WHEN c.n IS NULL THEN 'empty' ELSE 'ok' END AS status, error,
       CASE WHEN error IS NULL THEN coalesce(s.n, 0) END AS n_sections,
       CASE WHEN error IS NULL THEN coalesce(c.n, 0) END AS n_chunks
FROM f LEFT JOIN s USING (doc_id) LEFT JOIN c USING (doc_id)
""")
def q_chunk_report(spark, sf_dir):
    from tallystone.operators.metadata import chunk_report
    name = F.when(F.col("doc_id") % 7 == 0, "draft_").otherwise("ABC_10-K_2026-01-01_")
    d = filing_shaped_docs(spark, sf_dir)
    return chunk_report(d.select(F.concat(name, F.lpad(F.col("doc_id").cast("string"), 18, "0")).alias("stem"), "text"))
