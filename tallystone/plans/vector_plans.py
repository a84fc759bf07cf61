"""Vector and chunk-store bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone.operators import chunks, store, vector_index, vectors
from tallystone.operators.metadata import chunk_metadata
from tallystone.plans.registry import register, table
from tallystone.session import shared_dir

# --- vector_search: the queries are the per-label centroid vectors of the
# embeddings table; each is searched over all vectors, k = 5.
CENTROIDS_SQL = """
cent AS (
  SELECT label AS qid, list(m ORDER BY i) AS q
  FROM (SELECT label, i, avg(x::DOUBLE) AS m
        FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
              FROM embeddings)
        GROUP BY label, i)
  GROUP BY label)"""


def _search_sql(where: str) -> str:
    return f"""
WITH {CENTROIDS_SQL},
items AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v
          FROM embeddings WHERE embedding IS NOT NULL {where}),
d AS (SELECT cent.qid, items.vec_id, items.label,
             round(1 - list_inner_product(items.v, cent.q)
                   / (sqrt(list_inner_product(items.v, items.v)) * sqrt(list_inner_product(cent.q, cent.q))),
                   6) AS distance
      FROM cent, items
      WHERE list_inner_product(items.v, items.v) > 0)
SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY distance, vec_id)::INT AS rank,
       vec_id, label, distance
FROM d QUALIFY rank <= 5
"""


def _search(spark, sf_dir, any_of=None):
    e = table(spark, sf_dir, "embeddings")
    q = vectors.centroids(e, "label").withColumnRenamed("label", "qid")
    return vectors.vector_search(e, q, k=5, id_col="vec_id", payload=["label"],
                                 any_of=any_of)


@register("vector_search", sql=_search_sql(""))
def q_vector_search(spark, sf_dir):
    return _search(spark, sf_dir)


# Filtered variant: only items whose label is any of 1, 3, 5 may rank
# (the reference's "ticker = ANY(...)" filter).
@register("vector_search_filtered", sql=_search_sql("AND label IN (1, 3, 5)"))
def q_vector_search_filtered(spark, sf_dir):
    return _search(spark, sf_dir, any_of={"label": [1, 3, 5]})


# --- vector_search_like: the search form's other filters; items carry the name
# "Class <label>", and only those of label 1 or 11 whose name contains "CLASS 1" in any
# case may rank.
@register("vector_search_like", sql=_search_sql("AND label IN (1, 11) AND ('Class ' || label) ILIKE '%CLASS 1%'"))
def q_vector_search_like(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = vectors.centroids(e, "label").withColumnRenamed("label", "qid")
    named = e.withColumn("name", F.concat(F.lit("Class "), F.col("label")))
    return vectors.vector_search(named, q, k=5, id_col="vec_id", payload=["label"],
                                 any_of={"label": [1, 11]}, ilike={"name": "CLASS 1"})


# --- vector_index / vector_index_filtered: the same searches through the persisted
# index, which is built from the table first; exact, so the same rows.
def _index_search(spark, sf_dir, **filters):
    e = table(spark, sf_dir, "embeddings")
    q = vectors.centroids(e, "label").withColumnRenamed("label", "qid")
    path = shared_dir(spark, "vector-index")
    vector_index.build_index(e, path, id_col="vec_id", payload=["label"], lists=64)
    found = vector_index.search_index(vector_index.Index(spark, path), q, k=5, **filters)
    return found.select("qid", "rank", F.col("id").alias("vec_id"), "label", "distance")


@register("vector_index", sql=_search_sql(""))
def q_vector_index(spark, sf_dir):
    return _index_search(spark, sf_dir)


@register("vector_index_filtered", sql=_search_sql("AND label IN (1, 3, 5)"))
def q_vector_index_filtered(spark, sf_dir):
    return _index_search(spark, sf_dir, any_of={"label": [1, 3, 5]})


# --- embed_chunks: 500/50 windows of every document, hashed-TF vectors of
# width 64 (no SQL equivalent of the hash: rows-only check).
@register("embed_chunks")
def q_embed_chunks(spark, sf_dir):
    w = chunks.token_windows(table(spark, sf_dir, "documents"))
    return vectors.embed_chunks(w, dim=64).select("doc_id", "window_index", "embed_model",
                                                   "embedding")


# --- chunk_metadata: documents stand in for chunks (ticker = source,
# accession = doc_id); the "fact table" is labels joined to documents:
# company attribute = lang, filing attributes = quality, toxic.
@register("chunk_metadata", sql="""
WITH facts AS (
  SELECT d.source AS ticker, l.doc_id AS accn, d.lang, l.quality, l.toxic
  FROM labels l JOIN documents d USING (doc_id)),
exact AS (
  SELECT * FROM facts
  QUALIFY row_number() OVER (PARTITION BY ticker, accn
    ORDER BY quality DESC NULLS LAST, toxic DESC NULLS LAST, lang DESC NULLS LAST) = 1),
byt AS (SELECT ticker, max(lang) AS lang FROM facts GROUP BY ticker)
SELECT d.doc_id, d.source,
       CASE WHEN e.accn IS NOT NULL THEN e.lang WHEN t.ticker IS NOT NULL THEN t.lang END AS lang_meta,
       e.quality, e.toxic,
       CASE WHEN e.accn IS NOT NULL THEN 'exact' WHEN t.ticker IS NOT NULL THEN 'ticker'
            ELSE 'none' END AS match
FROM documents d
LEFT JOIN exact e ON e.ticker = d.source AND e.accn = d.doc_id
LEFT JOIN byt t ON t.ticker = d.source
""")
def q_chunk_metadata(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    facts = (lab.join(d.select("doc_id", "source", "lang"), "doc_id")
             .select(F.col("source").alias("ticker"), F.col("doc_id").alias("accn"),
                     F.col("lang").alias("lang_meta"), "quality", "toxic"))
    ch = d.select("doc_id", F.col("source").alias("ticker"), F.col("doc_id").alias("accn"))
    out = chunk_metadata(ch, facts, ticker_col="ticker", accn_col="accn",
                         company_cols=["lang_meta"], filing_cols=["quality", "toxic"])
    return out.select("doc_id", F.col("ticker").alias("source"), "lang_meta", "quality",
                      "toxic", "match")


# --- upsert_chunks: load 1 = 500/50 windows of every document; load 2 =
# 800/100 windows (fewer, longer chunks) of the English documents. The
# newest load of a document replaces all of its chunks.
@register("upsert_chunks", sql="""
WITH toks AS (SELECT doc_id, lang, list_filter(regexp_split_to_array(text, '[\\t\\n\\x{0B}\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'), lambda t: t <> '') AS t FROM documents),
gens AS (
  SELECT doc_id, 1 AS load_seq, 500 AS size, 450 AS step, t FROM toks
  UNION ALL
  SELECT doc_id, 2, 800, 700, t FROM toks WHERE lang = 'en'),
w AS (SELECT *, CASE WHEN len(t) = 0 THEN 0
                     ELSE greatest(0, ceil((len(t) - size) / step::DOUBLE))::BIGINT + 1 END AS nwin
      FROM gens),
i AS (SELECT doc_id, load_seq, size, step, t, unnest(range(nwin)) AS wi FROM w),
chunks AS (
  SELECT doc_id, wi::INT AS chunk_index, load_seq,
         array_to_string(t[wi * step + 1 : wi * step + size], ' ') AS chunk_text FROM i)
SELECT * FROM chunks
QUALIFY load_seq = max(load_seq) OVER (PARTITION BY doc_id)
""")
def q_upsert_chunks(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    g1 = chunks.token_windows(d, size=500, overlap=50).withColumn("load_seq", F.lit(1))
    g2 = (chunks.token_windows(d.filter(F.col("lang") == "en"), size=800, overlap=100)
          .withColumn("load_seq", F.lit(2)))
    log = g1.unionByName(g2).select("doc_id", F.col("window_index").alias("chunk_index"),
                                    "load_seq", "chunk_text")
    return store.upsert_chunks(log, doc_col="doc_id")


# --- filing_chunks: every document is a filing text whose file stem carries
# a letters-only ticker made from its source, form 10-K and the document id
# as accession; the fact store is the labels (cik and company from the
# source, fiscal year 2020 + quality, period Q2 when toxic else Q1).
def _doc_stem(d):
    t = F.translate(F.upper("source"), "0123456789", "ABCDEFGHIJ")
    return F.concat(t, F.lit("_10-K_2026-01-01_"), F.lpad(F.col("doc_id").cast("string"), 18, "0"))


_WS_CLASS_SQL = ("'[\\t\\n\\x{0B}\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
                 "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'")


@register("filing_chunks", sql=f"""
WITH d AS (SELECT doc_id, source, text, translate(upper(source), '0123456789', 'ABCDEFGHIJ') AS ticker,
                  lpad(doc_id::VARCHAR, 18, '0') AS nd FROM documents),
docs AS (SELECT ticker, '10-K' AS form,
                substring(nd, 1, 10) || '-' || substring(nd, 11, 2) || '-' || substring(nd, 13, 6) AS accession_number,
                source, text FROM d),
facts AS (SELECT docs.ticker, docs.accession_number,
                 lpad(regexp_extract(docs.source, '[0-9]+'), 10, '0') AS cik, 'Source ' || docs.source AS company_name,
                 (2020 + l.quality)::INT AS fiscal_year, CASE WHEN l.toxic = 1 THEN 'Q2' ELSE 'Q1' END AS fiscal_period
          FROM labels l JOIN d ON d.doc_id = l.doc_id JOIN docs ON docs.accession_number =
               substring(d.nd, 1, 10) || '-' || substring(d.nd, 11, 2) || '-' || substring(d.nd, 13, 6)),
exact AS (SELECT * FROM facts QUALIFY row_number() OVER (PARTITION BY ticker, accession_number
            ORDER BY fiscal_year DESC NULLS LAST, fiscal_period DESC NULLS LAST, cik DESC, company_name DESC) = 1),
byt AS (SELECT ticker, cik, company_name FROM facts
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY cik DESC, company_name DESC) = 1),
t AS (SELECT ticker, form, accession_number,
             list_filter(regexp_split_to_array(text, {_WS_CLASS_SQL}), lambda x: x <> '') AS toks FROM docs),
w AS (SELECT *, CASE WHEN len(toks) = 0 THEN 0
                     ELSE greatest(0, ceil((len(toks) - 500) / 450.0))::BIGINT + 1 END AS nwin FROM t),
i AS (SELECT ticker, form, accession_number, toks, unnest(range(nwin)) AS wi FROM w)
SELECT CASE WHEN e.ticker IS NOT NULL THEN e.cik ELSE b.cik END AS cik, i.ticker,
       CASE WHEN e.ticker IS NOT NULL THEN e.company_name ELSE b.company_name END AS company_name,
       i.form, e.fiscal_year, e.fiscal_period, i.accession_number, 'Full Document' AS section,
       wi::INT AS chunk_index, array_to_string(toks[wi * 450 + 1 : wi * 450 + 500], ' ') AS chunk_text
FROM i LEFT JOIN exact e ON e.ticker = i.ticker AND e.accession_number = i.accession_number
       LEFT JOIN byt b ON b.ticker = i.ticker
""")
def q_filing_chunks(spark, sf_dir):
    from tallystone.functions.ids import accession_dash
    from tallystone.operators.metadata import filing_chunks
    d = table(spark, sf_dir, "documents")
    texts = d.select(_doc_stem(d).alias("stem"), "text")
    lab = table(spark, sf_dir, "labels").join(d.select("doc_id", "source"), "doc_id")
    facts = lab.select(F.translate(F.upper("source"), "0123456789", "ABCDEFGHIJ").alias("ticker"),
                       accession_dash(F.lpad(F.col("doc_id").cast("string"), 18, "0")).alias("accession_number"),
                       F.lpad(F.regexp_extract("source", "[0-9]+", 0), 10, "0").alias("cik"),
                       F.concat(F.lit("Source "), F.col("source")).alias("company_name"),
                       (F.lit(2020) + F.col("quality")).cast("int").alias("fiscal_year"),
                       F.when(F.col("toxic") == 1, "Q2").otherwise("Q1").alias("fiscal_period"))
    return filing_chunks(texts, facts)


# --- text_search: the benchmark passages are the query texts; the chunks are
# 500/50 windows of every document with hashed-TF vectors (width 64), ticker
# = source; top 5 per query. Hash vectors have no SQL twin: rows-only.
@register("text_search")
def q_text_search(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    w = chunks.token_windows(d.select("doc_id", F.upper("source").alias("ticker"), "text"),
                             id_cols=("doc_id", "ticker"))
    ch = vectors.embed_chunks(w.withColumn("chunk_id", F.concat_ws(":", "doc_id", "window_index"))
                              .withColumnRenamed("window_index", "chunk_index"), dim=64)
    qs = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")
    return vectors.search(ch, qs, k=5, dim=64)
