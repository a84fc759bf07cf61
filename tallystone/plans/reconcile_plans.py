"""Validation bindings: snippets, automatic reconciliation, golden set, claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone.functions.text import WS
from tallystone.operators import mentions, reconcile, store, text_index
from tallystone.plans.registry import ORACLE, register, table
from tallystone.session import shared_dir

# The fixed concept keyword table plus a probe concept of words that occur in
# the driver's documents (none of the filing keywords do); "the" and "of the"
# overlap, which the search must keep.
PROBE = [("probe", 0, "the"), ("probe", 1, "of the"), ("probe", 2, "license"), ("probe", 3, "tion")]
SNIPPET_KEYWORDS = reconcile.concept_keyword_list() + PROBE


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_KW_VALUES = ", ".join(f"({_q(c)}, {p}, {_q(k)})" for c, p, k in SNIPPET_KEYWORDS)
_STRIP = _q(f"^[{WS}]+|[{WS}]+$")


@register("reconcile_snippets", sql=f"""
WITH kw(concept, kw_pos, keyword) AS (VALUES {_KW_VALUES}),
x AS (SELECT d.doc_id, k.concept, k.kw_pos, k.keyword,
             regexp_split_to_array(d.text, '(?i)\\Q' || k.keyword || '\\E') AS parts,
             regexp_extract_all(d.text, '(?i)\\Q' || k.keyword || '\\E') AS hits
      FROM documents d, kw k),
y AS (SELECT doc_id, concept, kw_pos, keyword, len(hits) AS m,
             flatten(list_transform(parts, lambda p, i: CASE WHEN i <= len(hits)
                                                          THEN [p, hits[i]] ELSE [p] END)) AS inter
      FROM x),
z AS (SELECT doc_id, concept, kw_pos, keyword, inter, unnest(range(m)) AS j FROM y WHERE m > 0)
SELECT doc_id, concept, kw_pos::INT AS kw_pos, keyword, j::INT AS match_idx,
  regexp_replace(replace(
     right(array_to_string(inter[greatest(1, 2 * j + 2 - 40) : 2 * j + 1], ''), 20)
     || inter[2 * j + 2]
     || left(array_to_string(inter[2 * j + 3 : 2 * j + 2 + 400], ''), 200),
     chr(10), ' '), {_STRIP}, '', 'g') AS snippet
FROM z
""")
def q_reconcile_snippets(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return reconcile.keyword_snippets(d, SNIPPET_KEYWORDS)


@register("indexed_snippets", sql=ORACLE["reconcile_snippets"])
def q_indexed_snippets(spark, sf_dir):
    """The same matches from a positional index of all documents, built here and searched by positions."""
    path = shared_dir(spark, "text-index")
    text_index.build_text_index(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return text_index.search_text_index(spark, path, SNIPPET_KEYWORDS)


# --- reconcile_auto: each order is a fact of value round(total) x 1e6
# (negative for status F); its evidence line prints round(total) in
# thousands-comma form, in parentheses for negatives; one in seven evidence
# lines carries a different number, one in eleven a longer one that ends with it.
# No line declares the scale, so only numbers of three significant digits count.
def _auto_inputs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    whole = F.round("o_totalprice")
    neg = F.col("o_orderstatus") == "F"
    printed = F.format_number(whole + F.when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0), 0)
    printed = F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("2,"), printed)).otherwise(printed)
    printed = F.when(neg, F.concat(F.lit("("), printed, F.lit(")"))).otherwise(printed)
    return o.select("o_orderkey",
                    (whole * F.lit(1e6) * F.when(neg, -1.0).otherwise(1.0)).alias("value"),
                    F.concat(F.lit("Total net sales "), printed).alias("text"))


@register("reconcile_auto", sql="""
WITH f AS (
  SELECT o_orderkey,
         round(o_totalprice) * 1e6 * CASE WHEN o_orderstatus = 'F' THEN -1.0 ELSE 1.0 END AS value,
         CASE WHEN o_orderkey % 11 = 0 THEN '2,' ELSE '' END
           || format('{:,}', (round(o_totalprice) + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END)::BIGINT) AS p,
         'Total net sales ' || CASE WHEN o_orderstatus = 'F' THEN '(' || p || ')' ELSE p END AS text
  FROM orders),
r AS (SELECT f.*, s.scale, abs(value) / s.scale AS x
      FROM f, (VALUES (1.0::DOUBLE), (1000.0::DOUBLE), (1e6::DOUBLE), (1e9::DOUBLE)) s(scale)),
n AS (SELECT *, CASE WHEN x = floor(x) AND x >= 1 THEN format('{:,}', x::BIGINT) END AS form FROM r),
h AS (SELECT *, (scale = 1 OR length(rtrim(replace(form, ',', ''), '0')) >= 3)
                AND coalesce(regexp_matches(text, '(?:^|[^0-9.,])' || CASE WHEN value < 0 THEN '(?:\\(|-)' ELSE '' END
                  || form || '(?:[.]00)?' || '(?:$|[^0-9.,]|[.,](?:$|[^0-9]))'), false) AS hit
      FROM n)
SELECT o_orderkey, any_value(value) AS value, any_value(text) AS text,
       min(CASE WHEN hit THEN scale END) AS matched_scale, bool_or(hit) AS verified
FROM h GROUP BY o_orderkey
""")
def q_reconcile_auto(spark, sf_dir):
    return reconcile.reconcile_auto(_auto_inputs(spark, sf_dir))


# --- number_mentions: every order has a line that declares millions, prints its
# total, a percentage, billions of their own, a year and a loss, beside numbers that
# only name something.
@register("number_mentions", sql="""
WITH o AS (SELECT DISTINCT o_orderkey, round(o_totalprice)::BIGINT AS w FROM orders)
SELECT o_orderkey, i::INT AS mention_idx,
       CASE i WHEN 0 THEN w WHEN 1 THEN 12.5 WHEN 2 THEN 1 + (o_orderkey % 90) / 10 WHEN 3 THEN 2024 ELSE 1717 END::DOUBLE AS number,
       CASE i WHEN 1 THEN 'percent' WHEN 2 THEN 'USD' END AS unit, CASE i WHEN 2 THEN 1e9 END::DOUBLE AS scale,
       1e6::DOUBLE AS declared, i = 3 AS year, i = 4 AS negative
FROM o, range(5) r(i)
""")
def q_number_mentions(spark, sf_dir):
    key = F.col("o_orderkey")
    texts = table(spark, sf_dir, "orders").select(key, F.concat(
        F.lit("Item 7. (Dollars in millions) Net sales "), F.format_number(F.round("o_totalprice"), 0),
        F.lit(", up 12.5%; see Note 3 on page 41 and Form 10-K of May 1, 2026. Cash of $"),
        F.format_number(F.lit(1) + key % 90 / 10, 1), F.lit(" billion in 2024; loss (1,717)"))
        .alias("text")).distinct()
    return mentions.number_mentions(texts, id_cols=("o_orderkey",)).select(
        "o_orderkey", "mention_idx", "number", "unit", "scale", "declared", "year", "negative")


# --- reconcile_mentions: every order is a filing with one line of ten kinds, and has two facts:
# one that the line may show, rightly or with a near miss, and one that it never shows.
_LINES = [  # line before and after the total, value of the fact per unit of the total, plus, scale, evidence
    ("Item 7. See page 5 of this report", None, "", "5e6", None, None),
    ("(in millions) Net sales ", "w", "", "w * 1e6 + 3e5", "1e6", "declared"),
    ("Net sales were $", "t", " billion", "floor(w / 100) * 1e8 + 4e7", "1e9", "stated"),
    ("(in millions) Net sales ", "w1", "", "w * 1e6", None, None),
    ("(in thousands) Net loss (", "w", ")", "w * -1e3", "1e3", "declared"),
    ("In 2024 the company", None, "", "2024e6", None, None),
    ("Total net sales ", "w", "", "w * 1e6", "1e6", "implied"),
    ("(in thousands) Total ", "w", "", "w * 1e6", None, None),
    ("Net loss ", "w", "", "w * -1e6", None, None),
    ("Dividends paid (", "w", ")", "w * 1e0", "1e0", "plain"),
]


@register("reconcile_mentions", sql=f"""
WITH o AS (SELECT DISTINCT o_orderkey, round(o_totalprice) AS w FROM orders),
v AS (SELECT o_orderkey, w, CASE o_orderkey % 10 {" ".join(f"WHEN {i} THEN {x[3]}" for i, x in enumerate(_LINES))} END::DOUBLE AS v,
             CASE o_orderkey % 10 {" ".join(f"WHEN {i} THEN {x[4]}" for i, x in enumerate(_LINES) if x[4])} END::DOUBLE AS s,
             CASE o_orderkey % 10 {" ".join(f"WHEN {i} THEN '{x[5]}'" for i, x in enumerate(_LINES) if x[5])} END AS e FROM o),
k AS (SELECT *, CASE e WHEN 'implied' THEN length(rtrim(w::BIGINT::VARCHAR, '0')) >= 3 ELSE e IS NOT NULL END AS ok FROM v)
SELECT o_orderkey, 'shown' AS fact, v AS value, ok::BIGINT AS n_agreeing, CASE WHEN ok THEN s END AS matched_scale,
       CASE WHEN ok THEN e END AS evidence, ok AS verified FROM k
UNION ALL
SELECT o_orderkey, 'other', v * 3 + 7, 0, NULL, NULL, false FROM k
""")
def q_reconcile_mentions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.round("o_totalprice").alias("w")).distinct()
    kind = F.col("o_orderkey") % 10
    printed = {"w": F.format_number("w", 0), "w1": F.format_number(F.col("w") + 1, 0),
               "t": F.format_number(F.floor(F.col("w") / 100) / 10, 1), None: F.lit("")}
    text, value = F.lit(None).cast("string"), F.lit(None).cast("double")
    for i, (before, number, after, amount, _, _) in enumerate(_LINES):
        text = F.when(kind == i, F.concat(F.lit(before), printed[number], F.lit(after))).otherwise(text)
        value = F.when(kind == i, F.expr(amount).cast("double")).otherwise(value)
    lines = o.select("o_orderkey", text.alias("text"), value.alias("v"))
    facts = lines.select("o_orderkey", F.explode(F.array(
        F.struct(F.lit("shown").alias("fact"), F.col("v").alias("value")),
        F.struct(F.lit("other").alias("fact"), (F.col("v") * 3 + 7).alias("value")))).alias("f")).select("o_orderkey", "f.*")
    said = mentions.number_mentions(lines, id_cols=("o_orderkey",))
    return mentions.reconcile_mentions(facts, said, ("o_orderkey",)).drop("matched_raw")


# --- golden_upsert: labels are the golden set (id = doc_id, load 0); the new
# batch rates every English document (quality = more than 2,000 characters,
# load 1); with overwrite the batch replaces overlapping ids.
def _golden_base_batch(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents")
    base = lab.select(F.col("doc_id").alias("id"), "quality", "toxic",
                      F.lit(0).alias("load_seq"), F.col("doc_id").alias("pos"))
    batch = docs.filter(F.col("lang") == "en").select(
        F.col("doc_id").alias("id"), (F.col("n_chars") > 2000).cast("int").alias("quality"),
        F.lit(0).alias("toxic"), F.lit(1).alias("load_seq"), F.col("doc_id").alias("pos"))
    return base, batch


_GOLDEN_CTE = """
base AS (SELECT doc_id AS id, quality, toxic, 0 AS load_seq, doc_id AS pos FROM labels),
batch AS (SELECT doc_id AS id, (n_chars > 2000)::INT AS quality, 0 AS toxic, 1 AS load_seq,
                 doc_id AS pos FROM documents WHERE lang = 'en')"""


@register("golden_upsert", sql=f"""
WITH {_GOLDEN_CTE}
SELECT * FROM base WHERE id NOT IN (SELECT id FROM batch)
UNION ALL SELECT * FROM batch
""")
def q_golden_upsert(spark, sf_dir):
    base, batch = _golden_base_batch(spark, sf_dir)
    return store.golden_upsert(base, batch, overwrite=True)


@register("golden_upsert_keep", sql=f"""
WITH {_GOLDEN_CTE}
SELECT * FROM base
UNION ALL SELECT * FROM batch WHERE id NOT IN (SELECT id FROM base)
""")
def q_golden_upsert_keep(spark, sf_dir):
    base, batch = _golden_base_batch(spark, sf_dir)
    return store.golden_upsert(base, batch, overwrite=False)


# --- golden_eval: expected = labels.quality; the stored fact per document is
# 1.0 when the document has more than 1,000 characters, else 0.0.
_EVAL_SQL = """
SELECT g.doc_id, g.expected_value, f.actual_value, f.actual_value IS NOT NULL AS found,
       coalesce(abs(g.expected_value - f.actual_value) <= 0.0, false) AS match
FROM (SELECT doc_id, quality::DOUBLE AS expected_value FROM labels) g
LEFT JOIN (SELECT doc_id, max(CASE WHEN n_chars > 1000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS actual_value
           FROM documents GROUP BY doc_id) f USING (doc_id)"""


def _golden_eval(spark, sf_dir):
    golden = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("expected_value"))
    facts = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("n_chars") > 1000, 1.0).otherwise(0.0).alias("value"))
    return reconcile.golden_eval(golden, facts, ["doc_id"])


@register("golden_eval", sql=_EVAL_SQL)
def q_golden_eval(spark, sf_dir):
    return _golden_eval(spark, sf_dir)


@register("golden_accuracy", sql=f"""
SELECT count(*) AS n_records, count(*) FILTER (WHERE found) AS n_found,
       count(*) FILTER (WHERE match) AS n_match, round(avg(match::INT::DOUBLE), 6) AS accuracy
FROM ({_EVAL_SQL})
""")
def q_golden_accuracy(spark, sf_dir):
    return reconcile.golden_accuracy(_golden_eval(spark, sf_dir))


# --- verify_claims: every order's total is claimed (2 places), one claim in
# seven off by one; the fact store is orders.
@register("verify_claims", sql="""
WITH c AS (SELECT o_orderkey, round(o_totalprice, 2)
                  + CASE WHEN o_orderkey % 7 = 0 THEN 1.0 ELSE 0.0 END AS claimed_value FROM orders),
f AS (SELECT o_orderkey, max(o_totalprice) AS fact_value FROM orders GROUP BY o_orderkey)
SELECT c.o_orderkey, c.claimed_value, f.fact_value,
       CASE WHEN f.fact_value IS NULL THEN 'no_fact'
            WHEN abs(c.claimed_value - f.fact_value) <= 0.005 THEN 'verified'
            ELSE 'mismatch' END AS verdict
FROM c LEFT JOIN f USING (o_orderkey)
""")
def q_verify_claims(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    claims = o.select("o_orderkey", (F.round("o_totalprice", 2) + F.when(
        F.col("o_orderkey") % 7 == 0, 1.0).otherwise(0.0)).alias("claimed_value"))
    facts = o.select("o_orderkey", F.col("o_totalprice").alias("value"))
    return reconcile.verify_claims(claims, facts, ["o_orderkey"])


# --- reconcile_facts: every labelled document is a fact (accession = its id,
# 18 digits dashed 10-2-6); concept "probe" when quality = 1, else the
# unmapped concept "the_license" (searched as "the license"). The fact finds
# its text through the accession inside the text file name (undashed, as
# files are named), then its concept's keywords are searched.
def _snippet_sql(src: str, id_col: str) -> str:
    return f"""
x AS (SELECT {id_col}, concept, kw_pos, keyword,
             regexp_split_to_array(text, '(?i)\\Q' || keyword || '\\E') AS parts,
             regexp_extract_all(text, '(?i)\\Q' || keyword || '\\E') AS hits
      FROM {src}),
y AS (SELECT {id_col}, concept, kw_pos, keyword, len(hits) AS m,
             flatten(list_transform(parts, lambda p, i: CASE WHEN i <= len(hits)
                                                          THEN [p, hits[i]] ELSE [p] END)) AS inter
      FROM x),
z AS (SELECT {id_col}, concept, kw_pos, keyword, inter, unnest(range(m)) AS j FROM y WHERE m > 0)
SELECT {id_col}, concept, kw_pos::INT AS kw_pos, keyword, j::INT AS match_idx,
  regexp_replace(replace(
     right(array_to_string(inter[greatest(1, 2 * j + 2 - 40) : 2 * j + 1], ''), 20)
     || inter[2 * j + 2]
     || left(array_to_string(inter[2 * j + 3 : 2 * j + 2 + 400], ''), 200),
     chr(10), ' '), {_STRIP}, '', 'g') AS snippet
FROM z"""


@register("reconcile_facts", sql=f"""
WITH kw(concept, kw_pos, keyword) AS (VALUES {_KW_VALUES}),
f AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'probe' ELSE 'the_license' END AS concept FROM labels),
t AS (SELECT doc_id AS tdoc, text FROM documents),
j AS (SELECT f.doc_id, f.concept, t.text FROM f JOIN t ON t.tdoc = f.doc_id),
src AS (SELECT j.doc_id, j.concept, kw.kw_pos, kw.keyword, j.text FROM j JOIN kw USING (concept)
        UNION ALL
        SELECT doc_id, concept, 0, replace(concept, '_', ' '), text FROM j
        WHERE concept NOT IN (SELECT concept FROM kw)),
{_snippet_sql('src', 'doc_id')}
""")
def q_reconcile_facts(spark, sf_dir):
    from tallystone.functions import ids
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents")
    nodash = F.lpad(F.col("doc_id").cast("string"), 18, "0")
    facts = lab.select("doc_id", ids.accession_dash(nodash).alias("accession_number"),
                       F.when(F.col("quality") == 1, "probe").otherwise("the_license").alias("concept"))
    texts = docs.select(F.concat(F.upper("source"), F.lit("_10-K_2026-01-01_"), nodash,
                                 F.lit(".txt")).alias("file_name"), "text")
    joined = reconcile.match_text_files(facts, texts).filter(F.col("text").isNotNull())
    return reconcile.keyword_snippets(joined, SNIPPET_KEYWORDS, id_cols=("doc_id",),
                                      concept_col="concept")


# --- reconcile_newest: every order is a fact of its customer (concept by
# priority, round(total) x 1e6) and files a text: its line names the concept and
# prints round(total), one in three names nothing, one in seven prints another
# number, one in eleven a longer one, one in five orders has no text at all.
_CONCEPTS = {"1-URGENT": "revenue", "2-HIGH": "net_income", "3-MEDIUM": "gross_profit", "5-LOW": "other_items"}
_PHRASES = {"revenue": "Total net sales", "net_income": "Net Income", "gross_profit": "Gross\nmargin and gross profit",
            "other_items": "Other items"}


def _flow_inputs(spark, sf_dir):
    from tallystone.functions import ids
    key = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    for a, b in _CONCEPTS.items():
        o = o.replace(a, b, "o_orderpriority")
    whole = F.round("o_totalprice")
    nd = F.lpad(key.cast("string"), 18, "0")
    facts = o.select(F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("ticker"),
                     F.col("o_orderpriority").alias("concept"), (whole * F.lit(1e6)).alias("value"), F.lit("USD").alias("unit"),
                     F.lit(None).cast("date").alias("period_start"), F.to_date("o_orderdate").alias("period_end"),
                     F.to_date("o_orderdate").alias("filed_date"), F.year("o_orderdate").alias("fiscal_year"),
                     F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("fiscal_period"),
                     ids.accession_dash(nd).alias("accession_number"))
    phrase = F.create_map(*[F.lit(x) for kv in _PHRASES.items() for x in kv])[F.col("o_orderpriority")]
    printed = F.format_number(whole + F.when(key % 7 == 0, 1).otherwise(0), 0)
    printed = F.when(key % 11 == 0, F.concat(F.lit("2,"), printed)).otherwise(printed)
    body = F.concat(F.lit("Cover page. "), F.when(key % 3 == 0, "Nothing here").otherwise(F.coalesce(phrase, F.lit("-"))),
                    F.lit(" "), printed, F.lit(" in total"))
    texts = o.filter(key % 5 != 0).select(F.concat(F.lit("T_10-K_2026-01-01_"), nd, F.lit(".txt")).alias("file_name"),
                                         body.alias("text"))
    return facts, texts


_FLOW_CTE = f"""
kw(concept, kw_pos, keyword) AS (VALUES {_KW_VALUES}),
n AS (SELECT *, CASE o_orderpriority {" ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in _CONCEPTS.items())}
                ELSE o_orderpriority END AS concept, round(o_totalprice)::BIGINT AS whole
      FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, lpad(o_orderkey::VARCHAR, 18, '0') DESC) = 1),
t AS (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN 'Cover page. ' || CASE WHEN o_orderkey % 3 = 0 THEN 'Nothing here' ELSE
             CASE concept {" ".join(f"WHEN {_q(a)} THEN {_q(b.replace(chr(10), ' '))}" for a, b in _PHRASES.items())} ELSE '-' END END
             || ' ' || CASE WHEN o_orderkey % 11 = 0 THEN '2,' ELSE '' END
             || format('{{:,}}', whole + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) || ' in total' END AS text FROM n),
h AS (SELECT t.o_orderkey, coalesce(sum(len(regexp_extract_all(text, '(?i)\\Q' || w.keyword || '\\E'))), 0)::BIGINT AS n_snippets
      FROM t LEFT JOIN (SELECT concept, keyword FROM kw UNION ALL
                        SELECT DISTINCT concept, replace(concept, '_', ' ') FROM t WHERE concept NOT IN (SELECT concept FROM kw)) w
        ON w.concept = t.concept GROUP BY t.o_orderkey),
v AS (SELECT t.*, n_snippets, n_snippets > 0 AND length(rtrim(whole::VARCHAR, '0')) >= 3 AND regexp_matches(text, '(?:^|[^0-9.,])' || format('{{:,}}', whole)
             || '(?:[.]00)?(?:$|[^0-9.,]|[.,](?:$|[^0-9]))') AS hit FROM t JOIN h USING (o_orderkey)),
flow AS (SELECT 'T' || o_custkey AS ticker, concept, whole * 1e6::DOUBLE AS value, o_orderkey, o_orderdate,
                year(o_orderdate)::INT AS fiscal_year, 'Q' || quarter(o_orderdate) AS fiscal_period,
                '$' || format('{{:,}}', whole * 1000000) AS shown, n_snippets,
                CASE WHEN hit THEN 1e6::DOUBLE END AS matched_scale,
                CASE WHEN text IS NULL THEN 'no_text' WHEN n_snippets = 0 THEN 'no_occurrence'
                     WHEN hit THEN 'verified' ELSE 'not_found' END AS verdict FROM v)"""


@register("reconcile_newest", sql=f"""
WITH {_FLOW_CTE}
SELECT ticker, concept, value, fiscal_year, fiscal_period, shown, n_snippets, matched_scale, verdict FROM flow
""")
def q_reconcile_newest(spark, sf_dir):
    flow = reconcile.reconcile_newest(*_flow_inputs(spark, sf_dir), SNIPPET_KEYWORDS)
    return flow.select("ticker", "concept", "value", "fiscal_year", "fiscal_period", "shown", "n_snippets",
                       "matched_scale", "verdict")


# --- golden_from_facts: the verified ones as golden records.
@register("golden_from_facts", sql=f"""
WITH {_FLOW_CTE}
SELECT ticker || '-' || fiscal_year || fiscal_period || '-' || concept AS id, ticker, concept, value AS expected_value,
       'USD' AS unit, o_orderdate::DATE::VARCHAR AS period_end, fiscal_year, fiscal_period,
       'manual_reconciliation' AS verified_by, '2026-01-01' AS verified_date, '' AS notes
FROM flow WHERE verdict = 'verified'
""")
def q_golden_from_facts(spark, sf_dir):
    flow = reconcile.reconcile_newest(*_flow_inputs(spark, sf_dir), SNIPPET_KEYWORDS)
    return reconcile.golden_records(flow, "2026-01-01").select(
        "id", "ticker", "concept", "expected_value", "unit", "period_end", "fiscal_year", "fiscal_period",
        "verified_by", "verified_date", "notes")
