"""Validation: keyword snippets, automatic reconciliation, golden set, claims."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions import let
from tallystone.functions.fmt import format_value
from tallystone.functions.ids import golden_record_id
from tallystone.functions.text import WS_RUN, quote_literal_regex
from tallystone.operators.lookup import FACT_NEWEST
from tallystone.operators.mentions import agreeing, mention_array
from tallystone.operators.store import latest_by_key
from tallystone.schemas import (CONCEPT_KEYWORDS, GOLDEN_RECORD, GOLDEN_VERIFIED_BY, SNIPPET_AFTER,
                                SNIPPET_BEFORE)

# Every character Python's str.isspace accepts, for btrim (no regex).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")
MARK = "\uE000"


def _literal_ci_pattern(keyword: Column | str) -> Column:
    if isinstance(keyword, str):
        return F.lit("(?iu)" + quote_literal_regex(keyword))
    return F.concat(F.lit("(?iu)\\Q"), F.replace(keyword, F.lit("\\E"), F.lit("\\E\\\\E\\Q")),
                    F.lit("\\E"))


def _clean(s: Column) -> Column:
    return F.btrim(F.translate(s, "\n", " "), F.lit(WS_CHARS))


def keyword_matches(text: Column, keyword: Column | str, before: int = SNIPPET_BEFORE,
                    after: int = SNIPPET_AFTER) -> Column:
    """All non-overlapping case-insensitive literal matches of ``keyword``.

    Returns ``array<struct<pre, post>>``: for each match, at least ``before``
    characters of text before it (or all there is) and at least
    ``len(keyword) + after`` characters from its start (or all there is).
    ``snippet_of`` turns one element into the snippet. One ``regexp_replace``
    marks every match and one ``split`` cuts the text so that piece i+1
    starts with match i; each match reads its own and neighbouring pieces,
    and joins a wider range only when those are too short — O(matches) work
    per document, and the per-match lambda stays a few array lookups.
    """
    pat = _literal_ci_pattern(keyword)
    klen = F.length(F.lit(keyword)) if isinstance(keyword, str) else F.length(keyword)

    def body(ps: Column) -> Column:
        n = F.size(ps)

        def parts(p: Column, i: Column) -> Column:
            at = i + 2                                   # 1-based index of this piece
            near = F.concat(p, *[F.coalesce(F.try_element_at(ps, at + d), F.lit("")) for d in range(1, 6)])
            post = let(near, lambda v: F.when((F.length(v) >= klen + after) | (at + 5 >= n), v)
                       .otherwise(F.concat(v, F.array_join(F.slice(ps, at + 6, after), ""))))
            prev = F.element_at(ps, at - 1)
            lo = F.greatest(F.lit(1), at - 1 - before)
            pre = F.when((F.length(prev) >= before) | (at - 1 == 1), prev) \
                .otherwise(F.array_join(F.slice(ps, lo, at - lo), ""))
            return F.struct(pre.alias("pre"), post.alias("post"))

        return F.transform(F.slice(ps, 2, 1 << 30), parts)

    fast = let(F.split(F.regexp_replace(text, pat, MARK + "$0"), MARK, -1), body)
    return F.when(F.instr(text, MARK) == 0, fast).otherwise(
        _keyword_matches_general(text, pat, before, after))


def snippet_of(m: Column, keyword: Column | str, before: int = SNIPPET_BEFORE,
               after: int = SNIPPET_AFTER) -> Column:
    """Snippet from a ``keyword_matches`` element: ``before`` characters,
    the match and ``after`` characters; newlines as spaces; stripped."""
    klen = F.length(F.lit(keyword)) if isinstance(keyword, str) else F.length(keyword)
    return _clean(F.concat(F.substring(m["pre"], -before, before),
                           F.substring(m["post"], F.lit(1), klen + after)))


def _uncut(m: Column, keyword: Column, before: int = SNIPPET_BEFORE, after: int = SNIPPET_AFTER) -> Column:
    """The snippet without digits at an end where the text goes on."""
    s, long = snippet_of(m, keyword, before, after), F.length(keyword) + after
    s = F.when(F.length(m["post"]) > long, F.regexp_replace(s, r"[\d.,]+$", "")).otherwise(s)
    return F.when(F.length(m["pre"]) > before, F.regexp_replace(s, r"^[\d.,]+", "")).otherwise(s)


def _keyword_matches_general(text: Column, pat: Column, before: int, after: int) -> Column:
    """Same elements for texts that contain the marker character: split at
    the matches, keep the matched strings, interleave them."""
    ph = F.struct(F.split(text, pat, -1).alias("parts"),
                  F.regexp_extract_all(text, pat, 0).alias("hits"))

    def interleave(v: Column) -> Column:
        m = F.size(v["hits"])
        return F.struct(m.alias("m"), F.flatten(F.transform(v["parts"], lambda p, i: F.when(
            i < m, F.array(p, F.element_at(v["hits"], i + 1))).otherwise(F.array(p)))).alias("inter"))

    def elements(v: Column) -> Column:
        inter, m = v["inter"], v["m"]

        def element(j: Column) -> Column:
            at = 2 * j + 2                      # 1-based index of match j in ``inter``
            lo = F.greatest(F.lit(1), at - 2 * before)
            pre = F.array_join(F.slice(inter, lo, at - lo), "")
            pre = F.when(at - lo > 0, pre).otherwise(F.lit(""))
            post = F.array_join(F.slice(inter, at, 2 * after + 1), "")
            return F.struct(pre.alias("pre"), post.alias("post"))

        idx = F.when(m > 0, F.sequence(F.lit(0), m - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(idx, element)

    return let(let(ph, interleave), elements)


KW_T = "array<struct<concept:string,kw_pos:int,keyword:string>>"


def _kw_array(kws: Sequence[tuple[str, int, str]]) -> Column:
    """The keyword list as one constant (a JSON literal folded by Catalyst)."""
    rows = [{"concept": c, "kw_pos": int(p), "keyword": k} for c, p, k in kws]
    return F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), KW_T)


def keyword_snippets(docs: DataFrame, keywords: Sequence[tuple[str, int, str]],
                     text_col: str = "text", id_cols: Sequence[str] = ("doc_id",),
                     concept_col: str | None = None, normalize_ws: bool = False, whole_numbers: bool = False) -> DataFrame:
    """Snippets of keywords in documents.

    ``keywords`` is the small fixed (concept, kw_pos, keyword) list, inlined
    as a literal. Without ``concept_col`` every keyword is searched in every
    document; with it, only the keywords of each row's own concept, and a
    concept without keywords searches its own name with underscores as
    spaces. Output: ids, concept, kw_pos, keyword, match_idx, snippet.
    ``normalize_ws`` collapses every whitespace run (line breaks included) to
    one space first, so a phrase split over lines by inline markup (one text
    node per line) is still found. ``whole_numbers`` adds ``evidence_text``, the
    snippet without a number that its ends may have cut.
    """
    kws = list(keywords)
    df = docs
    if normalize_ws:
        df = df.withColumn(text_col, F.regexp_replace(F.col(text_col), WS_RUN, " "))
    df = df.withColumn("_lt", F.lower(F.col(text_col)))
    all_kw = _kw_array(kws)
    if concept_col is None:
        row_kw = all_kw
    else:
        own = F.array(F.struct(F.col(concept_col).alias("concept"), F.lit(0).alias("kw_pos"),
                               F.replace(F.col(concept_col), F.lit("_"), F.lit(" ")).alias("keyword")))
        mine = F.filter(all_kw, lambda k: k["concept"] == F.col(concept_col))
        row_kw = F.when(F.size(mine) > 0, mine).otherwise(own)
    found = df.select(*id_cols, F.inline_outer(F.transform(row_kw, lambda k: F.struct(
        k["concept"].alias("concept"), k["kw_pos"].alias("kw_pos"), k["keyword"].alias("keyword"),
        F.when(F.instr(F.col("_lt"), F.lower(k["keyword"])) > 0,
               keyword_matches(F.col(text_col), k["keyword"]))
        .otherwise(F.array().cast("array<struct<pre:string,post:string>>")).alias("snips")))))
    return (found.filter(F.col("snips").isNotNull())
            .select(*id_cols, "concept", "kw_pos", "keyword",
                    F.posexplode_outer("snips").alias("match_idx", "m"))
            .filter(F.col("match_idx").isNotNull())
            .select(*id_cols, "concept", "kw_pos", "keyword", "match_idx", snippet_of(F.col("m"), F.col("keyword")).alias("snippet"),
                    *([_uncut(F.col("m"), F.col("keyword")).alias("evidence_text")] if whole_numbers else [])))


def concept_keyword_list(concept_keywords: dict | None = None) -> list[tuple[str, int, str]]:
    ck = concept_keywords or CONCEPT_KEYWORDS
    return [(c, i, k) for c, kws in ck.items() for i, k in enumerate(kws)]


def match_text_files(facts: DataFrame, texts: DataFrame, accn_col: str = "accession_number",
                     file_col: str = "file_name") -> DataFrame:
    """Each fact's filing text by accession.

    The accession is read out of the file name (dashed or undashed form),
    so the pairing is an equi join; several files for one accession resolve
    to the smallest file name.
    """
    nodash = F.regexp_extract(F.col(file_col), r"(\d{10}-?\d{2}-?\d{6})", 1)
    named = texts.withColumn("_accn", F.replace(nodash, F.lit("-"), F.lit("")))
    # the choice is made on names alone; the texts move once, in the join
    chosen = named.groupBy("_accn").agg(F.min(file_col).alias(file_col))
    t = named.join(chosen, ["_accn", file_col], "left_semi").select("_accn", file_col, "text")
    f = facts.withColumn("_accn", F.replace(F.col(accn_col), F.lit("-"), F.lit("")))
    return f.join(t, "_accn", "left").drop("_accn")


def reconcile_auto(facts: DataFrame, value_col: str = "value", text_col: str = "text") -> DataFrame:
    """Machine check of a value against the evidence text beside it.

    ``verified`` when a mention of the text has a reading that agrees with the
    value (``mentions``: "Item 1" and "page 5" verify nothing, nor do years);
    ``matched_scale`` is the smallest scale that agrees.
    """
    hit = agreeing(F.col(value_col), mention_array(F.col(text_col)))
    return (facts.withColumn("_scale", F.array_min(F.transform(hit, lambda r: r["scale"])))
            .withColumn("verified", F.col("_scale").isNotNull()).withColumn("matched_scale", F.col("_scale")).drop("_scale")
            .select(*facts.columns, "matched_scale", "verified"))


def reconcile_newest(facts: DataFrame, texts: DataFrame, keywords: Sequence[tuple[str, int, str]],
                     keys: Sequence[str] = ("ticker", "concept"),
                     order: Sequence[str | Column] = FACT_NEWEST) -> DataFrame:
    """The reconciliation flow: newest fact of every key -> its filing's text ->
    keyword snippets -> verdict.

    One row per key with the fact's columns, ``shown`` (the value by its unit),
    ``file_name``, ``n_snippets``, ``matched_scale``, ``evidence`` (the first
    snippet that holds the value, else the first one) and ``verdict``:
    ``verified``, ``not_found`` (snippets, none with the value),
    ``no_occurrence`` (a text without any keyword) or ``no_text``. ``keys``
    ends with the concept. NULL keys are keys like any other.
    """
    *ids, concept = keys
    newest = latest_by_key(facts, keys, order)
    paired = match_text_files(newest, texts)
    snips = keyword_snippets(paired.filter(F.col("text").isNotNull()), keywords, id_cols=(*ids, "value"),
                             concept_col=concept, normalize_ws=True, whole_numbers=True)
    place = F.struct((~F.col("verified")).alias("_v"), "kw_pos", "match_idx")
    found = (reconcile_auto(snips, "value", "evidence_text").groupBy(*ids, F.col("concept").alias(concept))
             .agg(F.count(F.lit(1)).alias("n_snippets"), F.min("matched_scale").alias("matched_scale"),
                  F.min_by("snippet", place).alias("evidence"))
             .select(*[F.col(k).alias(f"_{k}") for k in keys], "n_snippets", "matched_scale", "evidence"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    out = paired.drop("text").join(found, same, "left").drop(*[f"_{k}" for k in keys])
    return (out.withColumn("n_snippets", F.coalesce("n_snippets", F.lit(0)).cast("bigint"))
            .withColumn("shown", format_value(F.col("value"), F.col("unit")))
            .withColumn("verdict", F.when(F.col("file_name").isNull(), "no_text")
                        .when(F.col("n_snippets") == 0, "no_occurrence")
                        .when(F.col("matched_scale").isNull(), "not_found").otherwise("verified")))


def golden_records(reconciled: DataFrame, verified_date: str, notes: str = "",
                   verified_by: str = GOLDEN_VERIFIED_BY) -> DataFrame:
    """Golden records of the verified rows of ``reconcile_newest`` (columns of
    ``GOLDEN_RECORD``; one the facts lack is NULL)."""
    given = {"id": golden_record_id(F.col("ticker"), F.col("fiscal_year"), F.col("fiscal_period"), F.col("concept")),
             "ticker": F.upper("ticker"), "expected_value": F.col("value"), "source_snippet": F.col("evidence"),
             "verified_by": F.lit(verified_by), "verified_date": F.lit(verified_date), "notes": F.lit(notes)}
    return reconciled.filter(F.col("verdict") == "verified").select(*[
        given.get(f.name, F.col(f.name) if f.name in reconciled.columns else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in GOLDEN_RECORD.fields])


#: What tells versions of one fact apart, greatest first: the shortest period
#: (its start is the latest, the end being part of the key), the newest filing.
FACT_VERSION = ("period_start", "filed_date", "accession_number")


def one_fact(facts: DataFrame, keys: Sequence[str], value_col: str, out_col: str,
             order: Sequence[str] | None = None) -> DataFrame:
    """One value per key: of its versions the one with the greatest (``order``, value)."""
    order = [c for c in FACT_VERSION if c in facts.columns and c not in keys] if order is None else list(order)
    v = F.col(value_col)
    pick = F.max(F.when(v.isNotNull(), F.struct(*order, v.alias("_v"))))
    return facts.groupBy(*keys).agg(pick["_v"].alias(out_col))


def golden_eval(golden: DataFrame, facts: DataFrame, keys: Sequence[str],
                expected_col: str = "expected_value", value_col: str = "value",
                rel_tol: float = 0.0, abs_tol: float = 0.0,
                order: Sequence[str] | None = None) -> DataFrame:
    """Expected vs stored value per golden record.

    The fact side is reduced to one row per key first (``one_fact``: the
    shortest period, then the newest filing), so a record meets one fact.
    """
    one = one_fact(facts, keys, value_col, "actual_value", order)
    j = golden.join(one, list(keys), "left")
    diff = F.abs(F.col(expected_col) - F.col("actual_value"))
    tol = F.greatest(F.lit(abs_tol), F.lit(rel_tol) * F.abs(F.col(expected_col)))
    return (j.withColumn("found", F.col("actual_value").isNotNull())
            .withColumn("match", F.coalesce(diff <= tol, F.lit(False))))


def golden_accuracy(evaluated: DataFrame) -> DataFrame:
    """One row: records, found, matched, accuracy."""
    return evaluated.agg(F.count(F.lit(1)).alias("n_records"),
                         F.count(F.when(F.col("found"), 1)).alias("n_found"),
                         F.count(F.when(F.col("match"), 1)).alias("n_match"),
                         F.round(F.avg(F.col("match").cast("double")), 6).alias("accuracy"))


def verify_claims(claims: DataFrame, facts: DataFrame, keys: Sequence[str],
                  claimed_col: str = "claimed_value", value_col: str = "value",
                  rel_tol: float = 0.0, abs_tol: float = 0.005,
                  order: Sequence[str] | None = None) -> DataFrame:
    """Verdict for every generated number: verified / mismatch / no_fact."""
    one = one_fact(facts, keys, value_col, "fact_value", order)
    j = claims.join(one, list(keys), "left")
    tol = F.greatest(F.lit(abs_tol), F.lit(rel_tol) * F.abs(F.col("fact_value")))
    ok = F.abs(F.col(claimed_col) - F.col("fact_value")) <= tol
    return j.withColumn("verdict", F.when(F.col("fact_value").isNull(), "no_fact")
                        .when(ok, "verified").otherwise("mismatch"))
