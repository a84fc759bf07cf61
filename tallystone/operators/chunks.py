"""Sections, small-section merge, token windows and chunks of filing text.

Generators use the ``_outer`` forms plus an explicit NULL filter: the plain
forms make Catalyst infer ``size(array) > 0`` and push that filter below the
projections, where it would re-evaluate the whole array expression.

Every operator here is narrow: a document is one row and all work happens
inside that row with Catalyst higher-order functions (``split``,
``transform``, ``aggregate``, ``filter``), so there is no shuffle between
the text scan and the chunk table. Documents are independent; partitions
are sized by bytes at the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions import let
from tallystone.functions.text import (SECTION_HEADER, WS, normalize_header, word_tokens)
from tallystone.schemas import (DEFAULT_CHUNK_OVERLAP, DEFAULT_CHUNK_SIZE,
                                DEFAULT_MIN_SECTION_TOKENS, FULL_DOCUMENT_TITLE, PREAMBLE_TITLE)

MARK = "\u0001"
SECTION_T = "array<struct<title:string,text:string>>"


def token_count(c: Column) -> Column:
    return F.size(word_tokens(c))


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def _with(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns in one projection stage.

    Stages keep large intermediates (the split text, header lists) as plain
    attributes: Catalyst does not collapse a projection into the next one
    when that would duplicate a non-trivial expression, so lambdas below
    refer to computed arrays instead of recomputing them per element.
    """
    return df.withColumns(cols)


def with_raw_sections(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Add header-split sections before merging (X5) as an array of structs.

    Header matches are marked in one left-to-right ``regexp_replace`` (the
    same non-overlapping matches an iterating matcher finds) and the text is
    split at the marks. Of the headers sharing a normalised title only the
    last one starts a section; earlier ones stay inside the text of whatever
    precedes them. Text before the first kept header becomes the preamble.
    No header at all: one "Full Document" section.
    """
    t = F.col(text_col)
    df = _with(df, _segs=F.split(F.regexp_replace(t, SECTION_HEADER, MARK + "$1"), MARK, -1))
    df = _with(df, _body=F.slice("_segs", 2, 1 << 30))
    df = _with(df, _heads=F.transform("_body", lambda s: F.regexp_extract(s, "^" + SECTION_HEADER, 1)))
    df = _with(df, _norms=F.transform("_heads", lambda h: normalize_header(h)))
    # a header is kept when no later header has the same normalised title: the
    # last of its run once (title, position) pairs are sorted, no search per header
    df = _with(df, _kpos=let(
        F.array_sort(F.transform("_norms", lambda nm, i: F.struct(nm.alias("n"), i.alias("i")))),
        lambda s: F.array_sort(F.transform(
            F.filter(s, lambda e, j: ~e["n"].eqNullSafe(F.get(s, j + 1)["n"])), lambda e: e["i"]))))
    nk = F.size("_kpos")
    body_n = F.size("_body")

    def section(p: Column, j: Column) -> Column:
        nxt = F.when(j + 1 < nk, F.element_at("_kpos", j + 2)).otherwise(body_n)
        return F.struct(_strip(F.element_at("_heads", p + 1)).alias("title"),
                        F.array_join(F.slice("_body", p + 1, nxt - p), "").alias("text"))

    first = F.when(nk > 0, F.element_at("_kpos", 1)).otherwise(body_n)
    pre = F.concat(F.element_at("_segs", 1),
                   F.array_join(F.slice("_body", 1, first), ""))
    pre_arr = F.when(F.length(pre) > 0,
                     F.array(F.struct(F.lit(PREAMBLE_TITLE).alias("title"), pre.alias("text")))) \
        .otherwise(F.array().cast(SECTION_T))
    out = F.when(F.size("_segs") == 1,
                 F.array(F.struct(F.lit(FULL_DOCUMENT_TITLE).alias("title"), t.alias("text")))) \
        .otherwise(F.concat(pre_arr, F.transform("_kpos", section)))
    return _with(df, **{out_col: out}).drop("_segs", "_body", "_heads", "_norms", "_kpos")


def merge_small(sections: Column, min_tokens: int = DEFAULT_MIN_SECTION_TOKENS,
                count=token_count) -> Column:
    """Fold small sections into the next one (X6), in-row with ``aggregate``.

    Carry (title, buffer): the buffer plus this section, if still under
    ``min_tokens``, stays buffered under the first buffered title; otherwise
    it is emitted under that title (or this section's). A leftover buffer is
    appended to the last emitted section, or emitted alone.
    """
    init = F.struct(F.array().cast(SECTION_T).alias("res"), F.lit(None).cast("string").alias("bt"),
                    F.lit("").alias("bx"))

    def step(acc: Column, s: Column) -> Column:
        combined = F.when(acc["bx"] != "", F.concat(acc["bx"], F.lit("\n"), s["text"])) \
            .otherwise(s["text"])
        title = F.coalesce(acc["bt"], s["title"])
        small = count(combined) < min_tokens
        return F.when(small, F.struct(acc["res"].alias("res"), title.alias("bt"),
                                      combined.alias("bx"))) \
            .otherwise(F.struct(F.concat(acc["res"], F.array(F.struct(title.alias("title"),
                                                                       combined.alias("text")))).alias("res"),
                                F.lit(None).cast("string").alias("bt"), F.lit("").alias("bx")))

    def finish(acc: Column) -> Column:
        res, n = acc["res"], F.size(acc["res"])
        last = F.try_element_at(res, F.lit(-1))
        glued = F.concat(F.slice(res, 1, n - 1),
                         F.array(F.struct(last["title"].alias("title"),
                                          F.concat(last["text"], F.lit("\n"), acc["bx"]).alias("text"))))
        alone = F.array(F.struct(acc["bt"].alias("title"), acc["bx"].alias("text")))
        return F.when(acc["bx"] == "", res).when(n > 0, glued).otherwise(alone)

    return F.aggregate(sections, init, step, finish)


def window_count(n: Column, size: int, step: int) -> Column:
    return F.when(n <= 0, F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.ceil((n - F.lit(size)) / F.lit(float(step))).cast("int")) + 1)


def token_windows_expr(tokens: Column, size: int = DEFAULT_CHUNK_SIZE,
                       overlap: int = DEFAULT_CHUNK_OVERLAP) -> Column:
    """Windows of ``size`` tokens, each starting ``size - overlap`` after the
    previous; the last window is the first to reach the end (X7).
    Returns ``array<struct<token_start, n_tokens, chunk_text>>``."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    if overlap < 0 or overlap >= size:
        raise ValueError("overlap must be >= 0 and smaller than the chunk size")
    step = size - overlap
    nwin = window_count(F.size(tokens), size, step)
    idx = F.when(nwin > 0, F.sequence(F.lit(0), nwin - 1)).otherwise(F.array().cast("array<int>"))

    def win(i: Column) -> Column:
        part = F.slice(tokens, i * step + 1, size)
        return F.struct((i * step).alias("token_start"), F.size(part).alias("n_tokens"),
                        F.array_join(part, " ").alias("chunk_text"))

    return F.transform(idx, win)


# ---------------------------------------------------------------------------
# DataFrame operators
# ---------------------------------------------------------------------------

def with_sections(docs: DataFrame, text_col: str, out_col: str,
                  min_tokens: int = DEFAULT_MIN_SECTION_TOKENS, merge: bool = True) -> DataFrame:
    """Add the (merged) sections of ``text_col`` as ``array<struct<title,text>>``."""
    df = with_raw_sections(docs, text_col, "_raw")
    if merge:
        # a document without any header is one section and is never merged
        # (header titles start with "Item", so this title only means "no header")
        no_header = (F.size("_raw") == 1) & \
            (F.try_element_at("_raw", F.lit(1))["title"] == FULL_DOCUMENT_TITLE)
        df = _with(df, **{out_col: F.when(no_header, F.col("_raw"))
                          .otherwise(merge_small(F.col("_raw"), min_tokens))})
    else:
        df = _with(df, **{out_col: F.col("_raw")})
    return df.drop("_raw")


def split_sections(docs: DataFrame, text_col: str = "text", id_cols=("doc_id",),
                   min_tokens: int = DEFAULT_MIN_SECTION_TOKENS, merge: bool = True) -> DataFrame:
    """One row per (document, section): ``section_idx, title, section_text``."""
    df = with_sections(docs.select(*id_cols, text_col), text_col, "_secs",
                       min_tokens, merge)
    return df.select(*id_cols, F.posexplode_outer("_secs").alias("section_idx", "s")) \
        .filter(F.col("s").isNotNull()) \
        .select(*id_cols, "section_idx", F.col("s.title").alias("title"),
                F.col("s.text").alias("section_text"))


def merge_sections(sections: DataFrame, id_cols=("doc_id",), order_col: str = "section_idx",
                   title_col: str = "title", text_col: str = "section_text",
                   min_tokens: int = DEFAULT_MIN_SECTION_TOKENS) -> DataFrame:
    """Merge small sections given one row per section.

    The sections of a document are gathered into one ordered array (a
    document is a row everywhere else in this module) and folded in-row.
    """
    packed = (sections.groupBy(*id_cols)
              .agg(F.sort_array(F.collect_list(F.struct(order_col, F.struct(
                  F.col(title_col).alias("title"), F.col(text_col).alias("text")).alias("s"))))
                   .alias("_l")))
    merged = merge_small(F.transform(F.col("_l"), lambda x: x["s"]), min_tokens)
    return packed.select(*id_cols, F.posexplode_outer(merged).alias("section_idx", "s")) \
        .filter(F.col("s").isNotNull()) \
        .select(*id_cols, "section_idx", F.col("s.title").alias("title"),
                F.col("s.text").alias("section_text"))


def token_windows(docs: DataFrame, text_col: str = "text", id_cols=("doc_id",),
                  size: int = DEFAULT_CHUNK_SIZE, overlap: int = DEFAULT_CHUNK_OVERLAP,
                  tokens: Column | None = None) -> DataFrame:
    """One row per window: ``window_index, token_start, n_tokens, chunk_text``.

    ``tokens`` may supply any ``ARRAY<STRING>`` token column (e.g. from a
    sub-word tokenizer); the default is whitespace-separated words.
    """
    toks = tokens if tokens is not None else word_tokens(F.col(text_col))
    df = docs.select(*id_cols, toks.alias("_toks"))
    return df.select(*id_cols, F.posexplode_outer(token_windows_expr(F.col("_toks"), size, overlap))
                     .alias("window_index", "w")) \
        .filter(F.col("w").isNotNull()) \
        .select(*id_cols, "window_index", "w.token_start", "w.n_tokens", "w.chunk_text")


def build_chunks(docs: DataFrame, text_col: str = "text", id_cols=("doc_id",),
                 size: int = DEFAULT_CHUNK_SIZE, overlap: int = DEFAULT_CHUNK_OVERLAP,
                 min_tokens: int = DEFAULT_MIN_SECTION_TOKENS) -> DataFrame:
    """Sections -> merged sections -> windows.

    ``chunk_index`` is 0-based over the whole document, across sections.
    """
    df = with_sections(docs.select(*id_cols, text_col), text_col, "_secs", min_tokens)
    df = _with(df, _stoks=F.transform("_secs", lambda s: F.struct(
        s["title"].alias("title"), word_tokens(s["text"]).alias("toks"))))
    per_sec = F.transform("_stoks", lambda s: F.transform(
        token_windows_expr(s["toks"], size, overlap),
        lambda w: F.struct(s["title"].alias("section"), w["chunk_text"].alias("chunk_text"),
                           w["n_tokens"].alias("n_tokens"))))
    return df.select(*id_cols, F.posexplode_outer(F.flatten(per_sec)).alias("chunk_index", "c")) \
        .filter(F.col("c").isNotNull()) \
        .select(*id_cols, "chunk_index", "c.section", "c.chunk_text", "c.n_tokens")
