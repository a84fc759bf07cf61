"""Numbers as filings print them: mentions with sign, unit and scale, and their join with facts.

A mention is a number of its own in a text or cell. The grammar knows currency
signs and codes, thousands commas, decimals, minus signs, accounting
parentheses, percent and basis points, a scale of its own (``1.2 billion``, ``5M``),
and the scale that a heading declares (``(in millions)``) for all that follows up to
the next such heading. Numbers that only name something are no mentions: ``Item
7``, ``page 5``, ``Note 3``, ``10-K``, dates, years, accession numbers.

A mention has readings, each a scale and the evidence for it:

* ``stated``: its own scale word; ``declared``: a heading's scale. The number is
  rounded, so facts within half a unit of its last place agree;
* ``plain``: as it stands;
* ``implied``: thousands, millions or billions that nothing declares; needs three
  significant digits and no other scale in sight.

Plain and implied readings agree with equal values only. A negative fact needs
a negative mention; a positive one also agrees with parentheses, which
statements put around outflows that are stored as positive values.

All of it is Catalyst expressions; a text stays one row until its mentions become rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions import let

SCALES = {"thousand": 1e3, "million": 1e6, "billion": 1e9, "trillion": 1e12}
_SHORT = {"K": "thousand", "M": "million", "MN": "million", "B": "billion", "BN": "billion"}
IMPLIED = [1e3, 1e6, 1e9]
#: Evidence, best first.
EVIDENCE = ("stated", "declared", "plain", "implied")
#: Buckets of the join in each factor e of magnitude.
PER_E = 100

DECLARED = r"(?i)\bin\s+(?:[a-z.]+\s+)?(thousand|million|billion)s\b"
_CURRENCY = r"(?:US\$|USD|EUR|GBP|JPY|[$€£¥])"
_NUMBER = r"(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?|\.\d+"
_SCALE = r"(?:[\s-]?(?i:thousand|million|billion|trillion|bn|mn)s?\b|[KMB]\b)"
_SHARE = r"\s?(?:%|(?i:percent|per\s+cent|percentage\s+points?|basis\s+points?|bps)\b)"
_MONTH = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?"
_FEW = r"item|note|section|part|table|figure|exhibit|chapter|appendix|level|tier|footnote|schedule|step|phase|class|series"
_MANY = r"rule|form|number|no\.|version|article|paragraph|topic|asu|asc|fiscal|fiscal\s+year|fy|year"
_LABEL = rf"(?i:\b(?:{_FEW})s?\s*#?\s*\d{{1,2}}|\b(?:page|pp?\.)s?\s*\d{{1,4}}|\b(?:{_MANY})s?\s*#?\s*\d+)"
# What is no mention comes first and takes its digits along; mentions are group 1.
LEXEME = (rf"{_LABEL}(?:[.\-]\d+)*[A-Za-z]?\b(?!,\d)"
          rf"|\b\d{{4}}-\d{{2}}-\d{{2}}\b|\b\d+(?:-\d+)+\b|\b\d{{1,4}}(?:/\d{{1,4}})+\b"
          rf"|\b{_MONTH}\s+\d{{1,2}}\b(?!,\d{{3}}\b)(?:,?\s+\d{{4}}\b)?|\b\d{{1,2}}\s+{_MONTH}(?:\s+\d{{4}}\b)?"
          rf"|(?<![\w.,/%]|[A-Za-z]-)((?:\(\s?)?(?:[-−–]\s?)?(?:{_CURRENCY}\s?)?(?:\(\s?)?(?:[-−]\s?)?(?:{_NUMBER})"
          rf"(?:\s?\))?(?:{_SHARE}|{_SCALE})?(?:\s?\))?)(?!\w|-[A-Za-z]|[.,]\d|/\d)")
MENTION_T = ("array<struct<raw:string,number:double,decimals:int,significant:int,unit:string,"
             "scale:double,declared:double,year:boolean,negative:boolean,parentheses:boolean>>")


def _scale_of(word: Column) -> Column:
    w = F.regexp_replace(F.upper(F.trim(F.regexp_replace(word, r"[\s-]", ""))), "S$", "")
    out = F.lit(None).cast("double")
    for name, value in SCALES.items():
        out = F.when(w.isin(name.upper(), *[k for k, v in _SHORT.items() if v == name]), F.lit(value)).otherwise(out)
    return out


def _parsed(raw: Column, declared: Column) -> Column:
    def parts(v: Column) -> Column:
        text, plain = v["raw"], F.replace(v["number"], F.lit(","), F.lit(""))
        decimals = F.length(F.regexp_extract(plain, r"\.(\d+)", 1))
        bare = F.replace(plain, F.lit("."), F.lit(""))
        leading = F.regexp_replace(bare, "^0+", "")
        unit = (F.when(text.rlike(r"[$]|USD"), "USD").when(text.rlike("€|EUR"), "EUR").when(text.rlike("£|GBP"), "GBP")
                .when(text.rlike("¥|JPY"), "JPY").when(text.rlike("(?i)basis|bps"), "bps")
                .when(text.rlike("(?i)%|per"), "percent"))
        scale = _scale_of(F.regexp_extract(text, rf"\d\)?({_SCALE})", 1))
        within = text.contains("(") & text.contains(")")
        year = (F.length(v["number"]) == 4) & plain.between("1900", "2100") & unit.isNull() & scale.isNull() & ~within
        return F.struct(F.trim(text).alias("raw"), plain.try_cast("double").alias("number"), decimals.alias("decimals"),
                        F.length(F.when(decimals > 0, leading).otherwise(F.regexp_replace(leading, "0+$", ""))).alias("significant"),
                        unit.alias("unit"), scale.alias("scale"), declared.alias("declared"), year.alias("year"),
                        (within | text.rlike("[-−–]\\s?(?:" + _CURRENCY + "\\s?)?\\(?[.\\d]")).alias("negative"),
                        within.alias("parentheses"))

    return let(F.struct(raw.alias("raw"), F.regexp_extract(raw, _NUMBER, 0).alias("number")), parts)


def mention_array(text: Column, declared: Column | None = None) -> Column:
    """The mentions of a text in order (``MENTION_T``); ``declared``: a scale in force at its start. Null text: none."""
    first = F.lit(None).cast("double") if declared is None else declared
    text = F.coalesce(text, F.lit(""))
    pieces = F.struct(F.split(text, DECLARED, -1).alias("text"), F.regexp_extract_all(text, F.lit(DECLARED), 1).alias("scale"))

    def of_piece(v: Column):
        def piece(t: Column, i: Column) -> Column:
            scale = F.when(i == 0, first).otherwise(_scale_of(F.try_element_at(v["scale"], i)))
            found = F.filter(F.regexp_extract_all(t, F.lit(LEXEME), 1), lambda x: x != "")
            return let(scale, lambda s: F.transform(found, lambda x: _parsed(x, s)))
        return F.flatten(F.transform(v["text"], piece))

    return let(pieces, of_piece)


def readings(m: Column) -> Column:
    """How a mention may be meant: array<struct<scale, evidence, low, high>> of absolute values; none for years and zero."""
    share = m["unit"].isin("percent", "bps")

    def reading(scale: Column, evidence: str, rounded: bool) -> Column:
        half = (F.pow(F.lit(10.0), -m["decimals"]) / 2 if rounded else m["number"] * 1e-12) * scale
        value = m["number"] * scale
        return F.struct(scale.alias("scale"), F.lit(evidence).alias("evidence"), (value - half).alias("low"),
                        (value + half).alias("high"))

    stated = F.when(m["scale"].isNotNull(), reading(m["scale"], "stated", True))
    declared = F.when(m["scale"].isNull() & m["declared"].isNotNull() & ~F.coalesce(share, F.lit(False)),
                      reading(m["declared"], "declared", True))
    plain = F.when(m["scale"].isNull(), reading(F.lit(1.0), "plain", False))
    implied = [F.when(m["scale"].isNull() & m["declared"].isNull() & ~F.coalesce(share, F.lit(False))
                      & (m["significant"] >= 3), reading(F.lit(s), "implied", False)) for s in IMPLIED]
    some = F.filter(F.array(stated, declared, plain, *implied), lambda r: r.isNotNull())
    return F.when((m["number"] > 0) & ~m["year"], some).otherwise(F.filter(some, lambda r: F.lit(False)))


def sign_agrees(value: Column, negative: Column, parentheses: Column) -> Column:
    return F.when(value < 0, negative).otherwise(~negative | parentheses)


def agreeing(value: Column, mentions: Column) -> Column:
    """Readings of an array of mentions that agree with ``value``."""
    def of(m: Column) -> Column:
        return F.when(sign_agrees(value, m["negative"], m["parentheses"]), F.filter(
            readings(m), lambda r: F.abs(value).between(r["low"], r["high"]))).otherwise(
                F.filter(readings(m), lambda r: F.lit(False)))
    return F.flatten(F.transform(mentions, of))


def number_mentions(texts: DataFrame, text_col: str = "text", id_cols: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per mention: ids, mention_idx (from 0), and the fields of ``MENTION_T``."""
    found = texts.select(*id_cols, F.posexplode(mention_array(F.col(text_col))).alias("mention_idx", "m"))
    return found.select(*id_cols, "mention_idx", "m.*")


def cell_mentions(cells: DataFrame, id_cols: Sequence[str] = ("page_id",)) -> DataFrame:
    """One row per cell of ``html_tables`` that is a number: ids, table, row, column, mention.

    A scale declared in any cell holds for the whole table (the first one in reading
    order). A cell that opens a parenthesis is negative: its other half is often a cell of its own.
    """
    keys = [*id_cols, "table_idx"]
    scale = _scale_of(F.regexp_extract("cell", DECLARED, 1))
    heads = (cells.withColumn("_scale", scale).where("_scale IS NOT NULL").groupBy(*keys)
             .agg(F.min_by("_scale", F.struct("row_idx", "col_idx")).alias("_declared")))
    # spans repeat a cell; null keys are keys like any other
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    joined = cells.where("num IS NOT NULL OR cell RLIKE '[0-9]'").alias("c").join(heads.alias("h"), same, "left")
    closed = F.when(F.col("cell").startswith("(") & ~F.col("cell").contains(")"), F.concat("cell", F.lit(")"))).otherwise(F.col("cell"))
    found = joined.select(*[F.col(f"c.{k}").alias(k) for k in keys], "c.row_idx", "c.col_idx",
                          mention_array(closed, F.col("h._declared")).alias("m"))
    return (found.where(F.size("m") == 1).select(*keys, "row_idx", "col_idx", F.element_at("m", 1).alias("m"))
            .select(*keys, "row_idx", "col_idx", "m.*"))


def _bucket(v: Column) -> Column:
    return F.floor(F.log(v) * PER_E)


def reconcile_mentions(facts: DataFrame, mentions: DataFrame, keys: Sequence[str] = ("accession_number",),
                       value_col: str = "value", unit_col: str | None = None) -> DataFrame:
    """Each fact with what its filing's mentions say about it.

    A band join: a reading covers the buckets of magnitude from its low to its high
    end (at most some 110, few for all but one-digit numbers), a fact lies in one, so
    facts and mentions meet by ``keys`` and bucket. Added columns: ``n_agreeing`` mentions, ``matched_scale``,
    ``evidence`` and ``matched_raw`` of the best one (by ``EVIDENCE``, then first), ``verified``. With
    ``unit_col``, a mention that names another unit does not count. Facts that are null,
    zero or have a null key are never verified; every row of ``facts`` comes back once.
    """
    named = {c: f"_m_{c}" for c in ("mention_idx", "raw", "unit", "negative", "parentheses")}
    order = "mention_idx" if "mention_idx" in mentions.columns else "row_idx"
    m = F.struct(*[F.col(c) for c in ("number", "decimals", "significant", "unit", "scale", "declared", "year")])
    said = (mentions.withColumn("_m", m).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col(order).alias(named["mention_idx"]),
        *[F.col(c).alias(named[c]) for c in ("raw", "unit", "negative", "parentheses")],
        F.explode(readings(F.col("_m"))).alias("_r"))
        .withColumn("_bucket", F.explode(F.sequence(_bucket(F.col("_r.low")), _bucket(F.col("_r.high"))))))
    value, by = F.col(value_col), [f"_k_{k}" for k in keys]
    unit = F.col(unit_col) if unit_col else F.lit(None).cast("string")
    asked = facts.where(F.abs(value) > 0).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], value.alias("_value"), F.coalesce(unit, F.lit("")).alias("_unit"),
        _bucket(F.abs(value)).alias("_bucket")).distinct()
    agree = (F.abs("_value").between(F.col("_r.low"), F.col("_r.high"))
             & sign_agrees(F.col("_value"), F.col(named["negative"]), F.col(named["parentheses"])))
    agree &= F.col(named["unit"]).isNull() | (F.col("_unit") == "") | (F.col(named["unit"]) == F.col("_unit"))
    rank = F.array_position(F.array(*map(F.lit, EVIDENCE)), F.col("_r.evidence"))
    place = F.struct(rank.alias("rank"), F.col(named["mention_idx"]).alias("at"), F.col("_r.scale").alias("scale"))
    found = (asked.join(said, [*by, "_bucket"]).where(agree).groupBy(*by, "_value", "_unit")
             .agg(F.countDistinct(named["mention_idx"]).alias("n_agreeing"), F.min_by("_r.scale", place).alias("matched_scale"),
                  F.min_by("_r.evidence", place).alias("evidence"), F.min_by(named["raw"], place).alias("matched_raw")))
    same = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    out = facts.join(found, [*same, value == F.col("_value"), F.coalesce(unit, F.lit("")) == F.col("_unit")], "left")
    return (out.drop(*by, "_value", "_unit").withColumn("n_agreeing", F.coalesce("n_agreeing", F.lit(0)).cast("bigint"))
            .withColumn("verified", F.col("matched_scale").isNotNull()))
