"""Fact extraction and derivation: tag fallback, derived ratio, growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.schemas import (CONCEPT_TAGS, DERIVED_CONCEPT, DERIVED_TAG, DERIVED_UNIT,
                                PREFERRED_UNIT, TAXONOMY)

TIDY_COLS = ["concept", "tag_used", "value", "unit", "start", "end", "fiscal_year",
             "fiscal_period", "form", "filed_date", "accession_number", "frame"]


def _pick_unit(units: Column) -> Column:
    """USD when that key exists, else the first unit in document order."""
    return F.when(F.map_contains_key(units, F.lit(PREFERRED_UNIT)), F.lit(PREFERRED_UNIT)) \
        .otherwise(F.try_element_at(F.map_keys(units), F.lit(1)))


def tag_fallback_doc(company_facts: DataFrame, concept_tags: dict | None = None,
                     facts_col: str = "facts", keep: Sequence[str] = ("cik", "entityName"),
                     taxonomy: str = TAXONOMY) -> DataFrame:
    """Tidy facts from parsed company-facts documents (A1 + P1), in-row.

    For each concept, walk its candidate tags in priority order; a tag's rows
    are the preferred unit's list (or the first unit's); the first tag whose
    list is non-empty supplies the whole series. An empty USD list moves on
    to the next *tag*, never to another unit. No shuffle: the choice is a
    ``filter(...)[0]`` inside each document row, then one ``inline``.
    """
    ct = concept_tags or CONCEPT_TAGS
    tax = F.try_element_at(F.col(facts_col), F.lit(taxonomy))
    per_concept = []
    for concept, tags in ct.items():
        cands = []
        for tag in tags:
            units = F.try_element_at(tax, F.lit(tag)).getField("units")
            unit = _pick_unit(units)
            rows = F.try_element_at(units, unit)
            cands.append(F.struct(F.lit(tag).alias("tag"), unit.alias("unit"),
                                  F.coalesce(rows, F.array()).alias("rows")))
        chosen = F.try_element_at(F.filter(F.array(*cands), lambda c: F.size(c["rows"]) > 0), F.lit(1))
        per_concept.append(F.struct(F.lit(concept).alias("concept"), chosen.alias("pick")))
    picked = (company_facts
              .select(*keep, F.inline_outer(F.array(*per_concept)))
              .filter(F.col("pick").isNotNull()))
    rows = picked.select(*keep, "concept", F.col("pick.tag").alias("tag_used"),
                         F.col("pick.unit").alias("unit"),
                         F.posexplode_outer("pick.rows").alias("row_ord", "r")) \
        .filter(F.col("r").isNotNull())
    return rows.select(
        *keep, "concept", "tag_used", F.col("r.val").alias("value"), "unit",
        F.col("r.start").alias("start"), F.col("r.end").alias("end"),
        F.col("r.fy").alias("fiscal_year"), F.col("r.fp").alias("fiscal_period"),
        F.col("r.form").alias("form"), F.col("r.filed").alias("filed_date"),
        F.col("r.accn").alias("accession_number"), F.col("r.frame").alias("frame"), "row_ord")


def uncovered_concepts(tidy: DataFrame, concepts: Sequence[str], entity_col: str = "cik",
                       concept_col: str = "concept", entities: DataFrame | None = None) -> DataFrame:
    """(entity, concept) for every curated concept an entity has no fact for.

    Per entity the set of concepts present (bounded by the curated list) is
    subtracted from the fixed list; no entity x concept pairing is built.
    ``entities`` lists the entities asked for, so that one without any fact is
    reported with every concept; without it only entities with facts appear.
    """
    wanted = F.array(*[F.lit(c) for c in concepts])
    have = tidy.groupBy(entity_col).agg(F.collect_set(concept_col).alias("_have"))
    if entities is not None:
        have = entities.select(entity_col).distinct().join(have, entity_col, "left")
    missing = F.array_except(wanted, F.coalesce(F.col("_have"), F.array().cast("array<string>")))
    return have.select(entity_col, F.explode(missing).alias(concept_col))


def tag_fallback(facts: DataFrame, dim: DataFrame, entity_cols: Sequence[str],
                 tag_col: str = "tag", concept_col: str = "concept",
                 priority_col: str = "priority") -> DataFrame:
    """Tag fallback on already-flat facts (A1).

    ``dim`` is ``(concept, priority, tag)``, normally the small curated map:
    the planner broadcasts it when its measured size is under the broadcast
    threshold (AQE re-checks at runtime), else shuffles. Per (entity,
    concept) the lowest priority with any row wins;
    it is a partial aggregate joined back by a semi join (AQE splits a skewed
    entity's partition; no window holds one entity in one task).
    """
    tagged = facts.join(dim.select(F.col(tag_col), F.col(concept_col), F.col(priority_col)),
                        tag_col, "inner")
    keys = list(entity_cols) + [concept_col]
    chosen = tagged.groupBy(*keys).agg(F.min(priority_col).alias(priority_col))
    return tagged.join(chosen, keys + [priority_col], "left_semi")


def derived_ratio(facts: DataFrame, keys: Sequence[str], numerator: str = "gross_profit",
                  denominator: str = "revenue", concept_col: str = "concept",
                  value_col: str = "value", scale: float = 100.0, digits: int = 2,
                  out_col: str = "ratio", carry: Sequence[str] = (),
                  order: Sequence[str] = ()) -> DataFrame:
    """numerator / denominator x scale per key, both sides required.

    One shuffle: a conditional aggregate over the two concepts instead of a
    self join, so N rows on one side and M on the other never become N x M
    pairs. Several rows of one side under one key are versions of one value:
    the one with the greatest (``order`` columns, value) counts, never their
    sum. A zero denominator gives NULL (no inf, no error). ``carry`` columns
    keep their greatest non-NULL value over the key's rows.
    """
    c, v = F.col(concept_col), F.col(value_col)
    version = F.struct(*order, v.alias("v"))
    g = (facts.filter(c.isin(numerator, denominator))
         .groupBy(*keys)
         .agg(*[F.max(x).alias(x) for x in carry],
              F.max(F.when((c == numerator) & v.isNotNull(), version))["v"].alias("num_value"),
              F.max(F.when((c == denominator) & v.isNotNull(), version))["v"].alias("den_value"),
              F.count(F.when(c == numerator, 1)).alias("_n"),
              F.count(F.when(c == denominator, 1)).alias("_d"))
         .filter((F.col("_n") > 0) & (F.col("_d") > 0))
         .drop("_n", "_d"))
    return g.withColumn(out_col, F.round(F.try_divide(F.col("num_value"), F.col("den_value"))
                                         * F.lit(scale), digits))


def gross_margin(facts: DataFrame, entity_cols: Sequence[str] = ("cik",),
                 inherit_period: bool = False) -> DataFrame:
    """Derived ``gross_margin_pct`` fact rows, one per filing period.

    The key includes ``start`` (strict): a 3-month and a year-to-date value
    ending the same day stay apart instead of being paired crosswise.
    Fiscal year and period are NULL as in the reference, or, with
    ``inherit_period``, taken from the filing's own rows (T8).
    """
    keys = list(entity_cols) + ["start", "end", "form", "accession_number"]
    carry = ["fiscal_year", "fiscal_period"] if inherit_period else []
    order = ["filed_date"] if "filed_date" in facts.columns else []
    r = derived_ratio(facts, keys, out_col="value", carry=carry, order=order)
    fy = F.col("fiscal_year").cast("int") if inherit_period else F.lit(None).cast("int")
    fp = F.col("fiscal_period") if inherit_period else F.lit(None).cast("string")
    return r.select(*entity_cols, F.lit(DERIVED_CONCEPT).alias("concept"),
                    F.lit(DERIVED_TAG).alias("tag_used"), "value",
                    F.lit(DERIVED_UNIT).alias("unit"), "start", "end",
                    fy.alias("fiscal_year"), fp.alias("fiscal_period"), "form",
                    F.lit(None).cast("string").alias("filed_date"), "accession_number",
                    F.lit(None).cast("string").alias("frame"))


def with_derived(facts: DataFrame, entity_cols: Sequence[str] = ("cik",),
                 inherit_period: bool = False) -> DataFrame:
    """Facts plus their derived rows, appended once."""
    return facts.unionByName(gross_margin(facts, entity_cols, inherit_period),
                             allowMissingColumns=True)


def duration_bucket(start: Column, end: Column) -> Column:
    """Period length class: instant, Q (~3 months), H, 9M, FY."""
    days = F.datediff(F.to_date(end), F.to_date(start))
    return (F.when(start.isNull(), "instant").when(days < 120, "Q").when(days < 210, "H")
            .when(days < 300, "9M").otherwise("FY"))


def yoy_growth(df: DataFrame, series: Sequence[str], period_col: str, value_col: str,
               step: int = 1, digits: int = 4) -> DataFrame:
    """Growth over the period ``step`` before (G1), guarded by an exact gap.

    ``df`` holds one value per (series, period), a number. A range frame over the
    series holds that one earlier period or nothing, so ``df`` is read once, no pairs
    are built and a missing period gives NULL instead of a wrong lag.
    """
    period = F.col(period_col)
    before = Window.partitionBy(*series).orderBy(period).rangeBetween(-step, -step)
    out = df.withColumn("prev_value", F.when(period.isNotNull(), F.last(value_col).over(before)))
    growth = F.try_divide(F.col(value_col) - F.col("prev_value"), F.col("prev_value"))
    return out.withColumn("growth_pct", F.round(growth * F.lit(100.0), digits))


def fact_yoy(stored: DataFrame, entity_col: str = "cik", days: tuple[int, int] = (350, 380)) -> DataFrame:
    """Year-over-year growth on stored facts (period dates as DATE).

    Series: (entity, concept, duration bucket), the newest filing of each
    period end. The prior value is the latest whose period ended 350 to 380
    days before, so 52/53-week years and month ends of other lengths meet; a
    range frame over the series finds it in one pass, a missing year gives NULL.
    """
    from tallystone.operators.store import latest_by_key
    f = stored.withColumn("bucket", duration_bucket(F.col("period_start"), F.col("period_end")))
    series = [entity_col, "concept", "bucket"]
    one = latest_by_key(f.select(*series, "period_end", "value", "filed_date", "accession_number"),
                        [*series, "period_end"], ["filed_date", "accession_number"])
    day = F.datediff("period_end", F.lit("1970-01-01").cast("date"))
    year_ago = Window.partitionBy(*series).orderBy(day).rangeBetween(-days[1], -days[0])
    out = one.withColumn("prev_value", F.last("value").over(year_ago))
    growth = F.try_divide(F.col("value") - F.col("prev_value"), F.col("prev_value"))
    return out.withColumn("growth_pct", F.round(growth * F.lit(100.0), 4))


def facts_to_store(company_facts: DataFrame, tickers: DataFrame | None = None,
                   concept_tags: dict | None = None, inherit_period: bool = False,
                   load_seq: int = 0) -> DataFrame:
    """Company-facts documents -> rows of the fact store (the numeric flow).

    In-row tag fallback per concept, derived ratio rows appended once, then
    the store's columns: CIK zero-padded, ticker upper-cased (from
    ``tickers`` = (cik, ticker) when given, else the CIK itself), company name
    falling back to the ticker, dates parsed leniently, ``frame`` dropped.
    """
    from tallystone.functions.ids import normalize_cik
    from tallystone.sources.filings import stored_fact_rows

    tidy = tag_fallback_doc(company_facts, concept_tags)
    # the document's own position; of derived rows the latest start (shortest period) comes last
    tidy = with_derived(tidy, ("cik", "entityName"), inherit_period)
    days = F.datediff(F.try_to_date(F.col("start")), F.lit("1900-01-01").cast("date"))
    tidy = tidy.withColumn("row_ord", F.coalesce(F.col("row_ord"), days, F.lit(-1)).cast("bigint"))
    if tickers is not None:
        t = tickers.groupBy("cik").agg(F.min("ticker").alias("ticker"))
        tidy = tidy.join(t, "cik", "left")
    else:
        tidy = tidy.withColumn("ticker", F.lit(None).cast("string"))
    cik = normalize_cik(F.col("cik"))
    ticker = F.upper(F.coalesce(F.col("ticker"), cik))
    out = (tidy.withColumn("ticker", ticker).withColumn("cik", cik)
           .withColumn("company_name", F.coalesce(F.col("entityName"), F.col("ticker")))
           .withColumn("fiscal_year", F.col("fiscal_year").cast("double"))
           .withColumn("load_seq", F.lit(load_seq)))
    return stored_fact_rows(out)
