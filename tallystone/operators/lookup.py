"""Point, history, cross-entity and coverage lookups over a fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.operators.store import latest_by_key

# Total order for "newest" (T7): period end, then filing date, accession,
# and the later start (the shorter period) on equal ends.
FACT_NEWEST = ["period_end", "filed_date", "accession_number", "period_start"]


def filter_facts(facts: DataFrame, ticker: str | None = None, concept: str | None = None,
                 fiscal_year: int | None = None, fiscal_period: str | None = None,
                 form: str | None = None, ticker_col: str = "ticker",
                 concept_col: str = "concept") -> DataFrame:
    """Optional equality filters (P6); each reaches the Parquet scan."""
    out = facts
    if ticker is not None:
        out = out.filter(F.col(ticker_col) == F.lit(ticker.upper()))
    if concept is not None:
        out = out.filter(F.col(concept_col) == F.lit(concept))
    if fiscal_year is not None:
        out = out.filter(F.col("fiscal_year") == F.lit(int(fiscal_year)))
    if fiscal_period is not None:
        out = out.filter(F.col("fiscal_period") == F.lit(fiscal_period))
    if form is not None:
        out = out.filter(F.col("form") == F.lit(form))
    return out


def latest_fact(facts: DataFrame, keys: Sequence[str] | None = None,
                order: Sequence[str | Column] = FACT_NEWEST, **filters) -> DataFrame:
    """Newest fact (A4).

    With ``keys``: one newest row per key (``latest_by_key``: a per-task
    limit before the shuffle; NULL order values never win). Without: the
    single newest row of the
    filtered table (``TakeOrderedAndProject``: per-task top-1, then merge).
    """
    f = filter_facts(facts, **filters)
    if keys:
        return latest_by_key(f, list(keys), order)
    sort = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order]
    return f.orderBy(*sort).limit(1)


def fact_history(facts: DataFrame, order: Sequence[str] = ("period_end",),
                 series: Sequence[str] = (), **filters) -> DataFrame:
    """All facts of the filtered series, oldest first (O2), NULL ends last.

    A global ``orderBy`` is range-partitioned on the whole sort key, so even
    one huge series is split across many tasks.
    """
    f = filter_facts(facts, **filters)
    sort = [F.col(c).asc_nulls_last() for c in list(series) + list(order)]
    return f.orderBy(*sort)


def compare_concept(facts: DataFrame, requests: DataFrame, key_col: str = "ticker",
                    ord_col: str = "ord", order: Sequence[str | Column] = FACT_NEWEST,
                    per: Sequence[str] = (), **filters) -> DataFrame:
    """Newest fact for each requested entity, in request order (A5).

    ``requests`` is ``(ord, key)``; repeated keys repeat, unknown keys drop.
    ``per`` adds grouping columns (e.g. the concept, to compare every concept
    at once). Text keys are compared in upper case, as tickers are stored.
    Only facts of requested entities are ranked (semi join first), then one
    join with the request list replaces per-entity round trips.
    """
    asked = requests.select(ord_col, key_col)
    if asked.schema[key_col].dataType.simpleString() == "string":
        asked = asked.withColumn(key_col, F.upper(key_col))
    wanted = filter_facts(facts, **filters).join(asked.select(key_col).distinct(), key_col, "left_semi")
    newest = latest_by_key(wanted, [key_col, *per], order)
    return asked.join(newest, key_col, "inner").orderBy(ord_col)


def concept_coverage(facts: DataFrame, dim: DataFrame, concept_col: str = "concept",
                     distinct_col: str | None = None) -> DataFrame:
    """Rows (and optionally distinct values) per concept of ``dim``.

    Concepts without data appear with count 0. The fact side is aggregated
    first (partial aggregation), then joined to the small dimension.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if distinct_col:
        aggs.append(F.countDistinct(distinct_col).alias("n_distinct"))
    counted = facts.groupBy(concept_col).agg(*aggs)
    out = dim.join(counted, concept_col, "left")
    out = out.withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("bigint"))
    if distinct_col:
        out = out.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)).cast("bigint"))
    return out.withColumn("covered", F.col("n_rows") > 0)


def concept_list(facts: DataFrame, concept_col: str = "concept") -> DataFrame:
    """Sorted distinct concepts."""
    return facts.select(concept_col).distinct().orderBy(concept_col)


def order_tidy(tidy: DataFrame) -> DataFrame:
    """Readable order of a tidy fact table (O1): concept, end, filed date,
    ascending with NULLs last."""
    return tidy.orderBy(*[F.col(c).asc_nulls_last() for c in ("concept", "end", "filed_date")])
