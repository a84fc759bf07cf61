"""Numeric-half bindings: fact store, lookups, tag fallback, ratios, growth.

Driver tables stand in for the filing schema; the mapping is stated on each
binding. Every binding reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone.operators import lookup, store
from tallystone.plans.registry import register, table

# --- upsert_facts: lineitem as a load log, key (l_orderkey, l_linenumber),
# the last write is the greatest (l_shipdate, l_partkey, l_suppkey,
# l_extendedprice).
UPSERT_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@register("upsert_facts", sql="""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
""")
def q_upsert_facts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return store.latest_by_key(li, ["l_orderkey", "l_linenumber"], UPSERT_ORDER)


# --- latest_fact: orders; entity o_custkey, concept o_orderpriority,
# period end o_orderdate; ties by the larger o_orderkey.
@register("latest_fact", sql="""
SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority
  ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1
""")
def q_latest_fact(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return lookup.latest_fact(o, keys=["o_custkey", "o_orderpriority"],
                              order=["o_orderdate", "o_orderkey"])


# --- latest_fact_filtered: the same with every optional filter set: concept
# "1-URGENT", form "F", fiscal year and quarter of the order date, one row per customer.
@register("latest_fact_filtered", sql="""
SELECT *, year(o_orderdate)::INT AS fiscal_year, 'Q' || quarter(o_orderdate) AS fiscal_period, o_orderstatus AS form
FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1995 AND quarter(o_orderdate) = 2
  AND o_orderstatus = 'F'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1
""")
def q_latest_fact_filtered(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumns({
        "fiscal_year": F.year("o_orderdate"), "form": F.col("o_orderstatus"),
        "fiscal_period": F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string"))})
    return lookup.latest_fact(o, keys=["o_custkey"], order=["o_orderdate", "o_orderkey"], concept="1-URGENT",
                              fiscal_year=1995, fiscal_period="Q2", form="F", concept_col="o_orderpriority")


# --- fact_history: every (customer, priority) series of orders, oldest first;
# NULL dates last.
@register("fact_history", sql="""
SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey, o_totalprice, o_orderstatus
FROM orders
""")
def q_fact_history(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    h = lookup.fact_history(o, order=["o_orderdate", "o_orderkey"],
                            series=["o_custkey", "o_orderpriority"])
    return h.select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey",
                    "o_totalprice", "o_orderstatus")


# --- compare_concept: every customer is requested (ord = 2 * custkey), the
# BUILDING segment a second time (ord = 2 * custkey + 1); customers without
# orders drop out. Newest order per requested customer and priority.
def _requests(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    first = c.select((F.col("c_custkey") * 2).alias("ord"), F.col("c_custkey").alias("o_custkey"))
    again = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        (F.col("c_custkey") * 2 + 1).alias("ord"), F.col("c_custkey").alias("o_custkey"))
    return first.unionByName(again)


@register("compare_concept", sql="""
WITH req AS (
  SELECT c_custkey * 2 AS ord, c_custkey AS o_custkey FROM customer
  UNION ALL
  SELECT c_custkey * 2 + 1, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'),
newest AS (
  SELECT * FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority
    ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1)
SELECT req.ord, newest.* FROM req JOIN newest USING (o_custkey)
""")
def q_compare_concept(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return lookup.compare_concept(o, _requests(spark, sf_dir), key_col="o_custkey",
                                  order=["o_orderdate", "o_orderkey"], per=["o_orderpriority"])


# --- concept_coverage: events per event type of a curated type list that
# includes a type with no data ('refund').
COVERAGE_TYPES = ["click", "purchase", "refund", "signup", "view"]


@register("concept_coverage", sql="""
WITH dim(event_type) AS (VALUES ('click'), ('purchase'), ('refund'), ('signup'), ('view')),
agg AS (SELECT event_type, count(*) AS n_rows, count(DISTINCT user_id) AS n_distinct
        FROM events GROUP BY event_type)
SELECT dim.event_type, coalesce(agg.n_rows, 0)::BIGINT AS n_rows,
       coalesce(agg.n_distinct, 0)::BIGINT AS n_distinct,
       coalesce(agg.n_rows, 0) > 0 AS covered
FROM dim LEFT JOIN agg USING (event_type)
""")
def q_concept_coverage(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    dim = spark.createDataFrame([(t,) for t in COVERAGE_TYPES], "event_type string")
    return lookup.concept_coverage(ev, dim, concept_col="event_type", distinct_col="user_id")


# --- tag_fallback: orders; the "tag" is o_orderpriority, all five in
# priority order as candidates of one concept; entity o_custkey.
FALLBACK_TAGS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("tag_fallback", sql="""
WITH d(o_orderpriority, concept, priority) AS (VALUES ('1-URGENT', 'c', 0), ('2-HIGH', 'c', 1),
  ('3-MEDIUM', 'c', 2), ('4-NOT SPECIFIED', 'c', 3), ('5-LOW', 'c', 4)),
f AS (SELECT o.*, d.concept, d.priority FROM orders o JOIN d USING (o_orderpriority))
SELECT * FROM f QUALIFY priority = min(priority) OVER (PARTITION BY o_custkey, concept)
""")
def q_tag_fallback(spark, sf_dir):
    from tallystone.operators.facts import tag_fallback
    o = table(spark, sf_dir, "orders")
    dim = spark.createDataFrame([("c", i, t) for i, t in enumerate(FALLBACK_TAGS)],
                                "concept string, priority int, o_orderpriority string")
    return tag_fallback(o, dim, ["o_custkey"], tag_col="o_orderpriority")


# --- derived_ratio: events per (user, day): the last purchase's value over
# the last view's x 100, 2 places; both sides required, a zero view gives NULL.
@register("derived_ratio", sql="""
SELECT user_id, day, round(num_value, 2) AS num_value, round(den_value, 2) AS den_value,
       round(num_value / nullif(den_value, 0) * 100.0, 2) AS ratio
FROM (SELECT user_id, CAST(ts AS DATE) AS day,
             arg_max(value, {'ts': ts, 'v': value}) FILTER (WHERE event_type = 'purchase') AS num_value,
             arg_max(value, {'ts': ts, 'v': value}) FILTER (WHERE event_type = 'view') AS den_value,
             count(CASE WHEN event_type = 'purchase' THEN 1 END) AS n_num,
             count(CASE WHEN event_type = 'view' THEN 1 END) AS n_den
      FROM events WHERE event_type IN ('purchase', 'view')
      GROUP BY user_id, CAST(ts AS DATE))
WHERE n_num > 0 AND n_den > 0
""")
def q_derived_ratio(spark, sf_dir):
    from tallystone.operators.facts import derived_ratio
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    r = derived_ratio(ev, ["user_id", "day"], numerator="purchase", denominator="view",
                      concept_col="event_type", order=["ts"])
    return r.withColumn("num_value", F.round("num_value", 2)).withColumn("den_value", F.round("den_value", 2))


# --- yoy_growth: lineitem revenue per return flag and ship year; growth over
# the previous year only when that exact year exists.
@register("yoy_growth", sql="""
WITH y AS (SELECT l_returnflag, year(l_shipdate) AS year,
                  round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
           FROM lineitem GROUP BY l_returnflag, year(l_shipdate))
SELECT c.l_returnflag, c.year, c.revenue, p.revenue AS prev_value,
       round((c.revenue - p.revenue) / nullif(p.revenue, 0) * 100.0, 4) AS growth_pct
FROM y c LEFT JOIN y p ON p.l_returnflag = c.l_returnflag AND p.year = c.year - 1
""")
def q_yoy_growth(spark, sf_dir):
    from tallystone.operators.facts import yoy_growth
    li = table(spark, sf_dir, "lineitem")
    y = (li.groupBy("l_returnflag", F.year("l_shipdate").alias("year"))
         .agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue")))
    return yoy_growth(y, ["l_returnflag"], "year", "revenue")


# --- fact_yoy: store rows from orders (entity o_custkey, concept priority,
# a period of 90, 180 or 364 days ending on the order date, filed 30 days
# later); growth of each value over the latest that ended 350 to 380 days
# before in the same duration bucket, the newest filing per period end.
@register("fact_yoy", sql="""
WITH f AS (
  SELECT o_custkey AS cik, o_orderpriority AS concept,
         CASE o_orderkey % 3 WHEN 0 THEN 'Q' WHEN 1 THEN 'H' ELSE 'FY' END AS bucket,
         o_orderdate::DATE AS period_end, o_totalprice AS value,
         (o_orderdate + INTERVAL 30 DAY)::DATE AS filed_date, o_orderkey AS accession_number
  FROM orders),
one AS (SELECT *, datediff('day', DATE '1970-01-01', period_end) AS day FROM f
        QUALIFY row_number() OVER (PARTITION BY cik, concept, bucket, period_end
          ORDER BY filed_date DESC NULLS LAST, accession_number DESC) = 1),
g AS (SELECT *, last_value(value) OVER (PARTITION BY cik, concept, bucket ORDER BY day
                  RANGE BETWEEN 380 PRECEDING AND 350 PRECEDING) AS prev_value FROM one)
SELECT cik, concept, bucket, period_end, value, prev_value,
       round((value - prev_value) / nullif(prev_value, 0) * 100.0, 4) AS growth_pct
FROM g
""")
def q_fact_yoy(spark, sf_dir):
    from tallystone.operators.facts import fact_yoy
    o = table(spark, sf_dir, "orders")
    end = F.to_date("o_orderdate")
    long = F.element_at(F.array(F.lit(90), F.lit(180), F.lit(364)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    stored = o.select(F.col("o_custkey").alias("cik"), F.col("o_orderpriority").alias("concept"),
                      F.date_sub(end, long).alias("period_start"), end.alias("period_end"),
                      F.col("o_totalprice").alias("value"), F.date_add(end, 30).alias("filed_date"),
                      F.col("o_orderkey").alias("accession_number"))
    return fact_yoy(stored).select("cik", "concept", "bucket", "period_end", "value",
                                   "prev_value", "growth_pct")


# --- uncovered_concepts: for every customer, with orders or without, the
# priorities (of all five) it never used.
@register("uncovered_concepts", sql="""
WITH e AS (SELECT c_custkey AS o_custkey FROM customer),
d(concept) AS (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')),
h AS (SELECT DISTINCT o_custkey, o_orderpriority AS concept FROM orders)
SELECT e.o_custkey, d.concept FROM e, d
WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.o_custkey = e.o_custkey AND h.concept = d.concept)
""")
def q_uncovered_concepts(spark, sf_dir):
    from tallystone.operators.facts import uncovered_concepts
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderpriority").alias("concept"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return uncovered_concepts(o, FALLBACK_TAGS, entity_col="o_custkey", entities=customers)
