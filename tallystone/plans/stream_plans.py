"""Streaming binding: incremental loads of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystone.operators import snapshot
from tallystone.operators.facts import derived_ratio
from tallystone.operators.store import append_load
from tallystone.plans.registry import register, table
from tallystone.session import shared_dir
from tallystone.streaming.incremental import current_view, run_incremental_load

# --- incremental_load: events arrive in two drops (morning events, then
# afternoon events); each drop is loaded by its own availableNow run, and a
# third run finds nothing new. Current state: last write per (user,
# event_type), a later load winning over an earlier one, then newest ts.
@register("incremental_load", sql="""
SELECT user_id, event_type, event_id, ts, value, props,
       CASE WHEN hour(ts) < 12 THEN 0 ELSE 1 END AS load_seq
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY CASE WHEN hour(ts) < 12 THEN 0 ELSE 1 END DESC, ts DESC, event_id DESC) = 1
""")
def q_incremental_load(spark, sf_dir):
    base = shared_dir(spark, "incremental")
    ev = table(spark, sf_dir, "events")
    landing, log, ckpt = f"{base}/landing", f"{base}/log", f"{base}/checkpoint"
    morning = F.hour("ts") < 12
    ev.filter(morning).write.mode("overwrite").parquet(f"{landing}/drop=0")
    run_incremental_load(spark, landing, log, ckpt, ev.schema, timeout_s=600)
    ev.filter(~morning).write.mode("overwrite").parquet(f"{landing}/drop=1")
    run_incremental_load(spark, landing, log, ckpt, ev.schema, timeout_s=600)
    run_incremental_load(spark, landing, log, ckpt, ev.schema, timeout_s=600)   # nothing new
    cur = current_view(spark, log, ["user_id", "event_type"], order=["ts", "event_id"])
    return cur.select("user_id", "event_type", "event_id", "ts", "value", "props",
                      F.col("load_seq").cast("int").alias("load_seq"))


# --- snapshot_view: events arrive in three drops (by thirds of the day); after the
# second load a snapshot is written, and the answer is read from it and the third load.
_THIRDS = "CASE WHEN hour(ts) < 8 THEN 0 WHEN hour(ts) < 16 THEN 1 ELSE 2 END"


def _three_loads(spark, sf_dir, keys, order):
    """(log, snapshots) of the events; the snapshot holds the first two loads."""
    base = shared_dir(spark, "snapshot")
    ev = table(spark, sf_dir, "events").withColumn("third", F.expr(_THIRDS))
    log, snaps = f"{base}/log", f"{base}/snapshots"
    for n in (0, 1):
        append_load(ev.where(F.col("third") == n).drop("third"), log, n)
    snapshot.compact_log(spark, log, snaps, keys, order)
    append_load(ev.where("third = 2").drop("third"), log, 2)
    return log, snaps


@register("snapshot_view", sql=f"""
SELECT user_id, event_type, event_id, ts, value, props, {_THIRDS} AS load_seq FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY {_THIRDS} DESC, ts DESC, event_id DESC) = 1
""")
def q_snapshot_view(spark, sf_dir):
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    log, snaps = _three_loads(spark, sf_dir, keys, order)
    cur = current_view(spark, log, keys, order, snapshot_dir=snaps)
    return cur.select("user_id", "event_type", "event_id", "ts", "value", "props", F.col("load_seq").cast("int").alias("load_seq"))


# --- ratio_upkeep: last purchase over last view per user, kept from the first two loads and
# brought up to date for the users of the third.
@register("ratio_upkeep", sql=f"""
WITH c AS (SELECT * FROM events WHERE event_type IN ('purchase', 'view')
           QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY {_THIRDS} DESC, ts DESC, event_id DESC) = 1),
p AS (SELECT user_id, max(value) FILTER (event_type = 'purchase') AS n, max(value) FILTER (event_type = 'view') AS d,
             count(*) AS c FROM c GROUP BY user_id)
SELECT user_id, round(n, 2) AS num_value, round(d, 2) AS den_value, round(n / nullif(d, 0) * 100.0, 2) AS ratio
FROM p WHERE c = 2
""")
def q_ratio_upkeep(spark, sf_dir):
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    ratio = {"numerator": "purchase", "denominator": "view", "concept_col": "event_type"}
    log, snaps = _three_loads(spark, sf_dir, keys, order)
    upto, base = snapshot.newest_snapshot(spark, snaps)
    kept = derived_ratio(base, ["user_id"], **ratio)
    out = snapshot.refresh_ratios(kept, current_view(spark, log, keys, order, snapshot_dir=snaps),
                                  snapshot.loads_after(spark, log, upto), ["user_id"], **ratio)
    return out.withColumn("num_value", F.round("num_value", 2)).withColumn("den_value", F.round("den_value", 2))


# --- incremental_chunks: every document lands as text, then the English
# documents land again amended (" Amendment No. 1." appended); each drop is
# one availableNow run of the chunk pipeline, and the amended documents'
# chunks replace their earlier ones. No document has an "Item N." header, so
# each is one "Full Document" section cut into 500/50 windows.
@register("incremental_chunks", sql="""
WITH v AS (SELECT doc_id, CASE WHEN lang = 'en' THEN text || ' Amendment No. 1.' ELSE text END AS text,
                  CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS load_seq FROM documents),
t AS (SELECT doc_id, load_seq, list_filter(regexp_split_to_array(text, '[\\t\\n\\x{0B}\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'), lambda x: x <> '') AS toks FROM v),
w AS (SELECT *, CASE WHEN len(toks) = 0 THEN 0
                     ELSE greatest(0, ceil((len(toks) - 500) / 450.0))::BIGINT + 1 END AS nwin FROM t),
i AS (SELECT doc_id, load_seq, toks, unnest(range(nwin)) AS wi FROM w)
SELECT doc_id, wi::INT AS chunk_index, 'Full Document' AS section,
       array_to_string(toks[wi * 450 + 1 : wi * 450 + 500], ' ') AS chunk_text,
       len(toks[wi * 450 + 1 : wi * 450 + 500])::INT AS n_tokens, load_seq
FROM i
""")
def q_incremental_chunks(spark, sf_dir):
    from tallystone.streaming.incremental import current_chunks, run_incremental_chunks
    base = shared_dir(spark, "incremental-chunks")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    landing, log, ckpt = f"{base}/landing", f"{base}/log", f"{base}/checkpoint"
    docs.write.mode("overwrite").parquet(f"{landing}/drop=0")
    run_incremental_chunks(spark, landing, log, ckpt, docs.schema, ["doc_id"], timeout_s=900)
    amended = docs.filter(F.col("lang") == "en").withColumn(
        "text", F.concat("text", F.lit(" Amendment No. 1.")))
    amended.write.mode("overwrite").parquet(f"{landing}/drop=1")
    run_incremental_chunks(spark, landing, log, ckpt, docs.schema, ["doc_id"], timeout_s=900)
    cur = current_chunks(spark, log, "doc_id")
    return cur.select("doc_id", "chunk_index", "section", "chunk_text", "n_tokens",
                      F.col("load_seq").cast("int").alias("load_seq"))
