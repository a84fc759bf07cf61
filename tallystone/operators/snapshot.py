"""A compacted snapshot plus the loads after it.

The log of loads (``store``) stays the truth. ``compact_log`` merges the newest
snapshot with the loads after it into the next one, ``<snapshots>/upto=N``: the surviving
row of every key up to load N, with its load and position. ``current`` reads
the newest complete snapshot and the loads after N only, however long the log
has grown, and gives the rows that ranking the whole log would give, because a
survivor beats everything that its snapshot dropped. ``refresh_ratios`` keeps derived
ratios up to date from the keys that newer loads touch.

A snapshot counts once Spark has marked its folder complete, so one cut short by
a lost driver is ignored and written again. A load that is already in a
snapshot must not be rewritten; ``compact_log(whole=True)`` starts over from the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.operators.facts import derived_ratio
from tallystone.operators.store import latest_by_key, newest_order


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    """N of the complete folders ``name=N`` below ``folder``, ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}=*/_SUCCESS")) or []
    return sorted(int(x.getPath().getParent().getName().split("=")[1]) for x in found)


def loads_after(spark: SparkSession, log_dir: str, after: int | None, upto: int | None = None) -> DataFrame | None:
    """Rows of the loads after load ``after`` (to ``upto``, included), with ``load_seq``; None without any."""
    log_dir = log_dir.rstrip("/")
    loads = [n for n in _numbers(spark, log_dir, "load_seq")
             if (after is None or n > after) and (upto is None or n <= upto)]
    if not loads:
        return None
    return spark.read.option("basePath", log_dir).parquet(*[f"{log_dir}/load_seq={n}" for n in loads])


def newest_snapshot(spark: SparkSession, snapshot_dir: str) -> tuple[int | None, DataFrame | None]:
    done = _numbers(spark, snapshot_dir, "upto")
    return (done[-1], spark.read.parquet(f"{snapshot_dir.rstrip('/')}/upto={done[-1]}")) if done else (None, None)


def _merged(base: DataFrame | None, tail: DataFrame | None, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    if base is None and tail is None:
        raise ValueError("neither a snapshot nor a load")
    parts = [x for x in (base, tail) if x is not None]
    log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return log if tail is None else latest_by_key(log, keys, newest_order(log, order))


def compact_log(spark: SparkSession, log_dir: str, snapshot_dir: str, keys: Sequence[str], order: Sequence[str] = (),
                whole: bool = False) -> int:
    """Write the snapshot up to the newest load and return its number; none is written if nothing is new.

    Rows are brought together by the first key column, a key larger than a
    partition over several files. ``whole`` merges the whole log instead of the snapshot
    before.
    """
    loads = _numbers(spark, log_dir, "load_seq")
    if not loads:
        raise ValueError("no load in the log")
    before, base = (None, None) if whole else newest_snapshot(spark, snapshot_dir)
    if before is not None and before >= loads[-1]:
        return before
    merged = _merged(base, loads_after(spark, log_dir, before, loads[-1]), keys, order)
    merged.hint("rebalance", keys[0]).write.mode("overwrite").parquet(f"{snapshot_dir.rstrip('/')}/upto={loads[-1]}")
    return loads[-1]


def current(spark: SparkSession, log_dir: str, snapshot_dir: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Last write wins per key (newest load, then ``order``, then position), from the newest snapshot and the loads after it."""
    before, base = newest_snapshot(spark, snapshot_dir)
    return _merged(base, loads_after(spark, log_dir, before), keys, order)


def refresh_ratios(previous: DataFrame, facts: DataFrame, changed: DataFrame, keys: Sequence[str], **ratio) -> DataFrame:
    """Derived ratios brought up to date: ``derived_ratio`` of the current ``facts`` for the ``keys`` that occur in
    ``changed`` (rows of newer loads), the ``previous`` ones for all others. Null key parts are values like any other."""
    touched = changed.select(*[F.col(k).alias(f"_t_{k}") for k in keys]).distinct()

    def same(df: DataFrame):
        return [df[k].eqNullSafe(touched[f"_t_{k}"]) for k in keys]

    kept = previous.join(touched, same(previous), "left_anti")
    again = facts.join(touched, same(facts), "left_semi")
    return kept.unionByName(derived_ratio(again, keys, **ratio))
