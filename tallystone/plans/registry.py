"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. ``tallystone.input.partitions`` (a session setting, unset
    by default) deals it out anew; for inputs that are one Parquet row group."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get("tallystone.input.partitions", None)
    return df.repartition(int(n)) if n else df
