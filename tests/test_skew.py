"""A key holding a third of all rows must not change results or plans."""

from pyspark.sql import functions as F

from tallystone.operators import facts as fo
from tallystone.operators import store


def hot(spark, n=30000):
    # key 0 holds a third of the rows; the rest are spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("v"), (F.col("id") % 5).alias("tag")).repartition(8)


def test_latest_hot_key(spark):
    df = hot(spark)
    got = {r.k: r.v for r in store.latest_by_key(df, ["k"], ["v"]).collect()}
    exp = {r.k: r.m for r in df.groupBy("k").agg(F.max("v").alias("m")).collect()}
    assert got == exp
    plan = store.latest_by_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    # a partial per-task limit exists (it runs below the shuffle on k)
    limits = [ln for ln in plan.splitlines() if "WindowGroupLimit" in ln]
    assert any("Partial" in ln for ln in limits) and any("Final" in ln for ln in limits)


def test_fallback_hot_entity(spark):
    df = hot(spark).withColumn("tag", F.col("tag").cast("string"))
    dim = spark.createDataFrame([("c", 0, "3"), ("c", 1, "1")], "concept string, priority int, tag string")
    out = fo.tag_fallback(df, dim, ["k"])
    got = out.groupBy("k").agg(F.collect_set("tag").alias("t")).collect()
    assert all(r.t == ["3"] for r in got if r.k == 0)
    assert out.filter(F.col("k") == 0).count() == df.filter((F.col("k") == 0) & (F.col("tag") == "3")).count()
