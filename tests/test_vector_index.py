"""The vector index against the scan of everything."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallystone.operators import vector_index, vectors
from tallystone.session import shared_dir


def frame(spark, m, first=0):
    rows = [(first + i, f"Name {i % 7}", i % 3, [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, "id long, name string, kind int, embedding array<float>")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(3)
    means = rng.normal(size=(40, 24))
    m = means[rng.integers(0, 40, 6000)] + 0.15 * rng.normal(size=(6000, 24))
    m[5] = m[6] = m[7]                                                     # ties
    items = frame(spark, m).repartition(6).cache()
    asked = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(
        means[rng.integers(0, 40, 60)] + 0.15 * rng.normal(size=(60, 24)))], "qid long, embedding array<double>")
    path = shared_dir(spark, "index-test")
    vector_index.build_index(items, path, payload=["name", "kind"], lists=48)
    return items, asked, vector_index.Index(spark, path)


def test_exact_search_equals_the_scan_and_reads_a_part(clustered):
    items, asked, index = clustered
    stats = {}
    got = vector_index.search_index(index, asked, k=10, probes=2, stats=stats)
    assert rows(got) == rows(vectors.vector_search(items, asked, k=10, payload=["name", "kind"]))
    assert stats["lists"] == len(index.numbers) and stats["items"] == 6000
    one = asked.limit(1)
    stats = {}
    assert rows(vector_index.search_index(index, one, k=10, probes=2, stats=stats)) == rows(
        vectors.vector_search(items, one, k=10, payload=["name", "kind"]))
    assert stats["items_read"] < 0.3 * stats["items"]


def test_recall_of_the_first_lists(clustered):
    items, asked, index = clustered
    one, stats = asked.where("qid < 4"), {}
    got = vector_index.search_index(index, one, k=10, probes=4, exact=False, stats=stats)
    assert vector_index.recall(got, vectors.vector_search(items, one, k=10)) >= 0.95
    assert stats["lists_read"] <= 16 < stats["lists"]


@pytest.mark.parametrize("filters", [{"any_of": {"kind": [1, 2]}}, {"equals": {"name": "Name 3"}}, {"ilike": {"name": "E 5"}},
                                     {"equals": {"kind": 1}, "ilike": {"name": "%3"}}, {"any_of": {"kind": []}},
                                     {"equals": {"name": "none"}}])
def test_filters_are_kept(clustered, filters):
    items, asked, index = clustered
    got = vector_index.search_index(index, asked, k=5, probes=2, **filters)
    assert rows(got) == rows(vectors.vector_search(items, asked, k=5, payload=["name", "kind"], **filters))


def test_lists_that_no_query_needs_are_not_opened(clustered):
    _, _, index = clustered
    some = [int(x) for x in index.numbers[:2]]
    files = index.lists(some).inputFiles()
    plan = index.lists(some)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "list" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {int(r.f.split("list=")[1].split("/")[0]) for r in index.lists(some).select(F.input_file_name().alias("f")).distinct().collect()}
    assert read <= set(some) and files


def test_unstructured_vectors_of_mixed_length(spark):
    rng = np.random.default_rng(4)
    items = frame(spark, rng.normal(size=(800, 8)) * rng.lognormal(size=(800, 1)))
    asked = items.limit(30).select(F.col("id").alias("qid"), "embedding")
    path = shared_dir(spark, "index-test")
    vector_index.build_index(items, path, lists=10, sample=200)
    got = vector_index.search_index(vector_index.Index(spark, path), asked, k=7, probes=1)
    assert rows(got) == rows(vectors.vector_search(items, asked, k=7))


def test_odd_vectors_are_reported_not_fatal(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]),
           (None, [1.0, 1.0]), (1, [-1.0, 0.0]), (9, [1.0, None])]
    items = spark.createDataFrame(odd, "id long, embedding array<float>")
    path = shared_dir(spark, "index-test")
    vector_index.build_index(items, path, lists=3)
    index = vector_index.Index(spark, path)
    assert sorted(tuple(r) for r in spark.read.parquet(f"{path}/rejected").collect()) == [
        (3, None), (4, 0), (5, 2), (6, 2), (7, 2), (8, 3), (9, 2)]
    asked = spark.createDataFrame([(0, [1.0, 0.1]), (1, None), (2, [1.0]), (3, [0.0, 0.0])], "qid long, embedding array<double>")
    got = vector_index.search_index(index, asked, k=9, probes=1).collect()
    assert [(r[0], r[2]) for r in sorted(got, key=lambda r: r[1])] == [(0, 1), (0, None), (0, 2), (0, 1)]
    empty = shared_dir(spark, "index-test")
    vector_index.build_index(items.limit(0), empty)
    assert vector_index.search_index(vector_index.Index(spark, empty), asked).collect() == []


def test_wide_rows_reach_python_a_few_at_a_time(spark):
    """Forty packed blocks of half a megabyte came in one batch of 20 MB before."""
    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    wide = spark.range(40, numPartitions=1).select(F.expr("repeat('x', 500000)").alias("codes"))
    got = vector_index._stage(wide.mapInArrow(count, "rows long, bytes long"), "wide").collect()
    assert sum(r["rows"] for r in got) == 40 and max(r["bytes"] for r in got) < 12 << 20 and spark.conf.get(key) == before
