"""A persisted index for vector search (V3): inverted lists with quantised codes.

``build_index`` deals unit vectors out to the nearest of ``lists`` centres and writes
them as Parquet, one folder for each list: an 8-bit code of the difference to the centre, the
exact length of what the code loses, and the vector itself in a column of its
own, which only the last step reads. ``search_index`` answers like
``vectors.vector_search``, reading a part of the lists:

1. The ``probes`` lists with the nearest centres are scanned by their codes. A code's
   score is off by at most the lost length, so every item has a lower and an upper bound.
2. A list whose widest member cannot come as near as a query's k-th best lower bound is
   left out; the others are scanned too (``exact``, the default). Without it the
   first lists are all that is read.
3. Items whose upper bound reaches that k-th lower bound are ranked by their own vectors.

So an exact search gives the same rows as a scan of everything, whatever the centres;
how much it reads depends on how the vectors cluster (``stats``).
Filters apply before anything is ranked and reach the scan. Folders of lists that no
query needs are not opened.

Driver and tasks hold the centres: ``lists`` vectors, by parameter. Centres are
fitted to ``SAMPLE`` vectors at most, chosen by a hash of their ids; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.operators.vectors import DISTANCE_DIGITS
from tallystone.schemas import DEFAULT_TOP_K
from tallystone.session import shared_dir

#: Lists, vectors that the centres are fitted to, and items and queries of a block.
LISTS, SAMPLE, ITEM_BLOCK, QUERY_BLOCK = 256, 50_000, 4096, 256
#: Bytes that a Python worker gets at once.
BATCH = "8m"
_ROUNDING = 2.0 * 10 ** -DISTANCE_DIGITS


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1)[:, None]


def _direction(vec: str, width: int | None = None):
    """Whether a vector has a direction: not null, empty or zero, nothing null or non-finite in it (never null)."""
    v = F.col(vec).cast("array<double>")
    length = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    ok = (F.size(v) > 0) & (length > 0) & (length < float("inf"))
    return F.coalesce(ok if width is None else ok & (F.size(v) == width), F.lit(False))


def _usable(df: DataFrame, vec: str, width: int | None = None) -> DataFrame:
    return df.where(_direction(vec, width))


def build_index(items: DataFrame, path: str, id_col: str = "id", vec_col: str = "embedding", payload: Sequence[str] = (),
                lists: int = LISTS, sample: int = SAMPLE, seed: int = 7) -> None:
    """Write the index of ``items`` to ``path`` (a fresh folder on shared storage).

    The width is that of most vectors. Items of another one, and those without a
    direction (null, empty, zero, non-finite), are not indexed: ``path/rejected`` has
    their ids and widths. Repeated ids are items of their own. An empty
    table gives an empty index.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    spark = items.sparkSession
    src = items.select(F.col(id_col).alias("id"), F.struct(*[c for c in payload if c != id_col]).alias("payload")
                       if [c for c in payload if c != id_col] else F.lit(None).cast("string").alias("payload"),
                       F.col(vec_col).alias("vec"))
    widths = _usable(src, "vec").groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    width = widths[0]["w"] if widths else 0
    good = _usable(src, "vec", width)
    n = good.count()
    share = max(1, -(-n // max(1, sample)))
    tried = good.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).select(
        array_to_vector(F.col("vec").cast("array<double>")).alias("features"))
    centres = np.zeros((0, width))
    if n:
        model = KMeans(k=max(2, min(lists, n)), maxIter=10, seed=seed, distanceMeasure="cosine").fit(tried)
        centres = np.array(model.clusterCenters())
        centres = _unit(centres[np.linalg.norm(centres, axis=1) > 0])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(i, ITEM_BLOCK) for b in batches for i in range(0, b.num_rows, ITEM_BLOCK)):
            unit = _unit(_matrix(b.column("vec"), width))
            near = unit @ centres.T
            at = near.argmax(axis=1)
            rest = unit - centres[at]
            step = np.abs(rest).max(axis=1) / 127 + 1e-300
            code = np.rint(rest / step[:, None]).astype(np.int8)
            lost = np.linalg.norm(rest - code * step[:, None], axis=1) + 1e-12
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("payload"), b.column("vec"), pa.array([c.tobytes() for c in code], pa.binary()),
                 pa.array(step), pa.array(lost), pa.array(near[np.arange(len(at)), at]), pa.array(at.astype(np.int32))],
                ["id", "payload", "vec", "code", "step", "lost", "near", "list"])

    schema = T.StructType([*good.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("step", T.DoubleType()),
                           T.StructField("lost", T.DoubleType()), T.StructField("near", T.DoubleType()),
                           T.StructField("list", T.IntegerType())])
    # a rebalance splits a list that holds a large part of all rows, and keeps small ones in one file
    with _small_batches(spark):
        good.mapInArrow(encode, schema).hint("rebalance", "list").write.partitionBy("list").parquet(f"{path}/lists")
    src.where(~_direction("vec", width)).select("id", F.size("vec").alias("width")).write.parquet(f"{path}/rejected")
    where = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "list int, centre array<double>")
    if n:
        held = spark.read.schema(schema).parquet(f"{path}/lists").groupBy("list").agg(
            F.count(F.lit(1)).alias("n"), F.min("near").alias("widest"))
        where = where.join(held, "list")
    else:
        where = where.selectExpr("*", "0L AS n", "1.0D AS widest")
    where.write.parquet(f"{path}/centres")


class Index:
    """An index at ``path``, opened for searches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        rows = spark.read.parquet(f"{path}/centres").orderBy("list").collect()          # as many as lists
        self.numbers = np.array([r["list"] for r in rows], np.int32)
        self.centres = np.array([r["centre"] for r in rows], np.float64)
        self.widest = np.arccos(np.clip(np.array([r["widest"] for r in rows], np.float64), -1, 1))
        self.sizes = np.array([r["n"] for r in rows], np.int64)
        self.width = self.centres.shape[1] if len(rows) else 0

    def lists(self, numbers: Sequence[int]) -> DataFrame:
        """The items of some lists; only their folders are opened."""
        return self.spark.read.parquet(f"{self.path}/lists").where(F.col("list").isin([int(i) for i in numbers]))


def _probes(queries: DataFrame, index: Index, probes: int, reached: bool) -> DataFrame:
    """(qid, unit, list): each query's nearest ``probes`` lists, or (``reached``) all others that its ``least`` does not exclude."""
    numbers, centres, widest, width = index.numbers, index.centres, index.widest, index.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(i, QUERY_BLOCK) for b in batches for i in range(0, b.num_rows, QUERY_BLOCK)):
            unit = _unit(_matrix(b.column("vec"), width))
            near = np.clip(unit @ centres.T, -1, 1)
            first = np.zeros(near.shape, bool)
            np.put_along_axis(first, np.argsort(-near, axis=1, kind="stable")[:, :probes], True, axis=1)
            if reached:
                best = np.cos(np.maximum(0, np.arccos(near) - widest))
                least = b.column("least").to_numpy(zero_copy_only=False)[:, None]
                first = ~first & (best >= least - _ROUNDING)
            q, at = np.nonzero(first)
            rows = pa.array(q)
            flat = pa.array(unit[q].ravel())
            yield pa.RecordBatch.from_arrays(
                [b.column("qid").take(rows), pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, width, dtype=np.int32), flat),
                 pa.array(numbers[at])], ["qid", "unit", "list"])

    schema = T.StructType([queries.schema["qid"], T.StructField("unit", T.ArrayType(T.DoubleType())),
                           T.StructField("list", T.IntegerType())])
    return queries.mapInArrow(run, schema)


def _scan(index: Index, asked: DataFrame, blocks: int, keep, k: int) -> DataFrame:
    """(qid, list, id, lower, upper): bounds of the cosine of the items that may be among a query's k best of a block."""
    spark, width = index.spark, index.width
    wanted = [r["list"] for r in asked.select("list").distinct().collect()]              # at most all lists
    items = keep(index.lists(wanted)).select("list", "id", "code", "step", "lost")
    id_field = items.schema["id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(i, ITEM_BLOCK) for b in batches for i in range(0, b.num_rows, ITEM_BLOCK)):
            numbers = b.column("list").to_numpy(zero_copy_only=False)
            order = np.argsort(numbers, kind="stable")
            cuts = np.flatnonzero(np.diff(numbers[order])) + 1
            for part in np.split(order, cuts) if len(order) else ():
                p = b.take(pa.array(part))
                ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), p.column("id"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([numbers[part[0]]], pa.int32()), ids, pa.array([b"".join(p.column("code").to_pylist())], pa.binary()),
                     *[pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), p.column(c)) for c in ("step", "lost")]],
                    ["list", "ids", "codes", "step", "lost"])

    packed = items.mapInArrow(pack, T.StructType([
        T.StructField("list", T.IntegerType()), T.StructField("ids", T.ArrayType(id_field.dataType)), T.StructField("codes", T.BinaryType()),
        T.StructField("step", T.ArrayType(T.DoubleType())), T.StructField("lost", T.ArrayType(T.DoubleType()))]))
    together = asked.groupBy("list", F.pmod(F.xxhash64("qid"), F.lit(blocks)).alias("part")).agg(
        F.collect_list(F.struct("qid", "unit")).alias("asked"))
    centres = {int(n): c for n, c in zip(index.numbers, index.centres)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                number = b.column("list")[i].as_py()
                who, ids = b.column("asked")[i].values, b.column("ids")[i].values
                unit = _matrix(who.field("unit"), width)
                codes = np.frombuffer(b.column("codes")[i].as_py(), np.int8).reshape(-1, width)
                step, lost = (b.column(c)[i].values.to_numpy() for c in ("step", "lost"))
                value = (unit @ centres[number])[:, None] + (unit @ codes.T.astype(np.float64)) * step
                lower, upper = value - lost, value + lost
                least = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] > k else np.full(len(lower), -np.inf)
                q, at = np.nonzero(upper >= least[:, None] - _ROUNDING)
                yield pa.RecordBatch.from_arrays(
                    [who.field("qid").take(pa.array(q)), pa.array(np.full(len(q), number, np.int32)), ids.take(pa.array(at)),
                     pa.array(lower[q, at]), pa.array(upper[q, at])], ["qid", "list", "id", "lower", "upper"])

    out = T.StructType([asked.schema["qid"], T.StructField("list", T.IntegerType()), id_field,
                        T.StructField("lower", T.DoubleType()), T.StructField("upper", T.DoubleType())])
    found = packed.join(together, "list").select("list", "ids", "codes", "step", "lost", "asked").mapInArrow(score, out)
    return _stage(found, "index-scores")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile gives Python ``BATCH`` bytes at a time: a packed block with its queries is one wide row."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, BATCH)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _stage(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    with _small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _least(scores: DataFrame, k: int) -> DataFrame:
    """(qid, least): the k-th best lower bound of queries that have so many items."""
    w = Window.partitionBy("qid").orderBy(F.desc("lower"))
    return (scores.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).where(F.col("_n") == k)
            .select("qid", F.col("lower").alias("least")))


def search_index(index: Index, queries: DataFrame, k: int = DEFAULT_TOP_K, qid_col: str = "qid", qvec_col: str = "embedding",
                 probes: int = 8, exact: bool = True, any_of: dict[str, Sequence] | None = None, equals: dict | None = None,
                 ilike: dict[str, str] | None = None, stats: dict | None = None) -> DataFrame:
    """Cosine top-k of the indexed items: qid, rank, id, payload fields, distance (rounded to 6 places; ties by id).

    ``any_of``, ``equals`` and ``ilike`` filter on payload fields (or ``id``) as in ``vector_search``.
    ``exact=False`` reads the first ``probes`` lists only. Queries that are null, zero,
    non-finite or of another width have no rows. ``stats`` receives the lists and items read.
    """
    if k < 1 or probes < 1:
        raise ValueError("k and probes must be >= 1")

    def field(c: str):
        return F.col(c) if c == "id" else F.col(f"payload.{c}")

    def keep(df: DataFrame) -> DataFrame:
        for c, values in (any_of or {}).items():
            df = df.where(field(c).isin(list(values))) if values else df
        for c, v in (equals or {}).items():
            df = df.where(field(c) == F.lit(v))
        for c, part in (ilike or {}).items():
            df = df.where(field(c).ilike(f"%{part}%"))
        return df

    qs = _stage(_usable(queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).alias("vec")), "vec", index.width or -1)
                .distinct(), "index-queries")
    blocks = max(1, -(-qs.count() // QUERY_BLOCK))
    if not index.width:
        fields = [T.StructField(qid_col, qs.schema["qid"].dataType), T.StructField("rank", T.IntegerType()),
                  T.StructField("distance", T.DoubleType())]
        return index.spark.createDataFrame([], T.StructType(fields))
    asked = _stage(_probes(qs, index, probes, False), "index-probes")
    scores = _scan(index, asked, blocks, keep, k)
    read = asked.select("list")
    if exact:
        known = qs.join(_least(scores, k), "qid", "left").fillna({"least": -2.0})
        more = _stage(_probes(known, index, probes, True), "index-probes")
        if not more.isEmpty():
            scores = scores.unionByName(_scan(index, more, blocks, keep, k))
            read = read.unionByName(more.select("list"))
    lists = [r["list"] for r in read.distinct().collect()]                               # at most all lists
    if stats is not None:
        here = np.isin(index.numbers, lists)
        stats |= {"lists": len(index.numbers), "lists_read": int(here.sum()), "items": int(index.sizes.sum()),
                  "items_read": int(index.sizes[here].sum())}
    close = _stage(scores.join(_least(scores, k), "qid", "left")
                   .where(F.col("least").isNull() | (F.col("upper") >= F.col("least") - _ROUNDING))
                   .select("qid", "list", "id").distinct(), "index-close")
    held = keep(index.lists(lists)).select("list", "id", "payload", F.col("vec"))
    close = close.select("qid", F.col("list").alias("_list"), F.col("id").alias("_id"))
    same = (F.col("list") == F.col("_list")) & F.col("id").eqNullSafe(F.col("_id"))      # null is an id like any other
    pairs = held.join(close, same).join(qs.withColumnRenamed("vec", "qvec"), "qid")
    width, fields = index.width, [f.name for f in held.schema["payload"].dataType.fields] \
        if isinstance(held.schema["payload"].dataType, T.StructType) else []

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(i, ITEM_BLOCK) for b in batches for i in range(0, b.num_rows, ITEM_BLOCK)):
            cos = np.einsum("ij,ij->i", _unit(_matrix(b.column("vec"), width)), _unit(_matrix(b.column("qvec"), width)))
            yield pa.RecordBatch.from_arrays(
                [b.column("qid"), b.column("id"), b.column("payload"),
                 pa.array(np.rint((1.0 - cos) * 10 ** DISTANCE_DIGITS) / 10 ** DISTANCE_DIGITS)], ["qid", "id", "payload", "distance"])

    near = pairs.select("qid", "id", "payload", "vec", "qvec").mapInArrow(rank, T.StructType(
        [qs.schema["qid"], held.schema["id"], held.schema["payload"], T.StructField("distance", T.DoubleType())]))
    by = Window.partitionBy("qid").orderBy("distance", "id")
    return (near.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select(F.col("qid").alias(qid_col), "rank", "id", *[F.col(f"payload.{f}").alias(f) for f in fields], "distance"))


def recall(found: DataFrame, exact: DataFrame, qid_col: str = "qid", id_col: str = "id") -> float:
    """The part of the exact result's rows that were found; 1 if there are none."""
    hit = exact.select(qid_col, id_col).join(found.select(qid_col, id_col).withColumn("_hit", F.lit(1)), [qid_col, id_col], "left")
    return float(hit.agg(F.avg(F.coalesce("_hit", F.lit(0)))).first()[0] or 0.0) if not exact.isEmpty() else 1.0
