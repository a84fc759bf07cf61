"""Safe re-runs on new files (G5): file stream -> idempotent log -> current view.

Each run is ``availableNow``: it picks up every file that arrived since the
last run (the checkpoint remembers the files already taken, exactly once),
appends them as one load to the log, and stops. A micro-batch writes its own
log folder ``load_seq=<first + epoch>`` with overwrite, so a retried epoch (lost
executor, restarted driver) rewrites the same folder instead of duplicating
rows. ``first`` is fixed once for each checkpoint, beyond the log's loads, so a
fresh checkpoint (epochs from 0 again) overwrites none of them. The current
table is last-write-wins over the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.operators import snapshot
from tallystone.operators.store import POSITION, latest_by_key, newest_order, read_log


def first_load(spark: SparkSession, log_dir: str, checkpoint_dir: str) -> int:
    """The load that epoch 0 of this checkpoint writes, kept beside the checkpoint."""
    at = lambda name: spark._jvm.org.apache.hadoop.fs.Path(name)
    mark, conf = f"{checkpoint_dir.rstrip('/')}/first_load", spark._jsc.hadoopConfiguration()
    ck, log = at(checkpoint_dir).getFileSystem(conf), at(log_dir).getFileSystem(conf)
    if ck.exists(at(f"{mark}/_SUCCESS")):
        return int(spark.read.text(mark).first()[0])
    if ck.exists(at(f"{checkpoint_dir.rstrip('/')}/offsets")):
        return 0                                # begun before the mark was kept
    loads = log.globStatus(at(f"{log_dir.rstrip('/')}/load_seq=*")) if log.exists(at(log_dir)) else []
    first = max((int(x.getPath().getName().split("=")[1]) for x in loads or []), default=-1) + 1
    spark.range(1).selectExpr(f"'{first}' AS value").coalesce(1).write.mode("overwrite").text(mark)
    return first


def run_incremental_load(spark: SparkSession, landing_dir: str, log_dir: str, checkpoint_dir: str,
                         schema: T.StructType, fmt: str = "parquet",
                         timeout_s: float | None = None) -> None:
    """Run one ``availableNow`` load of everything new under ``landing_dir``."""
    stream = spark.readStream.schema(schema).format(fmt).load(landing_dir)
    stream = stream.select("*", F.col("_metadata.file_path").alias("row_file"), F.col("_metadata.file_block_start").alias("row_block"))
    first = first_load(spark, log_dir, checkpoint_dir)

    def append(batch: DataFrame, epoch_id: int) -> None:
        # the number of a row inside its block of its file is the same in a repeated epoch
        (batch.withColumn("row_ord", F.monotonically_increasing_id())
         .write.mode("overwrite").parquet(f"{log_dir.rstrip('/')}/load_seq={first + int(epoch_id)}"))

    q = (stream.writeStream.foreachBatch(append)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("incremental load did not finish in time")
    if q.exception() is not None:
        raise q.exception()


def current_view(spark: SparkSession, log_dir: str, keys: Sequence[str],
                 order: Sequence[str] = (), snapshot_dir: str | None = None) -> DataFrame:
    """Last write wins per key: the newest load, then ``order``, then position.

    With ``snapshot_dir`` (written by ``snapshot.compact_log``) only the newest
    snapshot and the loads after it are read.
    """
    if snapshot_dir:
        return snapshot.current(spark, log_dir, snapshot_dir, keys, order).drop(*POSITION)
    log = read_log(spark, log_dir)
    return latest_by_key(log, keys, newest_order(log, order)).drop(*POSITION)


def loads_in_log(spark: SparkSession, log_dir: str) -> DataFrame:
    """Rows per load (one row per load; a run with nothing new adds none)."""
    return read_log(spark, log_dir).groupBy("load_seq").agg(F.count(F.lit(1)).alias("n_rows"))


def run_incremental_chunks(spark: SparkSession, landing_dir: str, log_dir: str,
                           checkpoint_dir: str, schema: T.StructType, id_cols: Sequence[str],
                           text_col: str = "text", fmt: str = "parquet", size: int = 500,
                           overlap: int = 50, min_tokens: int = 40, embed_dim: int | None = None,
                           timeout_s: float | None = None) -> None:
    """One ``availableNow`` run of the chunk pipeline over newly landed texts.

    Every micro-batch is split into sections, merged, windowed (and embedded
    when ``embed_dim`` is given) and written as its own log load; documents
    landed again later (an amended filing) get a newer load.
    """
    from tallystone.operators.chunks import build_chunks
    from tallystone.operators.vectors import embed_chunks

    stream = spark.readStream.schema(schema).format(fmt).load(landing_dir)
    first = first_load(spark, log_dir, checkpoint_dir)

    def append(batch: DataFrame, epoch_id: int) -> None:
        ch = build_chunks(batch, text_col, tuple(id_cols), size, overlap, min_tokens)
        if embed_dim:
            ch = embed_chunks(ch, dim=embed_dim)
        ch.write.mode("overwrite").parquet(f"{log_dir.rstrip('/')}/load_seq={first + int(epoch_id)}")

    q = (stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("incremental chunk load did not finish in time")
    if q.exception() is not None:
        raise q.exception()


def current_chunks(spark: SparkSession, log_dir: str, doc_col: str) -> DataFrame:
    """Chunks of each document's newest load (a re-chunk leaves no stale tail)."""
    from tallystone.operators.store import upsert_chunks
    return upsert_chunks(read_log(spark, log_dir), doc_col=doc_col)
