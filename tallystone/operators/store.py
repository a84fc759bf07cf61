"""Set-based upserts over append-only logs (plain Parquet has no MERGE).

A store is an append-only log of loads; every load carries ``load_seq``
(monotone per load) and ``row_ord`` (position inside the load). The current
table is "last write wins per key" (``latest_by_key``), reduced inside each input
task before the shuffle, so no task ever holds all versions of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fact store keys: the reference's conflict key omits period_start, which
# lets a 3-month and a year-to-date value ending the same day overwrite each
# other; "strict" (default) keeps both, "compat" reproduces the reference.
FACT_KEY_COMPAT = ["cik", "concept", "period_end", "form", "accession_number"]
FACT_KEY_STRICT = ["cik", "concept", "period_start", "period_end", "form", "accession_number"]
CHUNK_KEY = ["accession_number", "chunk_index"]
#: Where a row stood in its load: file, block of the file, place (``file_position``).
POSITION = ("row_file", "row_block", "row_ord")


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` tuple.

    ``row_number() = 1`` over (keys ORDER BY order DESC). Spark plans a
    partial ``WindowGroupLimit`` before the shuffle, so every map task keeps
    only its own newest row per key: a key holding a third of the table
    arrives at the reducer as one row per map task, never as all versions.
    ``order`` must be a total order within a key for a deterministic result.
    NULL parts of a key form one group; NULL order values sort lowest.
    """
    w = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in _cols(order)])
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def file_position(scan: DataFrame) -> DataFrame:
    """``scan`` (a file source, nothing after it) with the columns of ``POSITION``.

    Row numbers of a task are no position: files are packed into tasks by size, and a
    re-run packs them anew. Inside one block of one file they follow the file, so
    (file, block, number) gives the same order on every run.
    """
    return (scan.withColumn("row_file", F.col("_metadata.file_path"))
            .withColumn("row_block", F.col("_metadata.file_block_start"))
            .withColumn("row_ord", F.monotonically_increasing_id()))


def newest_order(log: DataFrame, order: Sequence[str] = (), seq_col: str = "load_seq") -> list[str | Column]:
    """The newest row of a log: load, then ``order``, then position, then content, so that no two rows tie that differ."""
    content = F.xxhash64(*[F.col(f"`{f.name}`") for f in sorted(log.schema.fields, key=lambda f: f.name)
                           if f.dataType.typeName() not in ("map", "variant") and f.name not in POSITION])
    return [seq_col, *order, *[c for c in POSITION if c in log.columns], content]


def upsert_facts(log: DataFrame, mode: str = "strict", seq_col: str = "load_seq",
                 pos_col: str = "row_ord", keys: Sequence[str] | None = None) -> DataFrame:
    """Current fact table from the load log (A2, last write wins)."""
    if keys is None:
        if mode not in ("strict", "compat"):
            raise ValueError("mode must be 'strict' or 'compat'")
        keys = FACT_KEY_STRICT if mode == "strict" else FACT_KEY_COMPAT
    order = [pos_col] if pos_col not in POSITION else []
    return latest_by_key(log, keys, newest_order(log, order, seq_col))


def append_load(batch: DataFrame, log_path: str, load_seq: int, pos_col: str = "row_ord") -> None:
    """Append one load to the log at ``log_path/load_seq=N``.

    Writing the load's own partition with overwrite makes a retried load
    idempotent (a lost executor or a re-run rewrites the same folder). Rows
    without a position are told apart by their content (``newest_order``).
    """
    out = batch if pos_col in batch.columns else batch.withColumn(pos_col, F.lit(0).cast("bigint"))
    (out.write.mode("overwrite").parquet(f"{log_path.rstrip('/')}/load_seq={int(load_seq)}"))


def read_log(spark, log_path: str) -> DataFrame:
    return spark.read.option("basePath", log_path).parquet(f"{log_path.rstrip('/')}/load_seq=*")


def compact(current: DataFrame, out_path: str, partition_by: Sequence[str] = ("cik",)) -> None:
    """Write the current view to a *new* path, partitioned for pruning.

    ``rebalance`` brings a key's rows together and lets AQE split a key that
    is larger than the advisory size over several tasks, merging small ones."""
    (current.hint("rebalance", *partition_by).write.mode("overwrite")
     .partitionBy(*partition_by).parquet(out_path))


def upsert_chunks(log: DataFrame, mode: str = "replace", doc_col: str = "accession_number",
                  index_col: str = "chunk_index", seq_col: str = "load_seq") -> DataFrame:
    """Current chunk table (A3).

    ``replace`` (default): the newest load of each document replaces all of
    its chunks, so a shorter re-chunk leaves no stale tail. ``key``: last
    write per (document, chunk_index), the reference's behaviour.
    The newest load per document is an aggregate joined back on
    (document, load) — a one-row-per-document side, never a window over a
    whole document's chunks.
    """
    if mode == "key":
        order = [seq_col] + (["row_ord"] if "row_ord" in log.columns else [])
        return latest_by_key(log, [doc_col, index_col], order)
    if mode != "replace":
        raise ValueError("mode must be 'replace' or 'key'")
    newest = log.groupBy(doc_col).agg(F.max(seq_col).alias(seq_col))
    return log.join(newest, [doc_col, seq_col], "left_semi")


def golden_upsert(base: DataFrame, batch: DataFrame, overwrite: bool, id_col: str = "id",
                  seq_col: str = "load_seq", pos_col: str = "pos") -> DataFrame:
    """Golden-set upsert.

    An id already present and ``overwrite=False`` keeps the old record and
    drops the new one; with ``overwrite=True`` the old record is removed and
    the new one is appended last (its ``(load_seq, pos)`` is newer). Ids
    repeated inside the batch keep their last position.
    """
    batch = latest_by_key(batch, [id_col], [seq_col, pos_col])
    if overwrite:
        kept = base.join(batch.select(id_col), id_col, "left_anti")
        return kept.unionByName(batch)
    new = batch.join(base.select(id_col), id_col, "left_anti")
    return base.unionByName(new)
