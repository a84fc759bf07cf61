"""Sinks S11-S13: tidy facts with identity sidecars, filing text, table cells.

Writers are partitioned by the unit a reader later selects on (ticker,
file), so loads prune folders instead of scanning everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallystone.operators.facts import TIDY_COLS


def write_fact_files(tidy: DataFrame, identities: DataFrame, out_dir: str) -> None:
    """Tidy facts as CSV under ``csv/ticker=T/`` and one identity sidecar per
    ticker under ``sidecars/ticker=T/`` (S11). A ticker without any fact gets
    neither file, as in the reference. ``identities``: (ticker, cik,
    entityName); ``tidy`` carries a ``ticker`` column.
    """
    cols = ["ticker"] + [c for c in TIDY_COLS if c in tidy.columns]
    tidy.select(*cols).hint("rebalance", "ticker").write.mode("overwrite").partitionBy("ticker") \
        .option("header", "true").csv(f"{out_dir}/csv")
    present = tidy.select("ticker").distinct()
    identities.join(present, "ticker", "left_semi").write.mode("overwrite") \
        .partitionBy("ticker").json(f"{out_dir}/sidecars")


def write_texts(texts: DataFrame, path: str, key: str = "file_name") -> None:
    """Filing text, one row per file."""
    texts.select(key, "text").write.mode("overwrite").parquet(path)


def write_table_cells(cells: DataFrame, path: str) -> None:
    """Long-form table cells (S13); empty tables have no cells, but the
    numbering keeps their place (``table_idx`` as parsed)."""
    cells.write.mode("overwrite").parquet(path)
