"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.session import shared_dir

#: Characters that end a word: space and U+0009 to U+000D.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder, read it back.

    Cuts the lineage, so lost executors cost a re-read and no recomputation,
    and a table used twice is computed once.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text in order; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(df: DataFrame) -> Column:
    """128-bit hash of all columns of a row, as 32 hexadecimal digits; equal rows hash alike.

    Two 64-bit hashes with different seeds, both over the columns and which of
    them are null (the hash skips nulls); a column of a nested type counts by
    its JSON, so that nulls in it, maps and variants count too.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        cols += [F.to_json(F.struct(c.alias("c")), {"ignoreNullFields": "false"}) if nested else c, c.isNull()]
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), *cols)), 16, "0") for seed in (1, 2)]))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def runs(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[list[pd.DataFrame]]:
    """Pieces of a partition sorted by ``keys``, cut where the key changes.

    Yields ``(key, frame, last)``: a key's rows come in one or more frames,
    none held back, so memory is bounded by one Arrow batch however many rows
    a key has.
    """
    held = None
    for f in frames:
        if not len(f):
            continue
        k = f[keys]
        change = np.flatnonzero((k.ne(k.shift()) & ~(k.isna() & k.shift().isna())).any(axis=1).to_numpy())
        cuts = np.unique(np.concatenate([[0], change, [len(f)]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = f.iloc[a:b]
            key = tuple(None if pd.isna(v) else v for v in part[keys].iloc[0])
            if held is not None:
                yield held[0], held[1], held[0] != key
            held = (key, part)
    if held is not None:
        yield held[0], held[1], True


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components of the undirected ``edges`` (columns a, b: long).

    Returns (node, root), one row for each node of an edge; root is the
    smallest node of its component. Each round gives every node its smallest
    neighbour as parent, follows the parents to their end by pointer jumping,
    and contracts the edges to those ends, until no edge is left; node ids
    are hash values, so parent chains and rounds stay few. Every aggregation
    is a partial min and every join is left to AQE's skew splitting, so a hub
    with a third of all nodes is never one task's group.
    """
    e = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
              purpose)
    total = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("root")), purpose)
        while True:
            over = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = stage(up.join(over, "root").select("node", F.col("next").alias("root"),
                                                        (F.col("next") < F.col("root")).alias("moved")), purpose)
            up = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        e = stage(e.join(up.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
                  .join(up.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
                  .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
                  purpose)
        if total is None:
            total = up
        else:
            total = stage(total.join(up.select(F.col("node").alias("root"), F.col("root").alias("r")), "root", "left")
                          .select("node", F.coalesce("r", "root").alias("root")), purpose)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")) if total is None else total
