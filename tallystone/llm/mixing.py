"""Mixing sources to target weights by pivotal dependent rounding.

Sources, in code point order with null last, weigh ``weights`` in turn and share
the total size; a target stops at ``most`` times its source's size and the
excess goes to the others by weight until none is above (the water level that
does so is found in one pass over the sources by their level of saturation).

A document's expected copies are target / source size. Whole copies are sure;
the fractions are rounded dependently: two fractional documents of a source
meet, size-weighted mass passes from one to the other, in either direction
with the probabilities that keep both expectations, until one is integral. Each
meeting leaves the source's expected words as they are, so all of a source's
documents but one are settled without error. Large documents meet first, so
the last one open tends to be small; it is rounded to the nearer whole.

Meetings form a reduction tree: level 0 groups (source, hash bucket) hold about
``GROUP`` documents, every level combines what ``FAN`` groups have left over,
so no task ever holds a source, and what is passed on shrinks by FAN. All
randomness comes from (seed, level, source, bucket) and rows meet by size and
content hash: reruns agree, also on retried tasks.

Rows that are alike in every column (by 128 bits) are one unit with a
multiplicity; its copies are shared out evenly, at most ``most`` for each, and
written out ``CHUNK`` at a time, so that no row holds them all.

The sources are ranked in one task: one row for each source.

Defined results: null or empty text: size 0, taken 0; null source: a source of
its own, last; a source of size 0: target 0; null or repeated doc_id: rows are
told apart by content; empty table: no rows; further columns: part of a row's
content for ``mix`` and returned by it unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.llm.common import fresh, n_words, row_hash, runs, stage

WEIGHTS, MOST, SEED = (5.0, 2.0, 1.0), 3.0, 20
GROUP, FAN, CHUNK = 512, 64, 65536


def targets(units: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, rank, source_size, target): one row for each source of ``units`` (source, size, m)."""
    by = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by.withColumn("rank", F.row_number().over(order) - 1).withColumn(
        "w", F.get(F.array(*map(F.lit, weights)), F.pmod("rank", F.lit(len(weights)))))
    # By rising saturation level most * size / weight, the saturated sources come
    # first; the water level leaves (total - their caps) to the weights of the rest.
    level = F.lit(most) * F.col("source_size") / F.col("w")
    up = Window.orderBy(level, "rank")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    down = up.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole)
    water = ((total - F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(before), F.lit(0.0)))
             / F.sum("w").over(down))
    tried = ranked.withColumn("level", level).withColumn("water", water)
    # The first source that the water does not saturate sets the level for it and all after it.
    free = F.min(F.when(F.col("water") <= F.col("level"), F.struct("level", "rank", "water"))).over(whole)
    set_at = tried.withColumn("free", free)
    return set_at.select(
        "source", "rank", "source_size",
        F.when(F.col("free").isNull() | (F.struct("level", "rank") < F.struct("free.level", "free.rank")),
               F.lit(most) * F.col("source_size")).otherwise(
            F.least(F.lit(most) * F.col("source_size"), F.col("free.water") * F.col("w"))).cast("double").alias("target"))


def pivotal(size: np.ndarray, p: np.ndarray, draw) -> int:
    """Round fractions ``p`` in place, in order, keeping sum(size * p); the index left open or -1."""
    at = -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if at < 0:
            at = j
            continue
        i = at
        up = min((1 - p[i]) * size[i], p[j] * size[j])           # words that can pass to i
        down = min(p[i] * size[i], (1 - p[j]) * size[j])         # words that can pass to j
        if draw() * (up + down) < down:
            full, words = up == (1 - p[i]) * size[i], up
            if full:
                p[i], p[j] = 1.0, p[j] - words / size[j]
            else:
                p[i], p[j] = p[i] + words / size[i], 0.0
        else:
            full, words = down == p[i] * size[i], down
            if full:
                p[i], p[j] = 0.0, p[j] + words / size[j]
            else:
                p[i], p[j] = p[i] - words / size[i], 1.0
        for k in (i, j):                                          # rounding noise of the subtraction
            if p[k] < 1e-12 or p[k] > 1 - 1e-12:
                p[k] = round(p[k])
        at = next((k for k in (i, j) if 0.0 < p[k] < 1.0), -1)
    return at


def _meet(rows: DataFrame, level: int, seed: int, last: bool) -> DataFrame:
    """Let the open rows of each (rank, bucket) group meet; ``last`` rounds what is left."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, draw = None, None
        for key, f, end in runs(frames, ["rank", "bucket"]):
            draw = draw or np.random.default_rng([seed, level, int(key[0]), int(key[1])]).random
            f = f if held is None else pd.concat([held, f], ignore_index=True)
            size, p = f["size"].to_numpy(float), f["p"].to_numpy(float).copy()
            at = pivotal(size, p, draw)
            if at >= 0 and end and last:
                p[at], at = float(p[at] >= 0.5), -1
            f = f.assign(p=p)
            held = None
            if at >= 0 and not end:                               # goes on with the group's next rows
                held, f = f.iloc[[at]], f.drop(f.index[at])
            yield f
            if end:
                draw = None

    key = ["rank", "bucket"]
    dealt = rows.repartition(*key).sortWithinPartitions(*key, F.col("size").desc(), "h")
    return dealt.mapInPandas(run, rows.schema)


def copies(units: DataFrame, weights=WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """(h, doc_id, source, size, m, source_size, target, copies) of ``units`` (h, doc_id, source, size, m).

    ``copies`` counts those of all m equal rows together.
    """
    units = stage(units, "mix-units")
    n = units.count()
    per = stage(targets(units, weights, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    want = units.join(per, units["source"].eqNullSafe(per["source"])).select(
        units["*"], "rank", "source_size", "target", (rate * F.col("m")).alias("e"))
    # A unit without words moves none: it needs no partner and takes its whole part.
    want = want.select("*", F.floor("e").alias("whole")).withColumn(
        "p", F.when(F.col("size") > 0, F.col("e") - F.col("whole")).otherwise(0.0))
    buckets = max(1, -(-n // GROUP))
    rows = want.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets))).drop("e")
    done, level = [], 0
    while True:
        last = buckets == 1
        met = stage(_meet(rows, level, seed, last), "mix-level")
        settled = F.col("p").isin(0.0, 1.0)
        done.append(met.where(settled))
        if last:
            break
        level, buckets = level + 1, -(-buckets // FAN)
        rows = met.where(~settled).withColumn("bucket", F.floor(F.col("bucket") / FAN).cast("long"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.select("h", "doc_id", "source", "size", "m", "source_size", "target",
                        (F.col("whole") + F.col("p")).cast("long").alias("copies"))


def units_of(docs: DataFrame, h) -> DataFrame:
    """Rows of ``docs`` by content: (h, doc_id, source, size, m)."""
    return docs.select(h.alias("h"), "doc_id", "source", n_words(F.col("text")).alias("size")).groupBy(
        "h", "doc_id", "source", "size").agg(F.count("*").alias("m"))


def numbered(df: DataFrame, count, nth: str) -> DataFrame:
    """Each row of ``df`` as often as ``count`` says, numbered from 1 in column ``nth``; no array of more than ``CHUNK``."""
    first = fresh(df, "chunk")
    return (df.withColumn(nth, F.col(count).cast("long"))
            .withColumn(first, F.explode(F.sequence(F.lit(0), F.floor((F.col(nth) - 1) / CHUNK).cast("long")))).where(f"`{nth}` > 0")
            .withColumn(nth, F.explode(F.sequence(F.col(first) * CHUNK + 1, F.least(F.col(nth), (F.col(first) + 1) * CHUNK))))
            .drop(first))


def mixture(docs: DataFrame, **kw) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``."""
    got = copies(units_of(docs, row_hash(docs.select("doc_id", "source", "text"))), **kw)
    each = numbered(got, "m", "nth").withColumn(
        "mine", F.floor(F.col("copies") / F.col("m")) + F.when(F.col("nth") <= F.col("copies") % F.col("m"), 1).otherwise(0))
    return each.select("doc_id", "size", "source_size", "target", (F.col("mine") * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it."""
    h, n, c = (fresh(docs, x) for x in ("mix_hash", "mix_nth", "mix_copies"))
    tagged = docs.withColumn(h, row_hash(docs))
    got = copies(units_of(tagged, F.col(h)), **kw).where("copies > 0").select(F.col("h").alias(h), F.col("copies").alias(c))
    once = tagged.withColumn(n, F.row_number().over(Window.partitionBy(h).orderBy(F.lit(1)))).where(f"`{n}` = 1").drop(n)
    return numbered(once.join(stage(got, "mix-copies"), h), c, n).select(*docs.columns)
