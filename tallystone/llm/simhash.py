"""SimHash near-duplicate classes by bit-sliced comparison.

Fingerprints: in each text (A-Z lower-cased, null: empty) every run of three
words, repeats included, is hashed with XXH64 (seed 42); a fingerprint bit is
set if it is set in over half the hashes. A text of fewer words hashes its
whole word sequence; one without words has fingerprint zero.

Links: two fingerprints link if at most ``radius`` bits differ. Distinct
fingerprints are dealt into overlapping tables: the 64 bits form ``radius + 2``
blocks, two linked fingerprints agree on two blocks at least, and there is one
table for every two blocks. Buckets of a table are compared bit-sliced: the
bit planes of a block of fingerprints lie vertically in 64-bit words, carry-
save counters (ones, twos, over) add a plane to many distances at once, and a
block is abandoned as soon as all its distances exceed the radius. A bucket
larger than ``tile`` is cut into tiles and each two tiles meet in a task of
their own, so no link is lost and no task holds more than two tiles.

Each comparison sends on only a star for each connected group it found (not
its pairs); stars are joined into components by ``common.components``.

Defined results: null or empty text: fingerprint zero, linked like any other;
repeated rows: each gets its row; null doc_id: counts as no id, so it never
names a component (a component of null ids only has a null component_id);
empty table: no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.llm.common import components, fresh, row_hash, stage

SHINGLE, SEED, RADIUS, TILE = 3, 42, 3, 2048
#: Small buckets are compared together in blocks of about so many.
BLOCK = 512
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint_of(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint of one text, unsigned."""
    w = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not w:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(w) <= size:
        return digest(join(w), SEED)
    h = np.fromiter((digest(join(s), SEED) for s in zip(*[w[i:] for i in range(size)])), np.uint64, len(w) - size + 1)
    bits = np.zeros(64, np.int64)
    for a in range(0, len(h), 255):          # 255 at a time: byte counters do not overflow
        part = np.unpackbits(h[a:a + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += part.sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * bits > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, keep: tuple = ()) -> DataFrame:
    """(doc_id, fp, and the columns ``keep``) of every row of ``docs``; fp is a signed long."""
    given = docs.select("doc_id", "text", *keep)
    names = [c for c in given.columns if c != "text"]
    schema = ", ".join(f"`{c}` {given.schema[c].dataType.simpleString()}" for c in names) + ", fp bigint"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = np.array([fingerprint_of(t, size) for t in f["text"]], np.uint64).view(np.int64)
            yield f[names].assign(fp=fp)

    return given.mapInPandas(run, schema)


def _links(fp: np.ndarray, radius: int) -> np.ndarray:
    """Packed link matrix of a block: row i, bit j is set if i and j link."""
    n = len(fp)
    lanes = -(-n // 64)
    padded = np.zeros(lanes * 64, np.uint64)
    padded[:n] = fp
    bits = (padded[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)          # lane, plane
    planes = np.packbits(np.ascontiguousarray(bits.T, np.uint8), axis=1, bitorder="little").view(np.uint64)  # plane, word
    ones, twos, over = (np.zeros((n, lanes), np.uint64) for _ in range(3))
    live = np.arange(n)
    real = np.uint64((1 << (n - 64 * (lanes - 1))) - 1)          # lanes of the last word that hold a fingerprint
    if radius != 3:
        raise ValueError("ones, twos and over count to a radius of 3")
    for p in range(64):
        own = np.uint64(0) - bits[live, p]                       # all ones where the bit is set
        x = planes[p][None, :] ^ own[:, None]
        carry = ones[live] & x
        ones[live] ^= x
        over[live] |= twos[live] & carry                         # a fourth differing bit
        twos[live] ^= carry
        if p % 16 == 15 and p < 63:                              # abandon rows that exceed it everywhere but at themselves
            near = ~over[live]
            near[:, -1] &= real
            live = live[np.bitwise_count(near).sum(axis=1) > 1]
            if not len(live):
                break
    done = np.setdiff1d(np.arange(n), live)
    over[done] = _ALL
    link = ~over
    link[:, -1] &= real
    return link


def stars(fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """For a block of distinct fingerprints: (a, b), each linked group as a star around its smallest."""
    order = np.sort(fp)
    link = _links(order.view(np.uint64), radius)
    n = len(order)
    rows = np.flatnonzero(np.bitwise_count(link).sum(axis=1) > 1)
    label = np.arange(n)
    while len(rows):
        before = label.copy()
        for a in range(0, len(rows), 256):
            r = rows[a:a + 256]
            m = np.unpackbits(link[r].view(np.uint8), axis=1, bitorder="little")[:, :n].astype(bool)
            label[r] = np.minimum(label[r], np.where(m, label[None, :], n).min(axis=1))
        label = label[label]
        if (label == before).all():
            break
    away = np.flatnonzero(label != np.arange(n))
    return order[away], order[label[away]]


def tables(fp, radius: int = RADIUS) -> list:
    """Columns (table, key) of the overlapping bucket tables."""
    n = radius + 2
    edge = [64 * i // n for i in range(n + 1)]
    mask = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edge, edge[1:])]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in (mask[i] | mask[j] for i, j in itertools.combinations(range(n), 2))]
    return [F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(m).cast("long")).alias("k")) for t, m in enumerate(signed)]


def link_edges(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Star edges (a, b) between linked fingerprints of ``fps`` (distinct values in column fp)."""
    rows = stage(fps.select("fp", F.explode(F.array(*tables(F.col("fp"), radius))).alias("b")).select("fp", "b.t", "b.k"),
                 "simhash-buckets")
    sizes = stage(rows.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1"), "simhash-sizes")
    small = rows.join(sizes.where(F.col("n") <= tile), ["t", "k"]).select(
        "fp", "t", "k", F.lit(0).alias("i"), F.lit(0).alias("j"))
    g = F.ceil(F.col("n") / tile).cast("int")
    mine = F.pmod(F.xxhash64("fp"), g).cast("int")
    large = (rows.join(sizes.where(F.col("n") > tile), ["t", "k"]).withColumn("g", g).withColumn("own", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1))).where("own <> other")
             .select("fp", "t", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    tiles = small.unionByName(large)
    key = ["t", "k", "i", "j"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []

        def found(block: pd.DataFrame) -> pd.DataFrame:
            a, b = stars(np.unique(block["fp"].to_numpy()), radius)
            return pd.DataFrame({"a": a, "b": b})

        for f in frames:
            rest.append(f)
            if sum(map(len, rest)) < BLOCK:
                continue
            f = pd.concat(rest, ignore_index=True)
            k = f[key].to_numpy()
            ends = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1      # the last bucket may go on
            at = 0
            for end in ends:
                if end - at >= BLOCK or end == ends[-1]:
                    yield found(f.iloc[at:end])
                    at = end
            rest = [f.iloc[at:]]
        if rest:
            yield found(pd.concat(rest, ignore_index=True))

    dealt = tiles.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInPandas(run, "a bigint, b bigint")


def near_classes(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, tile: int = TILE,
                 keep: tuple = ()) -> DataFrame:
    """Each row's (doc_id, fp, component_id, root, and ``keep``); root names its class of fingerprints."""
    prints = stage(fingerprints(docs, size, keep), "simhash-prints")
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(link_edges(reps.select("fp"), radius, tile), "simhash-components")
    named = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = stage(named, "simhash-classes")
    smallest = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    ids = stage(named.join(smallest, "root").select("fp", "root", "component_id"), "simhash-ids")
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id", "root", *keep)


def simhash_components(docs: DataFrame, **kw) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    return near_classes(docs, **kw).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                           "component_id")


def drop_near_duplicates(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` with one kept of each class: the smallest doc_id, nulls last.

    Of rows alike in every column one stays. All columns return unchanged.
    """
    h = fresh(docs, "row_hash")
    tagged = docs.withColumn(h, row_hash(docs))
    classes = near_classes(tagged, keep=(h,), **kw)
    first = classes.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", h)).alias("w"))
    winners = stage(first.select(F.col(f"w.{h}").alias(h)), "simhash-winners")
    n = fresh(tagged, "nth")
    once = tagged.withColumn(n, F.row_number().over(Window.partitionBy(h).orderBy("doc_id"))).where(f"`{n}` = 1")
    return once.join(winners, h, "left_semi").select(*docs.columns)
