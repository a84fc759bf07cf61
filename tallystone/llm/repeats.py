"""Exact removal of repeated byte strings by suffix arrays of shards.

A byte of a text (UTF-8) is removed if a string of ``length`` bytes covers it
that also starts anywhere else, in the same or another document; strings never
cross documents and are judged on the input.

1. Anchors: the string that starts at a place is represented by its smallest
   ``GRAM``-byte hash (leftmost on ties), so equal strings have equal anchors.
   Consecutive starts with the same anchor form a context: the bytes from the
   first start to the end of the last start's string. Anchors that occur once
   in the corpus are dropped; no repeated string has one.
2. Contexts that are equal throughout (128-bit hash) repeat as a whole: all
   their strings are repeated, and one of them stands for all in step 3.
3. Distinct contexts of one anchor meet in a shard. A shard's contexts are
   joined to one text, its suffix array is built by induced sorting, permuted
   common prefixes show runs of equal strings, and a run with two starts or
   more marks them (``suffix``). Shards are built of whole anchors and closed
   at ``SHARD`` bytes.
4. An anchor with over ``CROWD`` distinct contexts would be one task's burden:
   its strings are counted by their 128-bit hash instead, in a partial
   aggregation - as exact, and split over all tasks.
5. Marks of a document are merged and its bytes removed.

A document row is known by its doc_id and a hash of (doc_id, text); rows alike
in both are repeats of each other and have the same result. Shuffled are the
anchors (about one for each 185 bytes) and twice the texts.

Defined results: null or empty text, or one shorter than ``length``: nothing
removed, the digest of its bytes; null doc_id: a value like any other;
repeated rows: each loses all its repeated strings; empty table: no rows;
further columns: ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import stage
from tallystone.llm.suffix import common_prefixes, suffix_array

LENGTH, GRAM, SHARD, CROWD = 400, 32, 4_000_000, 4096
_POS = np.uint64((1 << 30) - 1)
# Odd multipliers of the gram hash.
_M = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def gram_hashes(b: bytes, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes (a multiple of 8) at each place."""
    n = len(b) - gram + 1
    h = np.zeros(n, np.uint64)
    for i in range(0, gram, 8):
        word = np.ndarray((n,), "<u8", b, offset=i, strides=(1,))
        h ^= word
        h *= _M[i // 8 % 4]
        h ^= h >> np.uint64(29)
    h *= _M[3]
    h ^= h >> np.uint64(32)
    return h


def anchors_of(b: bytes, length: int = LENGTH, gram: int = GRAM):
    """(first start, last start, hash) of each run of starts with one anchor."""
    g = gram_hashes(b, gram)
    w = length - gram + 1
    n = len(g)
    key = (g & ~_POS) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = key
    cube = padded.reshape(blocks, w)
    fore = np.minimum.accumulate(cube, axis=1).ravel()
    back = np.minimum.accumulate(cube[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(b) - length + 1
    at = (np.minimum(back[:starts], fore[w - 1:w - 1 + starts]) & _POS).astype(np.int64)
    cut = np.flatnonzero(at[1:] != at[:-1]) + 1
    first = np.r_[0, cut]
    return first, np.r_[cut - 1, starts - 1], g[at[first]]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"),
                       F.xxhash64(F.lit("id"), "doc_id").alias("id"))


def _contexts(docs: DataFrame, length: int) -> DataFrame:
    names = ["k", "id", "s", "e", "a", "c", "d"]

    def frame(out: list) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list = []
        size = 0
        for f in frames:
            for k, i, text in zip(f["k"].tolist(), f["id"].tolist(), f["text"]):
                b = raw(text)
                if len(b) < length:
                    continue
                first, last, h = anchors_of(b, length)
                digest = xxhash.xxh3_128_digest
                both = np.frombuffer(b"".join([digest(b[s:e]) for s, e in zip(first.tolist(), (last + length).tolist())]),
                                     "<i8").reshape(-1, 2)
                n = len(first)
                out.append((np.full(n, k), np.full(n, i), first, last, h.view(np.int64), both[:, 0], both[:, 1]))
                size += n
                if size > 50_000:
                    yield frame(out)
                    out, size = [], 0
        if out:
            yield frame(out)

    return docs.select("k", "id", "text").mapInPandas(
        run, "k bigint, id bigint, s bigint, e bigint, a bigint, c bigint, d bigint")


def repeated(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context, the places in it where a string starts that starts twice or more in the shard."""
    t = np.frombuffer(b"".join(contexts), np.uint8)
    size = np.array([len(c) for c in contexts])
    begin = np.cumsum(size) - size
    valid = np.zeros(len(t), bool)
    for b, n in zip(begin, size):
        valid[b:b + n - length + 1] = True
    sa = suffix_array(t)
    common = common_prefixes(t, sa, int(size.max()) + length + 8, begin)
    group = np.cumsum(common < length) - 1
    members = np.bincount(group, weights=valid[sa])
    hit = np.zeros(len(t), bool)
    hit[sa] = (members >= 2)[group]
    hit &= valid
    return [np.flatnonzero(hit[b:b + n]) for b, n in zip(begin, size)]


def _spans(places: np.ndarray):
    """Runs of consecutive places as (first, last)."""
    cut = np.flatnonzero(np.diff(places) > 1)
    return places[np.r_[0, cut + 1]], places[np.r_[cut, len(places) - 1]]


def _shards(parts: DataFrame, length: int, shard: int) -> DataFrame:
    """Marks (k, id, s, e) from ``parts`` (a, k, id, s, known, bytes), whole anchors together."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list = []
        size = 0

        def found(rows: list) -> pd.DataFrame:
            got = []
            for (_, k, i, s, known, _), places in zip(rows, repeated([r[5] for r in rows], length)):
                if len(places) and not known:                 # what stands for equal contexts is marked already
                    got += [(k, i, s + x, s + y) for x, y in zip(*_spans(places))]
            return pd.DataFrame(got, columns=["k", "id", "s", "e"])

        for f in frames:
            for row in f[["a", "k", "id", "s", "known", "bytes"]].itertuples(index=False, name=None):
                if size > shard and row[0] != rest[-1][0]:
                    yield found(rest)
                    rest, size = [], 0
                rest.append(row)
                size += len(row[5])
        if rest:
            yield found(rest)

    dealt = parts.repartition("a").sortWithinPartitions("a")
    return dealt.mapInPandas(run, "k bigint, id bigint, s bigint, e bigint")


def marks(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD, shard: int = SHARD) -> DataFrame:
    """(k, id, s, e): the repeated strings of document (k, id) start at s to e; ``docs`` from ``_keyed``."""
    all_contexts = stage(_contexts(docs, length), "repeats-anchors")
    twice = stage(all_contexts.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"), "repeats-twice")
    contexts = stage(all_contexts.join(twice, "a", "left_semi"), "repeats-contexts")
    same = ["a", "c", "d"]
    kinds = stage(contexts.groupBy(*same).agg(
        F.count("*").alias("m"), F.min(F.struct("k", "id", "s", "e")).alias("one")), "repeats-kinds")
    whole = contexts.join(stage(kinds.where("m > 1").select(*same), "repeats-equal"), same).select("k", "id", "s", "e")
    groups = stage(kinds.groupBy("a").agg(F.count("*").alias("n")).where("n > 1"), "repeats-groups")
    wanted = stage(kinds.join(groups, "a").select(
        "one.*", "a", (F.col("m") > 1).alias("known"), (F.col("n") > crowd).alias("crowded")), "repeats-wanted")
    lists = stage(wanted.groupBy("k", "id").agg(F.collect_list(F.struct("s", "e", "a", "known", "crowded")).alias("parts")),
                  "repeats-lists")
    held = docs.select("k", "id", "text").join(lists, ["k", "id"])

    columns = ["k", "id", "s", "a", "known", "crowded", "bytes"]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows: list = []
            for k, i, text, parts in zip(f["k"], f["id"], f["text"], f["parts"]):
                b = raw(text)
                rows += [(k, i, p["s"], p["a"], p["known"], p["crowded"], b[p["s"]:p["e"] + length]) for p in parts]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    parts = stage(held.mapInPandas(cut, "k bigint, id bigint, s bigint, a bigint, known boolean, crowded boolean, bytes binary")
                  .dropDuplicates(["k", "id", "s"]), "repeats-parts")
    by_shard = _shards(parts.where("not crowded"), length, shard)

    def strings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k, i, s, b in zip(f["k"], f["id"], f["s"], f["bytes"]):
                n = len(b) - length + 1
                h = np.frombuffer(b"".join([xxhash.xxh3_128_digest(b[x:x + length]) for x in range(n)]), "<i8").reshape(-1, 2)
                yield pd.DataFrame({"k": k, "id": i, "s": np.arange(s, s + n), "c": h[:, 0], "d": h[:, 1]})

    single = stage(parts.where("crowded").select("k", "id", "s", "bytes").mapInPandas(
        strings, "k bigint, id bigint, s bigint, c bigint, d bigint"), "repeats-strings")
    again = stage(single.groupBy("c", "d").agg(F.count("*").alias("n")).where("n > 1").select("c", "d"), "repeats-again")
    by_string = single.join(again, ["c", "d"], "left_semi").select("k", "id", "s", F.col("s").alias("e"))
    return whole.unionByName(by_shard).unionByName(by_string)


def covered(spans, n: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (begin, end) of bytes that the strings starting in ``spans`` cover."""
    s = np.array([x for x, _ in spans], np.int64)
    e = np.minimum(np.array([y for _, y in spans], np.int64) + length, n)
    order = np.argsort(s, kind="stable")
    s, reach = s[order], np.maximum.accumulate(e[order])
    new = np.r_[True, s[1:] > reach[:-1]]
    return s[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(s) - 1]]


def _removed(docs: DataFrame, length: int, **kw) -> DataFrame:
    """(doc_id, text, spans) of every row of ``docs``; spans as structs (s, e) of string starts."""
    keyed = _keyed(docs)
    # rows alike share their marks: each is kept once, in the tasks before the shuffle too
    found = stage(marks(keyed, length, **kw).groupBy("k", "id").agg(
        F.collect_set(F.struct("s", "e")).alias("spans")), "repeats-marks")
    return keyed.join(found, ["k", "id"], "left").select("doc_id", "text", "spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, **kw) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; ``kept`` are the remaining bytes."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for doc_id, text, spans in zip(f["doc_id"], f["text"], f["spans"]):
                b, kept, removed, n = raw(text), None, 0, 0
                if spans is not None and len(spans):
                    begin, end = covered([(x["s"], x["e"]) for x in spans], len(b), length)
                    edge = np.r_[0, np.stack([begin, end], axis=1).ravel(), len(b)]
                    kept = b"".join([b[x:y] for x, y in zip(edge[::2], edge[1::2])])
                    removed, n = int((end - begin).sum()), len(begin)
                kept = b if kept is None else kept
                rows.append((doc_id, len(b), removed, n, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _removed(docs, length, **kw).mapInPandas(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
