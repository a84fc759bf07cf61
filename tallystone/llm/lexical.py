"""Ranked lexical search with bit-sliced Bloom signatures.

Index (``signatures``; knows no query). The terms of a document set bits of a
Bloom signature, ``HASHES`` each, once for every level of occurrence that they reach
(``LEVELS``). Signatures have ``ROOM`` bits or a few more for a key,
so a long document gets a long one. Documents of one signature length
are laid side by side in blocks and stored by rows of bits: slice s holds bit s
of every document of the block, so the documents that may hold a term are the AND of its
slices. The same pass counts the documents of each term.

Search, for a block of items at a time:

1. Bounds. A term's bitmap of a level holds every document that reaches it, and
   some by chance. Weighted sums of an item's bitmaps, times what a level adds
   at most to the score of a document of that length, bound the scores from above.
2. Threshold. The ``FIRST`` documents with the highest bounds are scored exactly; the
   last of their best ``top`` scores is one that the result reaches (0 if fewer score).
3. Rest. Every document whose bound is not below the threshold is scored
   exactly from its text; the others are provably outside. The best ``top`` are the result.

Scores are integers, bounds too: none is rounded down. Shuffled are keys of
candidate documents, partial counts of terms, and texts only where the
candidates' keys are too many for Spark to broadcast. A document is known by a
64-bit hash of its row; if two share one, both are scored from their own texts.

Driver and tasks hold one block of items, ``ITEMS`` or so, with their terms,
weights and thresholds, never documents.

Defined results: null or empty text: no terms, so never in a result and not
counted; very long texts: a longer signature; ties: by doc_id, null last;
repeated documents: each counts and ranks; repeated rows of items: once; items of
the same id and other text: each its own ranks; no document or no term: no
rows; further columns: ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.llm.common import stage

#: Documents of an item's result, and those scored first for its threshold.
TOP, FIRST = 50, 200
HASHES, ROOM = 4, 16
#: Numbers of occurrences that have bits of their own; between two of them the bound takes the higher.
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)
#: Bits of a block of signatures, and its most and fewest documents.
BLOCK, MOST, FEWEST = 1 << 23, 1024, 8
#: Items searched at once, on average; hashes and counts of terms kept by a task.
ITEMS, TERMS = 256, 200_000
# What is no part of a term, in bytes; A-Z lower-cased.
_READ = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLOCK_ROW = "slots bigint, docs bigint, words bigint, keys binary, lengths binary, slices binary, term binary, df bigint"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_READ).split()


class _Hashes(dict):
    def __missing__(self, term):
        if len(self) > TERMS:
            self.clear()
        self[term] = h = xxhash.xxh3_64_intdigest(term)
        return h


def _keys(h: np.ndarray, level: int) -> np.ndarray:
    """Keys of the terms hashed ``h`` at a level."""
    k = (h + np.uint64(level)) * _STEP
    return k ^ (k >> np.uint64(31))


def slots_for(keys: int) -> int:
    """The length of a signature of so many keys: one of four in each octave."""
    least = max(64, ROOM * keys)
    step = 1 << (least - 1).bit_length() - 3
    return -(-least // step) * step


def _places(keys: np.ndarray, slots: int) -> np.ndarray:
    """The ``HASHES`` places of each key in a signature."""
    low, high = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    i = np.arange(HASHES, dtype=np.uint64)
    return ((low[:, None] + i * high[:, None]) % np.uint64(slots)).astype(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"))


def signatures(docs: DataFrame) -> DataFrame:
    """The index of (k, text): rows of blocks of documents (slots, docs, words, keys,
    lengths, slices), and rows of terms (term, df) that are to be summed."""
    def block(slots: int, rows: list) -> dict:
        n = -(-len(rows) // 8) * 8
        held = np.zeros((slots, n), bool)
        for d, (_, _, places) in enumerate(rows):
            held[places, d] = True
        return {"slots": slots, "docs": len(rows), "words": sum(r[1] for r in rows),
                "keys": np.array([r[0] for r in rows], np.int64).tobytes(),
                "lengths": np.array([r[1] for r in rows], np.int64).tobytes(),
                "slices": np.packbits(held, axis=1, bitorder="little").tobytes()}

    def batch(rows: list[dict]) -> pa.RecordBatch:
        kinds = [("slots", pa.int64()), ("docs", pa.int64()), ("words", pa.int64()), ("keys", pa.binary()), ("lengths", pa.binary()),
                 ("slices", pa.binary()), ("term", pa.binary()), ("df", pa.int64())]
        return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, hashes, df = defaultdict(list), _Hashes(), Counter()
        for b in batches:
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                terms = terms_of(text)
                if not terms:
                    continue
                tf = Counter(terms)
                df.update(tf.keys())
                h = np.fromiter(map(hashes.__getitem__, tf), np.uint64, len(tf))
                n = np.fromiter(tf.values(), np.int64, len(tf))
                keys = np.concatenate([_keys(h[n >= least], least) for least in LEVELS])
                slots = slots_for(len(keys))
                waiting[slots].append((k, len(terms), _places(keys, slots).ravel()))
                if len(waiting[slots]) == min(MOST, max(FEWEST, BLOCK // slots)):
                    yield batch([block(slots, waiting.pop(slots))])
                if len(df) > TERMS:
                    yield batch([{"term": t, "df": c} for t, c in df.items()])
                    df.clear()
        for slots in list(waiting):
            yield batch([block(slots, waiting.pop(slots))])
        if df:
            yield batch([{"term": t, "df": c} for t, c in df.items()])

    return docs.select("k", "text").mapInArrow(run, _BLOCK_ROW)


class Items:
    """A block of items: their terms' hashes and weights, and what scoring needs of the corpus."""

    def __init__(self, terms: list[list[bytes]], df: dict[bytes, int], n: int, total: int):
        self.n, self.total = n, total
        self.vocabulary = sorted(df)
        number = {t: i for i, t in enumerate(self.vocabulary)}
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in self.vocabulary], np.uint64)
        self.weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in self.vocabulary]
        self.terms = [[number[t] for t in of if t in number] for of in terms]

    def bounds(self, row: dict) -> tuple[np.ndarray, np.ndarray]:
        """(keys, bounds): of the block's documents, and of each item's score in each."""
        keys, lengths = np.frombuffer(row["keys"], np.int64), np.frombuffer(row["lengths"], np.int64)
        slices = np.frombuffer(row["slices"], np.uint8).reshape(row["slots"], -1)
        weight, m = np.array(self.weight, np.float64), self.evenness(lengths)
        bound = np.zeros((len(self.terms), len(keys)), np.int64)
        before, held = 0, None
        for level, after in zip(LEVELS, [*LEVELS[1:], None]):
            places = _places(_keys(self.hashes, level), row["slots"])
            now = np.bitwise_and.reduce([slices[places[:, i]] for i in range(HASHES)])
            held = now if held is None else held & now                # a level holds all of the next
            most = after and after - 1
            worth = 10**9 * most // (1000 * most + 20 * m) if most else np.full(len(m), 10**6)
            there = np.unpackbits(held, axis=1, count=len(keys), bitorder="little")
            for q, of in enumerate(self.terms):
                bound[q] += (weight[of] @ there[of]).astype(np.int64) * (worth - before)
            before = worth
        return keys, bound

    def evenness(self, lengths):
        return 50 + 50 * lengths * self.n // self.total

    def score(self, q: int, tf: dict[int, int], m: int) -> int:
        return sum(self.weight[t] * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in self.terms[q] if t in tf)


def _bounded(index: DataFrame, items: Items, choose, finish) -> DataFrame:
    """(q, k, bound) of the documents that ``choose`` takes from each block, and ``finish`` at the end of a task."""
    def batch(q, k, bound) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(k, pa.int64()), pa.array(bound, pa.int64())],
                                          ["q", "k", "bound"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for b in batches:
            for row in b.to_pylist():
                found = choose(state, *items.bounds(row))
                if found is not None and len(found[0]):
                    yield batch(*found)
        found = finish(state)
        if found is not None:
            yield batch(*found)

    return index.where("slots IS NOT NULL").select("slots", "keys", "lengths", "slices").mapInArrow(
        run, "q int, k bigint, bound bigint")


def highest(index: DataFrame, items: Items, top: int) -> DataFrame:
    """Each item's ``top`` documents by bound."""
    def choose(state, keys, bound):
        keys = np.broadcast_to(keys, bound.shape)
        if state:
            keys, bound = np.hstack([state["k"], keys]), np.hstack([state["b"], bound])
        if bound.shape[1] > top:
            at = np.argpartition(-bound, top - 1, axis=1)[:, :top]
            keys, bound = np.take_along_axis(keys, at, 1), np.take_along_axis(bound, at, 1)
        state["k"], state["b"] = keys, bound

    def finish(state):
        if state:
            q, d = np.nonzero(state["b"] > 0)
            return q, state["k"][q, d], state["b"][q, d]

    by = Window.partitionBy("q").orderBy(F.desc("bound"), "k")
    return (_bounded(index, items, choose, finish).withColumn("at", F.row_number().over(by))
            .where(F.col("at") <= top).select("q", "k"))


def not_excluded(index: DataFrame, items: Items, thresholds: dict[int, int]) -> DataFrame:
    """All (q, k) whose bound is above 0 and not below the item's threshold."""
    least = np.array([max(1, thresholds.get(q, 0)) for q in range(len(items.terms))], np.int64)

    def choose(state, keys, bound):
        q, d = np.nonzero(bound >= least[:, None])
        return q, keys[d], bound[q, d]

    return _bounded(index, items, choose, lambda state: None).select("q", "k")


def rescored(keyed: DataFrame, pairs: DataFrame, items: Items) -> DataFrame:
    """(q, doc_id, score): exact scores above 0 of the documents of ``pairs`` (q, k)."""
    number = {t: i for i, t in enumerate(items.vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for at, (text, qs) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                terms = terms_of(text)
                tf = Counter(number[t] for t in terms if t in number)
                m = items.evenness(len(terms))
                rows += [(q, at, s) for q in qs if (s := items.score(q, tf, m)) > 0]
            q, at, s = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), b.column(0).take(pa.array(at, pa.int64())), pa.array(s, pa.int64())],
                ["q", "doc_id", "score"])

    # written first, so that Spark knows its size before it plans to shuffle the texts
    wanted = stage(pairs.groupBy("k").agg(F.collect_set("q").alias("qs")), "lexical-candidates")
    kind = keyed.schema["doc_id"].dataType.simpleString()
    return (keyed.join(wanted, "k").select("doc_id", "text", "qs")
            .mapInArrow(run, f"q int, doc_id {kind}, score bigint"))


def _best(scores: DataFrame, top: int) -> DataFrame:
    by = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, at_once: int = ITEMS, first: int = FIRST) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    index = stage(signatures(keyed), "lexical-index")
    items = benchmark.select("item_id", "text").distinct()
    parts = max(1, -(-items.count() // at_once))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    n, total = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.sum("words")).first()
    out = []
    for part in range(parts if n else 0):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        terms = [list(dict.fromkeys(terms_of(r["text"]))) for r in rows]
        asked = spark.createDataFrame([(bytearray(t),) for t in sorted({t for of in terms for t in of})], "term binary")
        df = {bytes(r["term"]): r["df"] for r in index.where("term IS NOT NULL").join(asked, "term", "left_semi")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()}
        if not df:
            continue
        block = Items(terms, df, n, total)
        tried = _best(rescored(keyed, highest(index, block, max(top, first)), block), top)
        reached = tried.where(F.col("rank") == top).select("q", "score").collect()
        pairs = not_excluded(index, block, {r["q"]: r["score"] for r in reached})
        best = stage(_best(rescored(keyed, pairs, block), top), "lexical-best")
        names = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(rows)], f"q int, item_id {kind}")
        out.append(best.join(names, "q").select("item_id", "rank", "doc_id", "score"))
    empty = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score bigint")
    return reduce(DataFrame.unionByName, out) if out else empty
