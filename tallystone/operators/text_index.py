"""Positional index of texts (X9, J3): keyword phrases found by positions, snippets cut from offsets.

``build_text_index`` reads every text once and writes three tables below a
folder:

* ``postings`` (raw, range, id, at), one row for each document and
  spelling, sorted by a range of the spelling's hash for every ``PIECE`` characters of text; ``at``
  has a word's position above its start (``START`` bits); a term of a third of all documents is
  that many rows, never one list;
* ``terms``: the spellings with their range and folded form;
* ``blocks``: the texts in overlapping parts of ``BLOCK`` characters, with
  ``MARGIN`` more on both sides.

``search_text_index`` looks the words of the keywords up in ``terms`` (the first
may end a word of the text and the last begin one, a single one lie inside it,
as in a search for the literal) and reads the ranges that have them. A keyword that is
one word is compared with the spellings, once each, and its matches are the
starts of their postings. Of the others, runs of consecutive positions are kept by one partial
aggregation, and the signs between the words are compared in the blocks of these
runs. Matches of a document and keyword come together as starts, are numbered
there, and meet the blocks that their snippets are cut from.
No text is searched for a keyword. Folded forms join at least what a search
without case takes for equal; the comparison with the spelling or at the block decides.

Defined results: null or empty text: not found; repeated id: an error when the
index is built, ids name rows; null id: left out; a keyword without letter or
digit: an error, the index has no word of it; empty table: an empty index; very
long texts: split to blocks, one document's words are held at a time.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.operators.reconcile import _clean, _literal_ci_pattern
from tallystone.schemas import SNIPPET_AFTER, SNIPPET_BEFORE
from tallystone.session import shared_dir

#: Characters of texts whose words are sorted at once in a task, and spellings of a search that every task may hold.
PIECE, HELD = 8_000_000, 200_000
BLOCK, MARGIN, RANGES, ROWS, SEGMENT, START = 4096, 512, 64, 4096, 4 << 20, 32
#: Words: letters and digits of any script, and the mark that has a letter as upper case.
WORD = re.compile("(?:[^\\W_]|\u0345)+")
_CUT = re.compile(f"({WORD.pattern})")


def folded(c: Column) -> Column:
    """One form of all spellings that a search without case takes for equal."""
    # The optimizer would take lower(upper(x)) for lower(x); what stands between keeps both.
    for case in (F.lower, F.upper, F.lower):
        c = F.translate(case(c), "\u03c2\u0307", "\u03c3")
    return c


def build_text_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the index of ``docs`` below ``path``."""
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    if not given.groupBy("id").count().where("count > 1").isEmpty():
        raise ValueError(f"{id_col} is repeated")
    kind = given.schema["id"].dataType.simpleString()

    def postings(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        words: list[str] = []
        starts, counts = [], []
        for text in texts:
            cut = _CUT.split(text)                             # what lies between words, and words, in turn
            words += cut[1::2]
            starts.append(np.cumsum(np.fromiter(map(len, cut), np.int32, len(cut)))[:-1:2])
            counts.append(len(cut) // 2)
        of = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        spelled = pa.array(words, pa.string()).dictionary_encode()
        ranges = np.array([zlib.crc32(w.encode()) % RANGES for w in spelled.dictionary.to_pylist()], np.int32)
        # spellings by range, and so all rows of this piece: a search skips pages of the file
        by_range = np.argsort(ranges, kind="stable")
        number = np.empty_like(by_range)
        number[by_range] = np.arange(len(by_range))
        key = number[spelled.indices.to_numpy()] * len(texts) + of
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        word, doc = by_range[key[order[first]] // max(1, len(texts))], of[order[first]]
        at = (place << START | np.concatenate(starts))[order]
        return pa.RecordBatch.from_arrays(
            [spelled.dictionary.take(pa.array(word)), pa.array(ranges[word]), ids.take(pa.array(doc)),
             pa.ListArray.from_arrays(pa.array(np.r_[first, len(order)].astype(np.int32)), pa.array(at))], ["raw", "range", "id", "at"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            after = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
            cuts = [0, *(np.flatnonzero(np.diff(after // PIECE) > 0) + 1), len(texts)]
            for low, high in itertools.pairwise(cuts):
                if high > low:
                    yield postings(b.column("id").slice(low, high - low), texts[low:high])

    def parts(f: pd.DataFrame) -> Iterator[tuple]:
        for key, text in zip(f["id"], f["text"]):
            for a in range(0, len(text), BLOCK):
                yield key, a // BLOCK, max(0, a - MARGIN), text[max(0, a - MARGIN):a + BLOCK + MARGIN]

    def batched(made, names: list[str]):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in itertools.batched((row for f in frames for row in made(f)), ROWS):
                yield pd.DataFrame(rows, columns=names)
        return run

    spark = docs.sparkSession
    # Every task writes its documents' postings as they come, sorted: no shuffle.
    (given.mapInArrow(words, T.StructType([T.StructField("raw", T.StringType()), T.StructField("range", T.IntegerType()),
                                           given.schema["id"], T.StructField("at", T.ArrayType(T.LongType()))]))
     .write.options(**{"parquet.block.size": SEGMENT, "compression": "zstd"}).parquet(f"{path}/postings"))
    (_read(spark, path, "postings", kind).select("raw", "range").distinct().withColumn("term", folded(F.col("raw")))
     .write.parquet(f"{path}/terms"))
    given.mapInPandas(batched(parts, ["id", "block", "low", "part"]), f"id {kind}, block int, low int, part string").write.option("compression", "zstd").parquet(f"{path}/blocks")


def _read(spark: SparkSession, path: str, name: str, kind: str) -> DataFrame:
    schema = {"postings": f"raw string, range int, id {kind}, at array<bigint>",
              "terms": "raw string, range int, term string", "blocks": f"id {kind}, block int, low int, part string"}[name]
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def keyword_words(keyword: str) -> list[tuple[str, str, int]]:
    """(word, how it lies in a word of the text, characters before it in the keyword) of each word of a keyword."""
    found = list(WORD.finditer(keyword))
    if not found:
        raise ValueError(f"no letter or digit in keyword {keyword!r}")
    out = []
    for m in found:
        open_left, open_right = m.start() == 0, m.end() == len(keyword)
        how = "in" if open_left and open_right else "end" if open_left else "begin" if open_right else "whole"
        out.append((m[0], how, m.start()))
    return out


def search_text_index(spark: SparkSession, path: str, keywords: Sequence[tuple[str, int, str]], id_col: str = "doc_id",
                      before: int = SNIPPET_BEFORE, after: int = SNIPPET_AFTER, wanted: DataFrame | None = None) -> DataFrame:
    """Every match of the (concept, kw_pos, keyword) list: (id, concept, kw_pos, keyword, match_idx, snippet).

    ``wanted`` (id, concept), if given, restricts the search to a document's own concepts (J3).
    """
    if before > MARGIN or any(len(k) + after > MARGIN for _, _, k in keywords):
        raise ValueError(f"snippets reach {MARGIN} characters at most")
    kind = spark.read.parquet(f"{path}/blocks").schema["id"].dataType.simpleString()
    # The keyword list is a parameter of the search: its words stand in the plan.
    rows = [(n, i, w, how, lead, len(w), len(keyword_words(k)), len(k), k)
            for n, (_, _, k) in enumerate(keywords) for i, (w, how, lead) in enumerate(keyword_words(k))]
    asked = spark.createDataFrame(rows, "kw int, nth int, word string, how string, lead int, wlen int, words int, klen int, keyword string")
    fixed = F.array(*[F.struct(F.lit(r["kw"]).alias("kw"), F.lit(r["nth"]).alias("nth"), F.lit(r["fold"]).alias("fold"), F.lit(r["how"]).alias("how"))
                      for r in asked.select("kw", "nth", "how", folded(F.col("word")).alias("fold")).collect()])
    phrases = spark.createDataFrame([(n, c, int(p), k, len(k), _overlaps(k)) for n, (c, p, k) in enumerate(keywords)],
                                    "kw int, concept string, kw_pos int, keyword string, klen int, overlaps boolean")
    term = F.col("term")
    last = F.length("raw") - F.col("wlen")
    inside = F.when(F.col("how") == "in", F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))) \
        .when(F.col("how") == "end", F.array(last)).otherwise(F.array(F.lit(0)))
    literal = F.concat(F.lit("^(?:"), _literal_ci_pattern(F.col("keyword")), F.lit(")$"))

    def equal(text: Column, at: Column) -> Column:
        part = F.substring(text, at + 1, F.col("klen"))
        return (part == F.col("keyword")) | (F.regexp_count(part, literal) == 1)

    hits = (_read(spark, path, "terms", kind).withColumn("hit", F.explode(F.filter(fixed, lambda a: (
        F.when(a["how"] == "in", F.contains(term, a["fold"])).when(a["how"] == "end", F.endswith(term, a["fold"]))
        .when(a["how"] == "begin", F.startswith(term, a["fold"])).otherwise(term == a["fold"])))))
        .select("raw", "range", "hit.kw", "hit.nth").join(F.broadcast(asked), ["kw", "nth"])
        .withColumn("alone", F.col("wlen") == F.col("klen"))
        .withColumn("inside", F.when(F.col("nth") == 0, F.coalesce(inside, F.array().cast("array<int>"))))
        .withColumn("inside", F.when(F.col("alone"), F.filter("inside", lambda i: equal(F.col("raw"), i))).otherwise(F.col("inside")))
        .where("not alone or size(inside) > 0").select("raw", "range", "kw", "nth", "words", "lead", "alone", "inside"))
    # Written, so that joins know how few they are.
    hits.write.parquet(at_ := shared_dir(spark, "text-index-hits"))
    fits = spark.read.schema(hits.schema).parquet(at_)

    def posted(alone: bool) -> DataFrame:
        some = fits.where(F.col("alone") == alone)
        found = some.groupBy("range").count().collect()                       # at most RANGES numbers
        some = F.broadcast(some) if sum(r["count"] for r in found) <= HELD else some
        out = _read(spark, path, "postings", kind).where(F.col("range").isin([r["range"] for r in found])).join(some, ["range", "raw"])
        if wanted is not None:
            own = (wanted.select(F.col(id_col).alias("id"), "concept").distinct()
                   .join(phrases.select("concept", "kw"), "concept").select("id", "kw"))
            out = out.join(own, ["id", "kw"], "left_semi")
        return out

    def starts_of(c: str) -> Column:
        return F.sort_array(F.flatten(F.collect_list(c))).alias("all")

    def start(at: Column) -> Column:
        return at.bitwiseAND(F.lit((1 << START) - 1)).cast("int")

    # A keyword that is one word: its spelling is all there is to compare.
    single = posted(True).select("id", "kw", F.flatten(F.transform("inside", lambda i: F.transform("at", lambda x: start(x) + i))).alias("at")) \
        .groupBy("id", "kw").agg(starts_of("at"))
    blocks = _read(spark, path, "blocks", kind)
    matches = single
    if any(not r[5] == r[7] for r in rows):
        runs = (posted(False).withColumn("z", F.explode("at"))              # one row for each word of the keyword list
                .select("id", "kw", (F.shiftright("z", START).cast("int") - F.col("nth")).alias("run"), "words",
                        F.transform("inside", lambda i: start(F.col("z")) + i - F.col("lead")).alias("first"))
                .groupBy("id", "kw", "run").agg(F.count("*").alias("n"), F.max("words").alias("words"), F.max("first").alias("first"))
                .where("n = words"))
        places = runs.select("id", "kw", F.explode("first").alias("start")).where("start >= 0").withColumn("block", F.floor(F.col("start") / BLOCK).cast("int"))
        beside = places.join(blocks, ["id", "block"]).join(F.broadcast(phrases), "kw")
        several = beside.where(equal(F.col("part"), F.col("start") - F.col("low"))).groupBy("id", "kw").agg(
            F.sort_array(F.collect_list("start")).alias("all"))
        matches = single.unionByName(several)
    # Matches of one document and keyword, first come first: one that starts in the last taken one is none.
    step = F.aggregate("all", F.struct(F.lit(-1).alias("end"), F.array().cast("array<int>").alias("kept")),
                       lambda acc, m: F.when(m >= acc["end"], F.struct((m + F.col("klen")).alias("end"),
                                             F.concat(acc["kept"], F.array(m)).alias("kept"))).otherwise(acc), lambda acc: acc["kept"])
    found = (matches.join(F.broadcast(phrases), "kw").withColumn("all", F.when(F.col("overlaps"), step).otherwise(F.col("all")))
             .select("id", "concept", "kw_pos", "keyword", "klen", F.posexplode("all").alias("match_idx", "start"))
             .withColumn("block", F.floor(F.col("start") / BLOCK).cast("int")))
    off = F.col("start") - F.col("low")
    lead = F.least(off, F.lit(before))
    return found.join(blocks, ["id", "block"]).select(
        F.col("id").alias(id_col), "concept", "kw_pos", "keyword", "match_idx",
        _clean(F.substring("part", off - lead + 1, lead + F.col("klen") + after)).alias("snippet"))


def _overlaps(keyword: str) -> bool:
    """Whether two matches of a keyword can overlap: some end of it is a beginning, in any case."""
    k = keyword.upper().lower()
    return any(k.startswith(k[i:]) for i in range(1, len(k)))
