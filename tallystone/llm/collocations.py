"""Phrase collocation mining by top-order marginalisation.

Only the longest windows are counted: for every word occurrence the word and
the next ``ORDER - 1`` of its piece, as lead columns, padded with empty strings
where the piece ends. The occurrences of a shorter phrase are the windows that
begin with it, so one ROLLUP over the counted windows sums up all shorter
prefixes; no n-gram of another length is ever made.

1. Filter. A phrase that occurs ``least`` times is made of pairs and triples of
   neighbours that do. They are counted by a 64-bit hash of language and words
   (triples only where both pairs are in the filter), and those with ``least`` or
   more set their bits in a filter of ``BITS`` bits. That is all that reaches the
   driver and the tasks, however large the corpus.
2. Windows. A window is broken off, and padded, before a pair or triple that the
   filter does not hold: no counted phrase loses an occurrence, and the first word
   always stays. What the filter holds by chance is only counted for nothing;
   beyond some 10^8 entries it holds all and saves nothing, with the same rows. Windows are counted in blocks inside a task, then over all tasks; one
   under ``least`` is of use for its prefixes alone and gives up its last word
   before the ROLLUP.
3. Phrases with ``least`` occurrences or more, with their counts, are the result
   of the ROLLUP; all parts of a candidate are among them.
4. Cuts, scores and the comparison with longer candidates are joins of that
   table with itself; scores are exact in decimals of 38 digits, by a long
   division in two steps.

Words are told apart by their bytes from step 2 on; hashes only filter.
A language's words are spread over all tasks; its first ``top`` phrases are
taken by a ranked window, which Spark cuts to ``top`` rows in each task before
the shuffle.

Defined results: null lang: ``und``, together with a language of that name; null or
empty text: no words; very long texts: read in blocks of ``BLOCK`` bytes with
the last words of a block carried over; ties in score and count: by the
phrase's bytes, so ranks are unique; repeated rows: each counts; empty table: no rows;
further columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.llm.common import stage

ORDER, LEAST, TOP, SHARE, SCALE = 4, 30, 2000, 80, 2_000_000
#: Bytes of text counted at once in a task, and pairs whose hashes are.
BLOCK, PAIRS = 3_000_000, 4_000_000
#: Bits of the filter of frequent pairs and triples: 16 MiB.
BITS = 1 << 27
# What separates pieces, and words inside a piece.
_BREAKS, _GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
_LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_READ = bytes.maketrans(_LOWER[0] + _BREAKS + _GAPS, _LOWER[1] + b"\n" * len(_BREAKS) + b" " * len(_GAPS))
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Block:
    """Words of some texts in order, breaks between them, and each one's language.

    ``open``: so many words at the end have their windows counted in the next block.
    """

    def __init__(self):
        self.texts: list[bytes] = []
        self.langs: list[str] = []
        self.size = self.open = 0

    def add(self, lang: str, raw: bytes) -> None:
        self.texts.append(raw.replace(b"\n", b" \n ") + b" ")
        self.langs.append(lang)
        self.size += len(raw)

    def last(self, n: int) -> list[bytes]:
        """The last ``n`` words, or those since the last break."""
        found: list[bytes] = []
        for t in (t for text in reversed(self.texts) for t in reversed(text.split(b" "))):
            if len(found) == n or t == b"\n":
                break
            if t:
                found.append(t)
        return found[::-1]

    def arrays(self):
        """Ids of the words (0: break), numbers of their languages, the words and languages by number; gives up the texts."""
        lengths, raw = np.fromiter(map(len, self.texts), np.int64, len(self.texts)), b"".join(self.texts)
        self.texts = []
        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == ord(" ")) + 1
        # a word is read with the space after it, so that words lie side by side
        found = pa.Array.from_buffers(pa.large_binary(), len(ends), [
            None, pa.py_buffer(np.r_[0, ends].astype(np.int64)), pa.py_buffer(raw)]).dictionary_encode()
        words = [b"", *(w[:-1] for w in found.dictionary.to_pylist())]
        number = np.arange(1, len(words), dtype=np.int32)
        for i, w in enumerate(words[1:]):
            if w in (b"", b"\n"):
                number[i] = 0 if w else -1               # a break; nothing between two gaps
        ids = number[found.indices.to_numpy()]
        names = {lang: i for i, lang in enumerate(dict.fromkeys(self.langs))}
        langs = np.repeat(np.array([names[lang] for lang in self.langs], np.int32),
                          np.diff(np.searchsorted(ends, np.cumsum(lengths), "right"), prepend=0))
        keep = ids >= 0
        return ids[keep], langs[keep], words, list(names)


def blocks(batches: Iterator[pa.RecordBatch], order: int, size: int = BLOCK) -> Iterator[Block]:
    """The texts (lang, text) of a partition as blocks of about ``size`` bytes."""
    now = Block()
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang, raw, kept = lang.as_py(), (text.as_py() or "").encode().translate(_READ), 0
            while now.size + len(raw) > 2 * size:
                # the last gap within the block, or the first after it; beyond the words carried over
                least = max(kept + 1, size - now.size)
                at = max(raw.rfind(gap, kept + 1, least) for gap in (b" ", b"\n"))
                if at < 0:
                    at = min((x for x in (raw.find(b" ", least), raw.find(b"\n", least)) if x >= 0), default=-1)
                if at < 0:
                    break
                now.add(lang, raw[:at])
                carried = now.last(order - 1)
                now.open = len(carried)
                yield now
                now = Block()
                carried = b" ".join(carried)
                raw, kept = carried + raw[at:], len(carried)
            if raw:
                now.add(lang, raw + b"\n")
            if now.size > size:
                yield now
                now = Block()
    if now.size:
        yield now


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * _MIX[2]
    return h ^ (h >> np.uint64(32))


def _hashes(ids: np.ndarray, langs: np.ndarray, words: list[bytes], names: list[str], most: int) -> list[np.ndarray]:
    """64-bit hashes of language and of the 2, 3 .. ``most`` words from each place on."""
    w = np.array([xxhash.xxh3_64_intdigest(x) for x in words], np.uint64)[ids]
    h = w * _MIX[0] + np.array([xxhash.xxh3_64_intdigest(x, 1) for x in names], np.uint64)[langs]
    out = []
    for n in range(2, most + 1):
        h = _mixed(h[:-1] * _MIX[1] + w[n - 1:])
        out.append(h)
    return out


def _goes_on(ids: np.ndarray, hashes: list[np.ndarray], bits: np.ndarray) -> np.ndarray:
    """The number of words from each place on that the filter and the piece's end allow, up to one more than
    the longest hashed; all their inner pairs, triples and so on are in the filter."""
    reach = (ids > 0).astype(np.int8)
    held = [_in_filter(bits, h) & (ids[:len(h)] > 0) & (ids[i + 1:] > 0) for i, h in enumerate(hashes)]
    for length in range(2, len(hashes) + 3):
        # all parts of ``length`` words are held where all shorter ones are, from here and from the next place
        here, after = reach[:-1] >= length - 1, reach[1:] >= length - 1
        more = np.zeros(len(ids), bool)
        more[:-1] = here & after
        if length - 2 < len(held):
            more[:len(held[length - 2])] &= held[length - 2]
            more[len(held[length - 2]):] = False
        reach = np.where(more, np.int8(length), reach)
    return reach


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def set_frequent(texts: DataFrame, bits: np.ndarray, length: int, least: int, size: int = BLOCK) -> None:
    """Set the filter's bits of all ``length`` neighbours that occur ``least`` times or more; shorter ones are set."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def batch(hashes: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(hashes), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], ["h", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for block in blocks(batches, length, size):
            ids, langs, words, names = block.arrays()
            if len(ids) >= length:
                *shorter, h = _hashes(ids, langs, words, names, length)
                whole = (_goes_on(ids, shorter, shared.value) >= length)[:len(h)]
                whole[len(ids) - block.open:] = False
                held.append(h[whole].view(np.int64))
            if sum(map(len, held)) > PAIRS:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    frequent = (texts.mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
                .where(F.col("n") >= least))
    mask = len(bits) * 64 - 1
    places = frequent.select(F.explode(F.array(F.col("h").bitwiseAND(mask),
                                               F.shiftrightunsigned("h", 32).bitwiseAND(mask))).alias("p"))
    found = (places.groupBy(F.shiftright("p", 6).alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("word")).toArrow())
    bits[found["at"].to_numpy()] |= found["word"].to_numpy().view(np.uint64)


def _in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(bits) * 64 - 1)
    found = np.ones(len(h), bool)
    for p in (h & mask, (h >> np.uint64(32)) & mask):
        found &= (bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) > 0
    return found


def counted_windows(texts: DataFrame, bits: np.ndarray, order: int = ORDER, size: int = BLOCK) -> DataFrame:
    """(lang, words, n): windows that the filter allows, their words joined by spaces up to the padding, counted in blocks."""
    columns = [f"w{i + 1}" for i in range(order)]
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, order, size):
            ids, langs, words, names = block.arrays()
            if not len(ids):
                continue
            reach = _goes_on(ids, _hashes(ids, langs, words, names, order - 1), shared.value)
            starts = np.flatnonzero(ids[:len(ids) - block.open] > 0)
            padded = np.r_[ids, np.zeros(order, ids.dtype)]
            lead = [np.where(reach[starts] > i, padded[starts + i], 0) for i in range(order)]
            found = pa.table([langs[starts], *lead], names=["lang", *columns]).group_by(
                ["lang", *columns], use_threads=False).aggregate([([], "count_all")])
            spelled = pa.array([w or None for w in words], pa.binary()).cast(pa.string())
            joined = pc.binary_join_element_wise(*[spelled.take(found[c].combine_chunks()) for c in columns], " ",
                                                 null_handling="skip")
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()).take(found["lang"].combine_chunks()), joined,
                 found["count_all"].combine_chunks().cast(pa.int64())], ["lang", "words", "n"])

    return texts.mapInArrow(count, "lang string, words string, n bigint")


def phrase_counts(docs: DataFrame, least: int = LEAST, order: int = ORDER, bits: int = BITS, size: int = BLOCK) -> DataFrame:
    """(lang, k, words, phrase, f): every phrase of 1 to ``order`` words with f >= ``least`` occurrences,
    and for each language a row of k = 0 with the number of its words."""
    texts = _texts(docs)
    columns = [f"w{i + 1}" for i in range(order)]
    held = np.zeros(bits // 64, np.uint64)
    for length in range(2, order):
        set_frequent(texts, held, length, least, size)
    windows = counted_windows(texts, held, order, size)
    windows = windows.groupBy("lang", "words").agg(F.sum("n").alias("n")).withColumn("w", F.split("words", " "))
    # a longest window too rare to be a phrase counts for its prefixes only
    last = F.when((F.col("n") >= least) & (F.size("w") == order), F.element_at("w", -1)).otherwise("")
    windows = windows.select("lang", "n", *[F.coalesce(F.get("w", F.lit(i)), F.lit("")).alias(c)
                                            for i, c in enumerate(columns[:-1])], last.alias(columns[-1]))
    sums = windows.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    k = F.lit(order) - F.round(F.log2(F.col("g") + 1)).cast("int")           # the columns that a row still has
    # prefixes that end in padding are no phrases; Spark drops them before the shuffle
    ends = [F.col("g").isin(2 ** order - 1, 2 ** order // 2 - 1)]
    ends += [(F.col("g") == 2 ** i - 1) & (F.col(c) != "") for i, c in enumerate(reversed(columns[1:]))]
    return (sums.where(reduce(Column.__or__, ends))
            .select("lang", k.alias("k"), F.slice(F.array(*columns), 1, k).alias("words"), "f")
            .where((F.col("k") == 0) | (F.col("f") >= least))
            .select("lang", "k", "words", F.array_join("words", " ").alias("phrase"), "f"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE, order: int = ORDER,
                 **sizes) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two words or more.

    a: occurrences; l, r: those of the phrase's parts at the cut that gives the
    lowest score; score: floor(SCALE * a / (l + r)). A candidate inside a longer one
    with at least ``share`` percent of its occurrences is left out.
    """
    counts = stage(phrase_counts(docs, least, order, **sizes), "collocations-counts")
    total = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    parts = counts.where(F.col("k").between(1, order - 1)).select("lang", "phrase", "f")
    cands = counts.where("k >= 2")

    def joined(first, n):
        return F.array_join(F.slice("words", first, n), " ")

    cuts = cands.select("lang", "phrase", "words", "k", F.col("f").alias("a"), F.explode(
        F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", joined(F.lit(1), F.col("cut")).alias("first"),
                       joined(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr(f"(CAST(a AS DECIMAL(19, 0)) * CAST({SCALE} AS DECIMAL(7, 0))) "
                   "div (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))")
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
              .withColumn("score", score)
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low")))

    inner = cands.where("k >= 3").select("lang", "words", "k", "f", F.explode(
        F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "words", "f", "size", F.explode(
        F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("first"))
    longer = (inner.select("lang", joined(F.col("first"), F.col("size")).alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (scored.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull()
                   | (F.col("longer").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * share)))
    by = Window.partitionBy("lang").orderBy(F.desc("low.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "low.l", "low.r", "n", "low.score")
