"""Quality rules with risk-controlled cutoffs, in DataFrame expressions only.

Each rule is a share between 0 and 1 that is high in junk. For every stratum
(a language of ``STRATA``, all others together) and rule, the labelled rows
(``labels``: quality 1 is good) that pass the base rules are the holdout on
which cutoffs of the grid are tested: with n good rows of which k lie above the
cutoff, the null hypothesis "more than ``risk`` / rules of good rows are
rejected" is refused if the exact binomial tail P(Bin(n, risk / rules) <= k)
is at most ``delta`` divided by the number of all tests (Bonferroni over
strata, rules and cutoffs). So with probability 1 - delta no stratum loses
more than ``risk`` of its good rows, all rules together. Of the cutoffs that
hold, the one rejecting most bad rows is taken, the highest of those on ties;
a rule that rejects no bad row, or has too few labels to hold, is off.

Nothing is fitted besides: the counts cover all labelled rows, thresholds are
one row for each of the at most len(strata) + 1 strata (so they are
broadcast), and a text is measured inside its row.

Defined results: null text: as empty, base_failed; empty or very short texts:
base_failed (n_words < 20); null lang: stratum "other"; label rows with null
or repeated doc_id: ignored, or good if any of them is good; empty labels: base
rules only; repeated documents: each gets its row; further columns: ignored
by ``measure``, kept by ``keep_good``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions import let
from tallystone.llm.common import fresh, stage, words

STRATA = ("en", "fr", "de", "es")
RISK, DELTA, WINDOW = 0.02, 0.05, 8
#: Cutoffs tested for every rule.
GRID = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5)
#: Terms of the binomial tail that are added one by one; what is left is below a geometric bound.
TERMS = 4096

#: name -> share, from the counts in the struct column.
RULES = {
    "symbols": lambda q: q["n_symbols"] / q["word_chars"],
    "dup_lines": lambda q: q["n_dup_lines"] / q["n_lines"],
    "repeats": lambda q: q["n_repeat_words"] / q["n_words"],
    "shouted": lambda q: q["n_shouted"] / q["n_words"],
}


def repeat_words(w: Column, size: int = WINDOW) -> Column:
    """Words inside ``size``-word windows that occur twice or more in array ``w``.

    A document whose window hashes are all distinct is done. Otherwise the
    windows are sorted with their hash in front (equal windows become
    neighbours, compared word by word), and each start with an equal
    neighbour covers ``size`` words.
    """
    def window(i):
        return F.slice(w, i, size)

    def covered(s: Column) -> Column:
        n = F.size(s)

        def same(a, b):
            return (a["h"] == b["h"]) & (a["w"] == b["w"])

        hit = F.filter(s, lambda e, i: ((i > 0) & same(e, F.get(s, F.greatest(i - 1, F.lit(0))))) |
                       ((i < n - 1) & same(e, F.get(s, F.least(i + 1, n - 1)))))
        return let(F.array_sort(F.transform(hit, lambda e: e["i"])), lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.when(i == F.size(p) - 1, F.lit(size))
                        .otherwise(F.least(F.lit(size), F.get(p, i + 1) - x))),
            F.lit(0), lambda a, x: a + x))

    starts = F.when(F.size(w) > size, F.sequence(F.lit(1), F.size(w) - (size - 1))).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(window(i)))
    detail = F.transform(starts, lambda i: F.struct(F.xxhash64(window(i)).alias("h"), window(i).alias("w"), i.alias("i")))
    return F.when(let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h)), F.lit(0)).otherwise(
        let(F.sort_array(detail), covered)).cast("long")


def counts(text: Column) -> Column:
    """All counts of a text as one struct column."""
    text = F.coalesce(text, F.lit(""))

    def of(w: Column) -> list[Column]:
        return [
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0), lambda a, x: a + F.char_length(x)).cast("long").alias("word_chars"),
            F.size(F.filter(w, lambda x: x.endswith("!!"))).cast("long").alias("n_shouted"),
            repeat_words(w).alias("n_repeat_words")]

    def lines(x: Column) -> list[Column]:
        return [F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")]

    by_word = let(words(text), lambda w: F.struct(*of(w)))
    with_word = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_line = let(with_word, lambda x: F.struct(*lines(x)))
    symbols = (F.char_length(text) - F.char_length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long")
    return let(F.struct(by_word.alias("w"), by_line.alias("l"), symbols.alias("s")), lambda q: F.struct(
        *[q["w"][c].alias(c) for c in ("n_words", "word_chars", "n_repeat_words", "n_shouted")],
        *[q["l"][c].alias(c) for c in ("n_lines", "n_dup_lines")], q["s"].alias("n_symbols"),
        ((q["w"]["n_words"] < 20) | (100 * q["w"]["n_repeat_words"] > 30 * q["w"]["n_words"])).alias("base_failed")))


def stratum(lang: Column, strata=STRATA) -> Column:
    return F.when(lang.isin(*strata), lang).otherwise("other")


def share(rule: str, q: Column) -> Column:
    return F.coalesce(RULES[rule](q).cast("double"), F.lit(0.0))


def _log_gamma(x: Column) -> Column:
    """Stirling's series at x + 8, brought back by the recurrence."""
    y = x + 8
    series = ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
              + 1 / (1260 * F.pow(y, F.lit(5))))
    return series - F.log(reduce(lambda a, b: a * b, [x + i for i in range(8)]))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) where k < n p (else 1: no cutoff holds there).

    The terms fall from k downwards; ``TERMS`` of them are added and the rest
    is replaced by its geometric upper bound, which keeps the test valid.
    """
    kd, nd = k.cast("double"), n.cast("double")
    top = F.exp(_log_gamma(nd + 1) - _log_gamma(kd + 1) - _log_gamma(nd - kd + 1)
                + kd * math.log(p) + (nd - kd) * math.log1p(-p))
    zero = F.struct(top.alias("t"), top.alias("s"))

    def step(a, j):
        t = a["t"] * (kd - j + 1) / (nd - kd + j) * ((1 - p) / p)
        return F.struct(t.alias("t"), (a["s"] + t).alias("s"))

    many = F.least(k, F.lit(TERMS)).cast("int")
    done = let(F.when(many > 0, F.aggregate(F.sequence(F.lit(1), many), zero, step)).otherwise(zero), lambda a: a["s"] + F.when(
        k > TERMS, a["t"] * kd * (1 - p) / (nd * p - kd)).otherwise(0.0))
    return F.when(kd >= nd * p, F.lit(1.0)).otherwise(done)


def thresholds(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
               strata=STRATA) -> DataFrame:
    """One row for each stratum: its cutoff of every rule, null where the rule is off.

    ``measured``: doc_id, stratum, q (of ``counts``).
    """
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        (F.max("quality") >= 1).alias("good"))
    tests = len(RULES) * len(GRID) * (len(strata) + 1)
    held = measured.where(~F.col("q.base_failed")).join(good, "doc_id").select(
        "stratum", "good", *[share(r, F.col("q")).alias(r) for r in RULES])
    above = [F.count(F.when(F.col("good") == g, F.when(F.col(r) > c, 1))).alias(f"{r}_{i}_{int(g)}")
             for r in RULES for i, c in enumerate(GRID) for g in (True, False)]
    agg = held.groupBy("stratum").agg(F.count(F.when(F.col("good"), 1)).alias("n"), *above)
    tried = agg.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cut"), F.col(f"{r}_{i}_1").alias("k"), F.col(f"{r}_{i}_0").alias("bad"))
        for r in RULES for i, c in enumerate(GRID)])).alias("t")).select("stratum", "n", "t.*")
    held = tried.where(F.col("bad") > 0).where(
        binomial_tail(F.col("k"), F.col("n"), risk / len(RULES)) <= delta / tests)
    best = F.struct("bad", "cut")
    return held.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == r, best))["cut"].alias(f"cut_{r}") for r in RULES])


def verdict(q: Column, cuts: dict[str, Column]) -> Column:
    over = reduce(lambda a, b: a | b, [F.coalesce(share(r, q) > cuts[r], F.lit(False)) for r in RULES])
    return ~q["base_failed"] & ~over


def measure(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row of ``docs``."""
    measured = stage(docs.select("doc_id", stratum(F.col("lang")).alias("stratum"), counts(F.col("text")).alias("q")),
                     "quality-counts")
    cuts = thresholds(measured, labels, risk, delta)
    both = measured.join(F.broadcast(cuts), "stratum", "left")
    return both.select(
        "doc_id", *[F.col(f"q.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "q.base_failed", verdict(F.col("q"), {r: F.col(f"cut_{r}") for r in RULES}).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns.

    The counts are written beside the rows: they cost far more than the
    writing, and a filter would make them again.
    """
    q, s = fresh(docs, "quality_counts"), fresh(docs, "quality_stratum")
    scored = stage(docs.withColumns({q: counts(F.col("text")), s: stratum(F.col("lang"))}), "quality-counts")
    cuts = stage(thresholds(scored.select("doc_id", F.col(s).alias("stratum"), F.col(q).alias("q")), labels, risk, delta),
                 "quality-cuts")
    names = {r: fresh(docs, f"quality_cut_{r}") for r in RULES}
    cuts = cuts.select(F.col("stratum").alias(s), *[F.col(f"cut_{r}").alias(names[r]) for r in RULES])
    return scored.join(F.broadcast(cuts), s, "left").where(
        verdict(F.col(q), {r: F.col(names[r]) for r in RULES})).select(*docs.columns)
