"""Ordinal cumulative-link regression on graded ratings.

Grades (from labels: 0 low quality, 1 good but toxic, 2 good) follow
P(grade >= j) = logistic(w x - theta_j) with one weight vector for all
thresholds theta_1 < theta_2 (their gaps are kept positive by a softplus). x
marks the distinct words of a text, lower case, and their last two
characters, hashed into ``BUCKETS`` and scaled to length one. The model gives
the expected grade and the tail P(grade >= 2) by which texts are selected: the
cutoff is the highest at which a holdout keeps ``KEEP`` of its top grade.

Fitted on at most ``SAMPLE`` labelled documents, taken by id hash, three quarters
to train and one to set the cutoff; of the texts of a repeated doc_id the smallest
in binary order teaches, so the fit does not depend on where rows lie. They reach
the driver as one bit for each bucket (24 MB at most). Every text is scored whole.

Defined results: null or empty text: scored with no feature; labels with null
doc_id or quality: ignored; repeated labels of a document: its lowest grade;
no labels, or of one grade only: expected_grade and p_top null, kept true;
null or repeated doc_id in documents: each row gets its row; empty table: no
rows; further columns: ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, SAMPLE, KEEP, SEED, TABLE = 1 << 15, 6000, 0.995, 5, 300_000


class Hashed:
    """Bucket numbers of a text's distinct features, with a bounded table of words."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.known = buckets, {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, out = self.known, []
        if len(known) > TABLE:
            known.clear()
        for w in set((text or "").lower().split()):
            got = known.get(w)
            if got is None:
                got = known[w] = (zlib.crc32(w.encode("utf-8", "surrogatepass")) % self.buckets,
                                  zlib.crc32(b"\x00" + w[-2:].encode("utf-8", "surrogatepass")) % self.buckets)
            out.extend(got)
        return np.unique(np.array(out, np.int64))


def packed(x: np.ndarray) -> bytes:
    """Bucket numbers as one bit each: ``BUCKETS`` / 8 bytes at most, however long the text."""
    bits = np.zeros(BUCKETS, bool)
    bits[x] = True
    return np.packbits(bits).tobytes()


def unpacked(b: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8))).astype(np.uint16)


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Ordinal:
    """Cumulative-link model over hashed features."""

    def __init__(self, grades: int, buckets: int = BUCKETS):
        self.w = np.zeros(buckets)
        self.raw = np.r_[0.0, np.zeros(grades - 2)]          # first threshold, then softplus gaps
        self.cutoff = 0.0

    def theta(self) -> np.ndarray:
        return np.cumsum(np.r_[self.raw[0], np.log1p(np.exp(self.raw[1:]))])

    def margin(self, x: np.ndarray) -> float:
        return float(self.w[x].sum() / np.sqrt(len(x))) if len(x) else 0.0

    def tails(self, margin: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ..."""
        return _logistic(np.asarray(margin)[:, None] - self.theta()[None, :])

    def fit(self, xs: list, y: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.5, ridge: float = 1e-5):
        rng = np.random.default_rng(SEED)
        square, raw_square = np.full(len(self.w), 1e-6), np.full(len(self.raw), 1e-6)
        for _ in range(epochs):
            order = rng.permutation(len(xs))
            for i in range(0, len(xs), batch):
                rows = order[i:i + batch]
                flat = np.concatenate([xs[r] for r in rows])
                size = np.array([len(xs[r]) for r in rows])
                scale = np.repeat(1 / np.sqrt(np.maximum(size, 1)), size)
                m = np.bincount(np.repeat(np.arange(len(rows)), size), self.w[flat] * scale, len(rows))
                # probability of the own grade is a difference of neighbouring tails
                tail = np.concatenate([np.ones((len(rows), 1)), self.tails(m), np.zeros((len(rows), 1))], axis=1)
                g = y[rows]
                up, down = tail[np.arange(len(rows)), g], tail[np.arange(len(rows)), g + 1]
                p = np.maximum(up - down, 1e-12)
                d_up, d_down = up * (1 - up), down * (1 - down)
                dm = -(d_up - d_down) / p / len(rows)
                grad = np.bincount(flat, np.repeat(dm, size) * scale, len(self.w)) + ridge * self.w
                d_theta = np.zeros(tail.shape[1])
                np.add.at(d_theta, g, d_up / p / len(rows))
                np.add.at(d_theta, g + 1, -d_down / p / len(rows))
                d_theta = d_theta[1:-1]
                below = np.cumsum(d_theta[::-1])[::-1]       # a gap moves all thresholds above it
                d_raw = below * np.r_[1.0, _logistic(self.raw[1:])]
                square += grad ** 2
                raw_square += d_raw ** 2
                self.w -= rate * grad / np.sqrt(square)
                self.raw -= rate * d_raw / np.sqrt(raw_square)
        return self


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from labels (doc_id, quality, toxic)."""
    grade = F.when(F.col("quality") < 1, 0).when(F.coalesce("toxic", F.lit(0)) > 0, 1).otherwise(2)
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min(grade).alias("grade"))


def fit(docs: DataFrame, grades: DataFrame, sample: int = SAMPLE, keep: float = KEEP) -> Ordinal | None:
    some = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    marked = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")     # at most ``sample`` rows

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed = Hashed()
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "grade": f["grade"], "x": [packed(hashed(t)) for t in f["text"]]})

    once = marked.groupBy("doc_id").agg(F.min("grade").alias("grade"), F.min("text").alias("text"))
    got = once.mapInPandas(run, "doc_id bigint, grade int, x binary").toPandas()
    got = got.sort_values("doc_id")
    y = got["grade"].to_numpy()
    if len(np.unique(y)) < 2:
        return None
    xs = [unpacked(x) for x in got["x"]]
    held = np.random.default_rng(SEED).permutation(len(y)) % 4 == 3
    model = Ordinal(3).fit([x for x, h in zip(xs, held) if not h], y[~held])
    top = np.sort([model.tails(np.array([model.margin(x)]))[0, -1] for x, h, g in zip(xs, held, y) if h and g == 2])
    model.cutoff = float(top[int((1 - keep) * len(top))]) if len(top) else 0.0
    return model


def grade_documents(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """(doc_id, expected_grade, p_above_low, p_top, kept) of every row of ``docs``."""
    model = fit(docs, graded(labels), **kw)
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select("doc_id", none.alias("expected_grade"), none.alias("p_above_low"), none.alias("p_top"),
                           F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)   # one weight for each bucket

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed, m = Hashed(), shared.value
        for f in frames:
            tail = m.tails(np.array([m.margin(hashed(t)) for t in f["text"]]))
            yield pd.DataFrame({"doc_id": f["doc_id"].to_numpy(), "expected_grade": tail.sum(1), "p_above_low": tail[:, 0],
                                "p_top": tail[:, -1], "kept": tail[:, -1] >= m.cutoff})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, expected_grade double, p_above_low double, p_top double, kept boolean")
