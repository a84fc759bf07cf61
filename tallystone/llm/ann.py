"""Approximate nearest neighbours by learned partitions.

Fit, on a sample of at most ``SAMPLE`` vectors taken by id hash: the sample's
neighbour graph (``NEAR`` nearest of each) is cut into balanced parts - seeds by
k-means, then rounds in which vertices move to the part that holds most of
their neighbours while no part exceeds its share by ``SLACK`` - and a small
classifier (one hidden layer) learns to name a vector's part, and so those of
its neighbours, from the vector alone. How many of the most probable parts a
query must visit is measured on sample queries held out from the fit: the
fewest with which they find ``AIM`` of their true neighbours.

Index: every row goes to its most probable part. Copies: of equal vectors only
the k + 1 with the smallest ids can be among any query's k nearest (ties go to
the smaller id, one may be the query itself), so the others, which no answer
can hold, are not compared. Parts are cut into blocks of about ``BLOCK`` rows,
a query meets all blocks of the parts it visits, and queries of a part come in
blocks as well: a task's tile is bounded, however large a part is. Equal
queries are answered once and each takes its own id out of the answer.

Rerank: a tile's inner products are exact in double precision, summed in the
order of the components, and each tile sends on its k + 1 best for each query.

Defined results: vectors that are null, empty, zero, of another length than
most, or hold null or non-finite components take no part, neither as query nor
as candidate; null ids take no part; repeated rows (same id, same vector): one
counts; a query with fewer than k candidates in the visited parts visits the
next ones, so it gets all candidates if there are fewer than k; empty table: no
rows; further columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.llm.common import stage

K, SAMPLE, PARTS, NEAR, SLACK, HIDDEN = 20, 4000, 32, 10, 0.1, 64
AIM, HELD, BLOCK, SEED = 0.95, 400, 4096, 7


def graph(v: np.ndarray, near: int) -> np.ndarray:
    """The ``near`` nearest others of each vector by inner product."""
    out = []
    for a in range(0, len(v), 512):
        s = v[a:a + 512] @ v.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out.append(np.argpartition(-s, near, axis=1)[:, :near])
    return np.concatenate(out)


def balanced_parts(v: np.ndarray, edges: np.ndarray, parts: int, slack: float = SLACK, rounds: int = 12,
                   seed: int = SEED) -> np.ndarray:
    """A part for each vertex, none larger than (1 + slack) of an equal share."""
    n, rng = len(v), np.random.default_rng(seed)
    room = int(np.ceil(n / parts * (1 + slack)))
    centre = v[rng.choice(n, parts, replace=False)]
    for _ in range(8):
        label = (v @ centre.T).argmax(1)
        for p in range(parts):
            if (label == p).any():
                c = v[label == p].mean(0)
                centre[p] = c / (np.linalg.norm(c) or 1)
    wish, label = v @ centre.T, np.full(n, -1)
    size = np.zeros(parts, int)
    for i in np.argsort(-(np.sort(wish, 1)[:, -1])):              # the surest first, into the best part with room
        for p in np.argsort(-wish[i]):
            if size[p] < room:
                label[i], size[p] = p, size[p] + 1
                break
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(n), edges.shape[1]), label[edges].ravel()), 1)
        np.add.at(votes, (edges.ravel(), np.repeat(label, edges.shape[1])), 1)
        gain = votes.max(1) - votes[np.arange(n), label]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            p = int(votes[i].argmax())
            if size[p] < room:
                size[label[i]] -= 1
                label[i], size[p], moved = p, size[p] + 1, moved + 1
        if not moved:
            break
    return label


class Router:
    """One hidden layer and a softmax over the parts; ``visit`` parts are searched."""

    def __init__(self, width: int, parts: int, scale: float, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.scale, self.parts, self.visit = scale, parts, parts
        self.a = rng.normal(0, width ** -0.5, (width, HIDDEN))
        self.a0 = np.zeros(HIDDEN)
        self.b = rng.normal(0, HIDDEN ** -0.5, (HIDDEN, parts))
        self.s = np.zeros((width, parts))                         # straight to the parts, beside the hidden layer
        self.b0 = np.zeros(parts)

    def logits(self, v: np.ndarray) -> np.ndarray:
        x = v / self.scale
        return np.maximum(x @ self.a + self.a0, 0) @ self.b + x @ self.s + self.b0

    def fit(self, v: np.ndarray, goal: np.ndarray, epochs: int = 30, batch: int = 256, rate: float = 0.01):
        """``goal``: for each vector, the share of each part among itself and its neighbours."""
        rng = np.random.default_rng(SEED)
        names = ("a", "a0", "b", "s", "b0")
        m, u, step = ({n: np.zeros_like(getattr(self, n)) for n in names} for _ in range(2)), None, 0
        first, second = m
        for _ in range(epochs):
            order = rng.permutation(len(v))
            for i in range(0, len(v), batch):
                x, y = v[order[i:i + batch]] / self.scale, goal[order[i:i + batch]]
                h = np.maximum(x @ self.a + self.a0, 0)
                z = h @ self.b + x @ self.s + self.b0
                p = np.exp(z - z.max(1, keepdims=True))
                err = (p / p.sum(1, keepdims=True) - y) / len(x)
                back = (err @ self.b.T) * (h > 0)
                grad = {"a": x.T @ back, "a0": back.sum(0), "b": h.T @ err, "s": x.T @ err, "b0": err.sum(0)}
                step += 1
                for n in names:
                    first[n] = 0.9 * first[n] + 0.1 * grad[n]
                    second[n] = 0.999 * second[n] + 0.001 * grad[n] ** 2
                    setattr(self, n, getattr(self, n) - rate * first[n] / (1 - 0.9 ** step)
                            / (np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8))
        return self


def fit(v: np.ndarray, parts: int = PARTS, k: int = K, aim: float = AIM) -> Router:
    """Partition the sample ``v``, train the router, measure how many parts to visit."""
    n = len(v)
    parts = max(1, min(parts, n // 32))
    scale = float(np.median(np.linalg.norm(v, axis=1))) or 1.0
    router = Router(v.shape[1], parts, scale)
    if parts == 1:
        return router
    held = np.arange(n) % max(2, n // min(HELD, n // 4)) == 0
    base = v[~held]
    edges = graph(base, min(NEAR, len(base) - 1))
    label = balanced_parts(base / np.maximum(np.linalg.norm(base, axis=1, keepdims=True), 1e-300), edges, parts)
    goal = np.zeros((len(base), parts))
    goal[np.arange(len(base)), label] += 0.5
    np.add.at(goal, (np.repeat(np.arange(len(base)), edges.shape[1]), label[edges].ravel()), 0.5 / edges.shape[1])
    router.fit(base, goal)
    home = router.logits(base).argmax(1)
    true = np.argsort(-(v[held] @ base.T), axis=1)[:, :k]
    place = np.argsort(np.argsort(-router.logits(v[held]), axis=1), axis=1)
    found = np.take_along_axis(place, home[true], axis=1)         # how many parts come before each true neighbour's
    share = [(found < m).mean() for m in range(1, parts + 1)]
    router.visit = 1 + int(np.argmax(np.array(share) >= aim))
    return router


def exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, component by component."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * c[:, d]
    return out


def best_of(q: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int):
    """The k best of candidates ``c`` for each query: (query index, id, score), ties to smaller ids."""
    rows, cols = [], []
    for a in range(0, len(q), 256):
        s = q[a:a + 256] @ c.T
        if s.shape[1] > k:                                        # rounding of the product must not decide: keep near ties
            least = np.partition(s, -k, axis=1)[:, -k]
            slack = 1e-12 * np.abs(q[a:a + 256]).sum(1) * max(np.abs(c).max(), 1e-300) * q.shape[1]
            i, j = np.nonzero(s >= (least - slack)[:, None])
        else:
            i, j = np.nonzero(np.ones_like(s, bool))
        rows.append(i + a)
        cols.append(j)
    i, j = np.concatenate(rows), np.concatenate(cols)
    score = exact(q[i], c[j])
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i, side="left")
    keep = rank < k
    return i[keep], ids[j[keep]], score[keep]


def _usable(vectors: DataFrame) -> DataFrame:
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    return v.select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))          # -0 as 0


def nearest(vectors: DataFrame, every: int = 20, k: int = K, sample: int = SAMPLE, parts: int = PARTS,
            aim: float = AIM, block: int = BLOCK, visit: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found; queries are ids divisible by ``every``."""
    usable = _usable(vectors)
    widths = usable.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    width = widths[0]["w"] if widths else 0
    copy = Window.partitionBy("v").orderBy("vec_id")
    usable = stage(usable.where(F.size("v") == width).dropDuplicates(["vec_id", "v"]), "ann-rows")
    some = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not some:
        return usable.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    router = fit(np.array([r["v"] for r in some]), parts, k, aim)
    visit = min(visit or router.visit, router.parts)

    def route(most: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                if len(f):
                    order = np.argsort(-router.logits(np.stack(f["v"])), axis=1, kind="stable")[:, :most]
                    yield f.assign(parts=list(order.astype(np.int32)))
        return run

    few = usable.withColumn("nth", F.row_number().over(copy)).where(F.col("nth") <= k + 1).drop("nth")
    homed = stage(few.mapInPandas(route(1), "vec_id bigint, v array<double>, parts array<int>")
                  .select("vec_id", "v", F.col("parts")[0].alias("part")), "ann-index")
    sizes = homed.groupBy("part").agg(F.count("*").alias("n"))
    counted = {r["part"]: r["n"] for r in sizes.collect()}        # at most ``parts`` rows
    blocks = [max(1, -(-counted.get(p, 0) // block)) for p in range(router.parts)]
    per_part = F.array(*map(F.lit, blocks))
    candidates = homed.select("part", F.pmod(F.xxhash64("vec_id"), F.get(per_part, F.col("part"))).cast("int").alias("cb"),
                              "vec_id", "v")
    asked = stage(usable.where(F.pmod("vec_id", F.lit(every)) == 0), "ann-asked")
    query = stage(asked.groupBy("v").agg(F.min("vec_id").alias("key")), "ann-queries")

    # A query's list is cut where the parts visited hold k + 1 candidates at least.
    def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.array([counted.get(p, 0) for p in range(router.parts)])
        for f in frames:
            if len(f):
                order = np.argsort(-router.logits(np.stack(f["v"])), axis=1, kind="stable").astype(np.int32)
                enough = (np.cumsum(held[order], axis=1) >= k + 1).argmax(1) + 1
                enough = np.where(held.sum() >= k + 1, enough, router.parts)
                yield f.assign(parts=[o[:max(visit, e)] for o, e in zip(order, enough)])

    routed = stage(query.mapInPandas(plan, "v array<double>, key bigint, parts array<int>")
                   .select("key", "v", F.explode("parts").alias("part")), "ann-routed")
    asked_in = {r["part"]: r["n"] for r in routed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    wide = [max(1, -(-asked_in.get(p, 0) // block)) for p in range(router.parts)]
    per_query = F.array(*map(F.lit, wide))
    tile_q = (routed.withColumn("qb", F.pmod(F.xxhash64("key"), F.get(per_query, F.col("part"))).cast("int"))
              .withColumn("cb", F.explode(F.sequence(F.lit(0), F.get(per_part, F.col("part")) - 1))))
    tile_c = candidates.withColumn("qb", F.explode(F.sequence(F.lit(0), F.get(per_query, F.col("part")) - 1)))

    def rerank(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"key": [], "vec_id": [], "score": []})
        i, ids, score = best_of(np.stack(q["v"]), c["vec_id"].to_numpy(), np.stack(c["v"]), k + 1)
        return pd.DataFrame({"key": q["key"].to_numpy()[i], "vec_id": ids, "score": score})

    tile = ["part", "cb", "qb"]
    found = tile_q.groupBy(*tile).cogroup(tile_c.groupBy(*tile)).applyInPandas(rerank, "key bigint, vec_id bigint, score double")
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    top = stage(found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1), "ann-top")
    names = asked.join(query, "v").select(F.col("vec_id").alias("query_id"), "key")
    own = Window.partitionBy("query_id").orderBy("nth")
    return (names.join(top, "key").where("query_id <> vec_id").withColumn("rank", F.row_number().over(own))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
