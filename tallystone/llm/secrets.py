r"""Secret scans: base patterns plus a character convolutional network.

Base spans, leftmost and non-overlapping for each kind, matches that fail the
length test dropped (code points, end exclusive):

* assign: ``(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)``,
  the key in either case, 6+ characters of value;
* access: ``AKIA[A-Z0-9]+``, 20+ characters; hex: ``[0-9a-f]+``, 24+ characters.

Further candidates are runs of 16+ characters ``[A-Za-z0-9+/_=-]`` with a letter
and a digit, of a run that base spans touch the parts beside them, which are
seen with the base spans blank. Each candidate is seen as 96 characters:
24 before it, its first 56, the rest after it; a longer one is also seen from
every further ``STEP`` characters of it on, and has the highest probability of
these windows. The network (characters by
class, one convolution, ReLU, maximum over places, logistic output, all numpy)
is trained on labelled findings: base spans of the corpus are positive, each
also with its surroundings blanked out, so that a value is known without its
name; long words and verified ids (parts that are a word in one case or a
number) of documents with no base span and no other candidate are negative,
with and without surroundings. Other candidates have no label: they are scored
only. It scores every candidate; a Platt curve fitted on one
holdout calibrates the scores to probabilities, and the threshold is the
highest, up to ``SURE``, with which another holdout keeps ``RECALL`` of its
positives. Candidates above it are added with kind ``model``;
base spans always stay.

The network is fitted on at most ``SAMPLE`` findings of each label, taken by
content hash; the scan covers every candidate of every whole text.

Defined results: null or empty text: no spans, the digest of the empty string;
very long texts: one pass over runs and spans, in
proportion to the text; null or repeated doc_id: each row gets its row; empty table or none of one
label to learn from: base spans only; further columns: ignored by ``scan``,
kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import stage

SAMPLE, RECALL, SURE, SEED = 4000, 0.98, 0.9, 11
BEFORE, WIDTH = 24, 96
INSIDE, STEP = 56, 16
KINDS = ("assign", "access", "hex")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")                 # a run is taken whole, so its length test can stand here
KEYED = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) by start, then kind as listed."""
    out = []
    if KEYED.search(text):
        out += [("assign", *m.span(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span(), m.start()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def covered(taken: list) -> list[tuple[int, int]]:
    """The places in the spans of ``taken`` (by start) as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for _, s, e, _ in taken:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def candidates(text: str, taken: list) -> list[tuple[int, int]]:
    """Spans of candidates: whole runs, and what the spans in ``taken`` leave of a run; one pass over both."""
    out, over, at = [], covered(taken), 0
    for m in CANDIDATE.finditer(text):
        a, end = m.span()
        while at < len(over) and over[at][1] <= a:
            at += 1
        parts = []
        while at < len(over) and over[at][0] < end:
            if a < over[at][0]:
                parts.append((a, over[at][0]))
            a = over[at][1]
            if a >= end:                                      # it may reach into the next run
                break
            at += 1
        if a < end:
            parts.append((a, end))
        left = "".join(text[x:y] for x, y in parts)
        if DIGIT.search(left) and LETTER.search(left):
            out += parts
    return out


def blanked(text: str, taken: list) -> str:
    """The text with the spans in ``taken`` blank: a candidate is not judged by a base finding beside it."""
    out, at = [], 0
    for s, e in covered(taken):
        out += [text[at:s], " " * (e - s)]
        at = e
    return "".join(out) + text[at:]


def context(text: str, a: int, b: int, alone: bool = False) -> str:
    """The 96 characters by which span (a, b) is seen, its surroundings blanked if ``alone``."""
    inside = text[a:min(b, a + INSIDE)]
    if alone:
        return (" " * BEFORE + inside).ljust(WIDTH)
    left = text[max(0, a - BEFORE):a]
    return (left.rjust(BEFORE) + inside + text[b:b + WIDTH - BEFORE - len(inside)]).ljust(WIDTH)[:WIDTH]


def windows(text: str, a: int, b: int) -> list[str]:
    """The contexts over the whole of span (a, b), the first as ``context`` has it: any ``INSIDE - STEP`` in a row are
    in the first ``INSIDE`` of one."""
    return [context(text, i, b) for i in range(a, max(a + 1, b - INSIDE + STEP), STEP)]


def sure(net: Network | None, spans: list[list[str]]) -> list[bool]:
    """Whether the highest probability of each span's windows reaches the threshold."""
    if not net or not spans:
        return [False] * len(spans)
    starts = np.cumsum([0, *map(len, spans[:-1])])
    return (np.maximum.reduceat(net.probability(codes([w for s in spans for w in s])), starts) >= net.threshold).tolist()


# Character classes: 16 digits of hexadecimal case by case, other letters, signs.
_CLASSES = 40


def _class_table() -> np.ndarray:
    t = np.full(65536, 39, np.uint8)                # anything beyond ASCII
    t[:128] = 38
    t[ord(" ")], t[10] = 0, 0
    for i in range(10):
        t[48 + i] = 1 + i
    for i in range(26):
        t[97 + i] = 11 + min(i, 6)                  # a to f, other lower-case letters
        t[65 + i] = 18 + min(i, 6)
    for c in "aeiou":
        t[ord(c)] = {"a": 11, "e": 15}.get(c, 25)
    for i, c in enumerate("\"':=+/_.-,;"):
        t[ord(c)] = 26 + i
    return t


_TABLE = _class_table()


def codes(contexts) -> np.ndarray:
    """Class codes, one row of 96 for each context."""
    joined = "".join(c if c.isascii() else "".join(x if ord(x) < 65536 else "￿" for x in c) for c in contexts)
    raw = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), np.uint16)
    return _TABLE[raw].reshape(-1, WIDTH)


class Network:
    """One convolution over character classes, maximum over places, logistic output."""

    KERNEL, FILTERS = 5, 24

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.conv = rng.normal(0, 0.25, (self.KERNEL, _CLASSES, self.FILTERS))
        self.bias = np.zeros(self.FILTERS)
        # the maximum is taken apart over what stands before, in and after the candidate's first characters
        self.out = rng.normal(0, 0.1, 2 * self.FILTERS)
        self.out_bias = 0.0
        self.slope, self.shift, self.threshold = 1.0, 0.0, 1.0

    def hidden(self, x: np.ndarray):
        places = x.shape[1] - self.KERNEL + 1
        z = sum(self.conv[k][x[:, k:k + places]] for k in range(self.KERNEL)) + self.bias
        cut = BEFORE
        a, b = z[:, :cut].argmax(1), z[:, cut:].argmax(1) + cut
        rows = np.arange(len(x))[:, None]
        f = np.arange(self.FILTERS)
        h = np.concatenate([z[rows, a, f], z[rows, b, f]], axis=1)
        return np.maximum(h, 0), a, b

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.hidden(x[i:i + 512])[0] @ self.out + self.out_bias
                               for i in range(0, len(x), 512)] or [np.zeros(0)])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.score(x) + self.shift, -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = SEED):
        rng = np.random.default_rng(seed)
        names = ("conv", "bias", "out")
        m = {n: np.zeros_like(getattr(self, n)) for n in names}
        v = {n: np.zeros_like(getattr(self, n)) for n in names}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                xb, yb = x[order[i:i + batch]], y[order[i:i + batch]]
                h, a, b = self.hidden(xb)
                err = (1 / (1 + np.exp(-np.clip(h @ self.out + self.out_bias, -40, 40))) - yb) / len(yb)
                back = np.outer(err, self.out) * (h > 0)
                grad = {"conv": np.zeros_like(self.conv), "bias": back[:, :self.FILTERS].sum(0) + back[:, self.FILTERS:].sum(0),
                        "out": h.T @ err + 1e-4 * self.out}
                rows = np.arange(len(xb))[:, None]
                f = np.broadcast_to(np.arange(self.FILTERS), a.shape)
                for where, g in ((a, back[:, :self.FILTERS]), (b, back[:, self.FILTERS:])):
                    for k in range(self.KERNEL):
                        np.add.at(grad["conv"][k], (xb[rows, where + k], f), g)
                self.out_bias -= rate * err.sum()
                step += 1
                for n in names:                                   # Adam
                    m[n] = 0.9 * m[n] + 0.1 * grad[n]
                    v[n] = 0.999 * v[n] + 0.001 * grad[n] ** 2
                    setattr(self, n, getattr(self, n) - rate * (m[n] / (1 - 0.9 ** step))
                            / (np.sqrt(v[n] / (1 - 0.999 ** step)) + 1e-8))
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray):
        """Platt's curve by Newton steps on a holdout."""
        s = self.score(x)
        design = np.stack([s, np.ones_like(s)], axis=1)
        pos, neg = y.sum(), len(y) - y.sum()
        goal = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
        w = np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
            grad = design.T @ (p - goal) + 1e-3 * w
            w = w - np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), grad)
        self.slope, self.shift = w
        return self

    def constrain(self, x: np.ndarray, y: np.ndarray, recall: float = RECALL, sure: float = SURE):
        """The highest threshold up to ``sure`` that keeps ``recall`` of the holdout's positives."""
        p = np.sort(self.probability(x[y > 0]))
        self.threshold = min(sure, float(p[int((1 - recall) * len(p))]) if len(p) else sure)
        return self


def _found(docs: DataFrame) -> DataFrame:
    """Every row's base spans and candidates with their contexts; and what can be learned from it."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for doc_id, text in zip(f["doc_id"], f["text"]):
                text = text or ""
                base = base_spans(text)
                cand = candidates(text, base)
                rest = blanked(text, base) if cand else text
                taught = [context(text, v, e, alone) for _, _, e, v in base for alone in (False, True)]
                clean = not base and all(verified(text[a:b]) for a, b in cand)
                words = [m.span() for k in (1, 2) for m in [LONG.search(text, len(text) * k // 3)] if m and verified(m[0])] if clean else []
                words = [context(text, a, b, alone) for a, b in words + cand * clean for alone in (False, True)]
                rows.append((doc_id, [k for k, *_ in base], [s for _, s, _, _ in base], [e for _, _, e, _ in base],
                             [a for a, _ in cand], [b for _, b in cand], [windows(rest, a, b) for a, b in cand], taught, words))
            yield pd.DataFrame(rows, columns=["doc_id", "kinds", "starts", "ends", "c_starts", "c_ends", "contexts", "taught", "plain"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, kinds array<string>, starts array<bigint>, ends array<bigint>, c_starts array<bigint>, "
        "c_ends array<bigint>, contexts array<array<string>>, taught array<string>, plain array<string>")


#: Long words, for the negatives: only teaching examples come from here.
LONG = re.compile(r"[^\x20\x09-\x0D]{9,}")


#: Parts of a verified id or word.
_PARTS = re.compile(r"[A-Za-z0-9]+")
_PLAIN = re.compile(r"[A-Z]?[a-z]{1,24}|[A-Z]{1,12}|[0-9]{1,10}")


def verified(run: str) -> bool:
    """Whether all parts of a run are words in one case or numbers, as in dates, paths of words and numbered names."""
    return all(_PLAIN.fullmatch(p) for p in _PARTS.findall(run))


def train(found: DataFrame, sample: int = SAMPLE, recall: float = RECALL, sure: float = SURE) -> Network | None:
    """Fit on at most ``sample`` findings of each label; None if a label has none."""
    def some(column: str, n: int) -> list[str]:
        rows = found.select(F.explode(column).alias("c")).distinct().orderBy(F.xxhash64("c"), "c").limit(n).collect()
        return [r["c"] for r in rows]

    yes = some("taught", sample)
    no = some("plain", sample)
    if not yes or not no:
        return None
    x, y = codes(yes + no), np.r_[np.ones(len(yes)), np.zeros(len(no))]
    fold = np.random.default_rng(SEED).permutation(len(y)) % 4     # two parts train, one calibrates, one constrains
    return (Network().fit(x[fold < 2], y[fold < 2]).calibrate(x[fold == 2], y[fold == 2])
            .constrain(x[fold == 3], y[fold == 3], recall, sure))


def _said(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, **kw) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model) of every row of ``docs``."""
    found = stage(_found(docs), "secrets-found")
    net = train(found, **kw)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            hit = sure(net, [c for row in f["contexts"] for c in row])
            rows, at = [], 0
            for doc_id, kinds, starts, ends, ca, cb in zip(f["doc_id"], f["kinds"], f["starts"], f["ends"], f["c_starts"], f["c_ends"]):
                base = list(zip(kinds, starts, ends))
                own = hit[at:at + len(ca)]
                at += len(ca)
                added = [("model", a, b) for a, b, h in zip(ca, cb, own) if h]
                spans = sorted(base + added, key=lambda s: (s[1], (*KINDS, "model").index(s[0])))
                rows.append((doc_id, *[sum(k == x for k, *_ in base) for x in KINDS],
                             hashlib.sha256(_said(base).encode()).hexdigest(), _said(spans), len(added)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "kinds", "starts", "ends", "c_starts", "c_ends", "contexts").mapInPandas(
        run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_model bigint")


def redact(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``[SECRET]``; n_chars follows if it is there."""
    net = train(stage(_found(docs).select("taught", "plain"), "secrets-found"), **kw)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = []
            for text in f["text"]:
                if text:
                    base = base_spans(text)
                    cand = candidates(text, base)
                    rest = blanked(text, base) if cand else text
                    keep = sure(net, [windows(rest, a, b) for a, b in cand])
                    spans = sorted([(s, e) for _, s, e, _ in base] + [c for c, k in zip(cand, keep) if k])
                    parts, at = [], 0
                    for s, e in spans:
                        if s >= at:
                            parts += [text[at:s], "[SECRET]"]
                        at = max(at, e)
                    text = "".join(parts) + text[at:] if spans else text
                texts.append(text)
            f = f.assign(text=pd.Series(texts, index=f.index, dtype=object))
            if "n_chars" in f:
                f["n_chars"] = [None if t is None else len(t) for t in texts]
            yield f

    return docs.mapInPandas(run, docs.schema)
