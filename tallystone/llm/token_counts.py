"""Token counts of sections by offset mapping.

A document is encoded once, as a whole; its tokens' character spans are then
interval-joined to the spans of its sections (both sorted, so the join is a
binary search), instead of encoding the sections apart, which would count other
tokens at their edges. A token that crosses a boundary goes, by ``rule``,

* ``most`` (default): to the section that holds most of its characters, the
  earlier one on ties;
* ``start``: to the section of its first character.

The sections of a text are its lines, each with the newline that ends it, so
they tile the text and every token is counted once. Tokens that share a split
character each have that character as their span.

Defined results: null or empty text: no section, no token; null or repeated
doc_id: each row gets its row; empty table: no rows; further columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tallystone.llm.bpe import codec_of


def sections(text: str) -> np.ndarray:
    """Starts of the sections of ``text``, and its length at the end."""
    lines = text.split("\n")
    ends = np.cumsum([len(x) + 1 for x in lines])
    ends[-1] -= 1
    return np.unique(np.r_[0, ends])


def allocate(starts: np.ndarray, ends: np.ndarray, edge: np.ndarray, rule: str = "most") -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens that cross a boundary); section i spans edge[i] to edge[i + 1]."""
    if rule not in ("most", "start"):
        raise ValueError(f"unknown rule {rule!r}")
    if len(edge) < 2:
        return np.zeros(0, np.int64), 0
    first = np.searchsorted(edge, starts, side="right") - 1
    last = np.searchsorted(edge, ends, side="left") - 1
    at = first.copy()
    if rule == "most":
        for t in np.flatnonzero(last > first):
            cut = edge[first[t]:last[t] + 2].clip(starts[t], ends[t])
            at[t] = first[t] + int(np.diff(cut).argmax())
    return np.bincount(at, minlength=len(edge) - 1), int((last > first).sum())


def token_counts(docs: DataFrame, path: str, rule: str = "most") -> DataFrame:
    """(doc_id, n_tokens, n_sections, section_tokens, n_crossing) of every row of ``docs``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(path)
        for f in frames:
            rows = []
            for doc_id, text in zip(f["doc_id"], f["text"]):
                text = text or ""
                ids = codec.encode([text])[0]
                per, crossing = allocate(*codec.offsets(text, ids), sections(text), rule)
                rows.append((doc_id, len(ids), len(per), per.astype(np.int64), crossing))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "n_sections", "section_tokens", "n_crossing"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, n_tokens bigint, n_sections bigint, section_tokens array<bigint>, n_crossing bigint")
