"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

Encoding works on Arrow batches of whole texts. Each match of the splitting
pattern is encoded by itself, so a match met before in this task is taken from
a bounded table and only new ones go through the library, in one batch call for
each text that has any. The library spells bytes as printable characters; reversing
that byte table gives each id its bytes, which yield byte offsets and, through
the byte-to-character mapping, character offsets of every token. A character
split over several tokens counts to each of them: a token's span runs from the
character that holds its first byte to the one that holds its last.

Decoding joins the bytes of the ids; only the joined bytes are read as UTF-8,
so characters split over tokens come back whole.

Defined results: null text: as empty, no ids; unknown or null ids: an error on
decoding; repeated rows: each gets its row; empty table: no rows; null doc_id
and further columns: carried or ignored, never used.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

#: Matches kept in a worker's table; beyond it the table is begun anew.
TABLE = 300_000
#: Texts whose ids are held at once, by characters.
PIECE = 4_000_000
# The splitting pattern of the public vocabulary, with white
# space written out as Unicode's White_Space (other engines' \s has more).
_S = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+"
           rf"|[{_S}]+(?![^{_S}])|[{_S}]+")


def byte_spelling() -> dict[str, int]:
    """The character that spells each byte, reversed: printable Latin-1 bytes
    spell themselves, the others take the code points from 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """One task's encoder and decoder; ``path`` is the library's JSON file of a vocabulary."""

    def __init__(self, path: str, table: int = TABLE):
        # Spark runs the tasks side by side; threads of the library's own only cost hand-overs
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True      # their strings are ordinary text
        spelled = byte_spelling()
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in spelled for c in token):
                self.bytes_of[i] = bytes(spelled[c] for c in token)
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, bytes] = {}
        self.table = table

    def encode(self, texts) -> list[np.ndarray]:
        """The ids of each text (null: none)."""
        out = []
        for text in texts:
            parts = self.split(text or "")
            try:
                found = [self.known[p] for p in parts]
            except KeyError:
                if len(self.known) > self.table:
                    self.known.clear()
                new = [p for p in dict.fromkeys(parts) if p not in self.known]
                for p, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                    self.known[p] = np.array(e.ids, "<u4").tobytes()
                found = [self.known[p] for p in parts]
            out.append(np.frombuffer(b"".join(found), "<u4"))
        return out

    def decode(self, ids) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end (exclusive) of each token in code points of ``text``."""
        end = np.cumsum(self.length[ids])
        start = end - self.length[ids]
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1       # the character that each byte belongs to
        return char[start] if len(ids) else start, char[end - 1] + 1 if len(ids) else end


@functools.lru_cache(maxsize=1)
def codec_of(path: str) -> Codec:
    """One codec for each Python worker, whose table serves its next tasks too."""
    return Codec(path)


def pieces(frames: Iterator[pd.DataFrame], size: int = PIECE) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches where their texts pass ``size`` characters: ids take more room than text."""
    for f in frames:
        after = f["text"].str.len().fillna(0).cumsum().to_numpy(float)
        cuts = np.flatnonzero(np.diff(after // size) > 0) + 1
        for a, b in zip([0, *cuts], [*cuts, len(f)]):
            if b > a:
                yield f.iloc[a:b]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, starts, ends): ids and character offsets of every token."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(path)
        for f in pieces(frames):
            ids = codec.encode(f["text"])
            spans = [codec.offsets(t or "", i) for t, i in zip(f["text"], ids)]
            yield pd.DataFrame({"doc_id": f["doc_id"].to_numpy(), "n_tokens": [len(i) for i in ids],
                                "ids": [i.astype(np.int64) for i in ids],
                                "starts": [a for a, _ in spans], "ends": [b for _, b in spans]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, n_tokens bigint, ids array<bigint>, starts array<bigint>, ends array<bigint>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); bytes that are no UTF-8 become U+FFFD."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(path)
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "text": [
                codec.decode(() if i is None else i).decode("utf-8", "replace") for i in f["ids"]]})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInPandas(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if asked for): each
    text is encoded and its ids decoded again in one pass over the batch."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(path)
        for f in pieces(frames):
            ids = codec.encode(f["text"])
            out = {"doc_id": f["doc_id"].to_numpy(), "n_tokens": [len(i) for i in ids],
                   "ids_sha256": [hashlib.sha256(i.tobytes()).hexdigest() for i in ids],
                   "decoded_sha256": [hashlib.sha256(codec.decode(i)).hexdigest() for i in ids]}
            yield pd.DataFrame(out | ({"ids": [i.astype(np.int32) for i in ids]} if with_ids else {}))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
        + (", ids array<int>" if with_ids else ""))
