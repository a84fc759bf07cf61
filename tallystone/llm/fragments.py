"""BPE encoding by forced-boundary splitting, and decoding.

A merge always yields a vocabulary token, so two neighbouring bytes that stand
side by side in no token of the vocabulary are never merged: between them lies
a certain cut. The bytes of a text are looked up pair by pair in a 256 x 256
table of such cuts (numpy), the fragments between cuts go through the
``tokenizers`` library each by itself, and their ids are concatenated. A
fragment met before in this worker is taken from a bounded table.

The library first splits a text at its added tokens and by a pattern, and a
fragment must be split as it is in place. The table therefore leaves pairs
alone where the pattern looks across the cut:

* after white space (a run of it gives its last character away if something
  else follows; of a character of several bytes the first byte decides, and
  every one that begins some white space counts);
* around an apostrophe and inside ``re``, ``ve``, ``ll`` (contractions);
* inside a character, and inside the string of an added token.

Elsewhere a cut either is a border of the pattern's matches or lies inside one
match, whose rest the pattern matches in the same way from the cut on.

Decoding joins the bytes of the ids; bytes that are no UTF-8 become U+FFFD, as
in the library's byte-level decoder, and special tokens keep their strings.

Only files of this kind are taken: byte-level BPE without normaliser, prefix
space, dropout or post-processing, added tokens without conditions. Anything
else is a ValueError, and no different ids.

Defined results: null text: as empty, no ids; very long texts: cut blocks of
``BLOCK`` bytes (at certain cuts) are encoded one after another; a fragment
without a cut is encoded whole; unknown or null ids: an error on decoding;
repeated rows: each gets its row; empty table: no rows; null doc_id and
further columns: carried or ignored, never used.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tallystone.llm.bpe import byte_spelling, pieces

#: Fragments kept in a worker's table (beyond it the table is begun anew), and their longest.
TABLE, LONGEST = 400_000, 64
#: Bytes of a text whose fragments are held at once.
BLOCK = 1 << 20
# ASCII white space, the first bytes of characters that may be white space beyond ASCII.
_GAPS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20]
_TWO, _THREE = 0xC2, (0xE1, 0xE2, 0xE3)


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space") and spec["normalizer"] is None
             and spec["post_processor"] is None and (spec["decoder"] or {}).get("type") == "ByteLevel"
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                "byte_fallback", "unk_token"))
             and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")))
    if not plain:
        raise ValueError("not a plain byte-level BPE file")
    return spec


class Splitter:
    """One worker's encoder and decoder for the library's JSON file at ``path``."""

    def __init__(self, path: str, table: int = TABLE):
        # Spark runs the tasks side by side; threads of the library's own only cost hand-overs
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        spec = _spec(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spelled = byte_spelling()
        vocab, added = spec["model"]["vocab"], spec["added_tokens"]
        self.bytes_of = [None] * (max([*vocab.values(), *(t["id"] for t in added)]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(spelled[c] for c in token)
        for t in added:
            self.bytes_of[t["id"]] = t["content"].encode()
        self.cut = self.certain([b for b in self.bytes_of if b])
        self.known: dict[bytes, bytes] = {}
        self.table = table

    @staticmethod
    def certain(tokens: list[bytes]) -> np.ndarray:
        """Whether the pair (first byte, second byte) is a certain cut."""
        cut = np.ones((256, 256), bool)
        for t in tokens:
            b = np.frombuffer(t, np.uint8)
            cut[b[:-1], b[1:]] = False
        cut[_GAPS] = False
        cut[:, 0x80:0xC0] = False                                  # inside a character
        cut[0x27] = cut[:, 0x27] = False
        for pair in (b"re", b"ve", b"ll"):
            cut[pair[0], pair[1]] = False
        return cut

    def cuts(self, b: np.ndarray) -> np.ndarray:
        """Places of the text's bytes before which a certain cut lies."""
        at = self.cut.ravel()[(b[:-1].astype(np.uint16) << 8) | b[1:]]
        if len(b) > 2:
            at[1:] &= b[:-2] != _TWO
        if len(b) > 3:
            at[2:] &= (b[:-3] < _THREE[0]) | (b[:-3] > _THREE[-1])
        return np.flatnonzero(at) + 1

    def _block(self, raw: bytes, edges: np.ndarray) -> bytes:
        parts = [raw[x:y] for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())]
        try:
            return b"".join([self.known[p] for p in parts])
        except KeyError:
            pass
        if len(self.known) > self.table:
            self.known.clear()
        new = [p for p in dict.fromkeys(parts) if p not in self.known]
        found = self.tokenizer.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)
        once = {}
        for p, e in zip(new, found):
            (self.known if len(p) <= LONGEST else once)[p] = np.array(e.ids, "<u4").tobytes()
        return b"".join([self.known[p] if p in self.known else once[p] for p in parts])

    def encode(self, text: str | None, block: int = BLOCK) -> np.ndarray:
        raw = (text or "").encode()
        if not raw:
            return np.zeros(0, "<u4")
        cuts = self.cuts(np.frombuffer(raw, np.uint8))
        edges = np.concatenate([[0], cuts, [len(raw)]])
        ends = np.unique(np.r_[np.searchsorted(edges, np.arange(block, len(raw), block)), len(edges) - 1])
        out, begin = [], 0
        for end in ends.tolist():
            out.append(self._block(raw, edges[begin:end + 1]))
            begin = end
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids) -> str:
        table = self.bytes_of
        raw = b"".join([table[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])
        return raw.decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)
def splitter_of(path: str) -> Splitter:
    """One splitter for each Python worker, whose table serves its next tasks too."""
    return Splitter(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = splitter_of(path)
        for f in pieces(frames):
            ids = [splitter.encode(t) for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"].to_numpy(), "n_tokens": [len(i) for i in ids],
                                "ids": [i.astype(np.int32) for i in ids]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, n_tokens bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = splitter_of(path)
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"].to_numpy(),
                                "text": [splitter.decode(() if i is None else i) for i in f["ids"]]})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInPandas(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text is encoded and
    its ids are decoded again in one pass, so the ids need not be written."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = splitter_of(path)
        for f in pieces(frames):
            ids = [splitter.encode(t) for t in f["text"]]
            yield pd.DataFrame({
                "doc_id": f["doc_id"].to_numpy(), "n_tokens": [len(i) for i in ids],
                "ids_sha256": [hashlib.sha256(i.tobytes()).hexdigest() for i in ids],
                "decoded_sha256": [hashlib.sha256(splitter.decode(i).encode()).hexdigest() for i in ids]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
