"""Randomised invariants of the text operators (many cases per Spark job)."""

import random

from pyspark.sql import functions as F

from tallystone.operators import chunks

WORDS = ["net", "sales", "risk", "Item", "cash", "the", "of", "1.", "x"]


def random_text(rng: random.Random) -> str:
    parts = []
    for _ in range(rng.randint(0, 12)):
        r = rng.random()
        if r < 0.3:
            parts.append(f"Item {rng.randint(1, 4)}{rng.choice(['', 'A'])}.{rng.choice([' ', '  ', chr(10)])}"
                         f"{rng.choice(['Risk', 'Legal', 'Business'])} {rng.choice(['', 'factors'])}")
        else:
            parts.append(" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 60))))
    return rng.choice(["\n", " \n", "\n\n"]).join(parts)


def test_section_and_window_invariants(spark):
    rng = random.Random(7)
    texts = [(i, random_text(rng)) for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    raw = chunks.with_sections(chunks.with_sections(df, "text", "r", merge=False), "text", "m", min_tokens=40)
    for row in raw.collect():
        assert "".join(s.text for s in row.r) == row.text
        raw_words = sum(len(s.text.split()) for s in row.r)
        merged_words = sum(len(s.text.split()) for s in row.m)
        assert merged_words == raw_words and 1 <= len(row.m) <= len(row.r)
    wins = chunks.token_windows(df, size=50, overlap=7).collect()
    by_doc = {}
    for w in wins:
        by_doc.setdefault(w.doc_id, []).append(w)
    for doc_id, text in texts:
        toks = text.split()
        ws = sorted(by_doc.get(doc_id, []), key=lambda w: w.window_index)
        covered = set()
        for w in ws:
            assert w.chunk_text == " ".join(toks[w.token_start:w.token_start + 50])
            covered.update(range(w.token_start, w.token_start + w.n_tokens))
        assert covered == set(range(len(toks)))
        assert len(ws) == (0 if not toks else max(0, -(-(len(toks) - 50) // 43)) + 1)
