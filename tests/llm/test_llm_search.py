"""Collocations, fragment encoding and ranked search against plain versions."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers as P
from tallystone.llm import collocations, fragments, lexical, queries

SF = "/root/testdata/sf0.001"
JSON = P.path("byte_bpe_50k.json")
LOWER = {c: c + 32 for c in range(65, 91)}
ODD = [(0, None, "en"), (1, "", None), (2, " \t\n.,", "en"), (3, "Straße ẞ 漢字 😀\n\nline", None), (4, "a b", "und"),
       (None, "null id", "en"), (5, " ".join(f"word{i}" for i in range(60_000)), "en"), (6, "x" * 300_000, "en"),
       (7, "same same text", "en"), (7, "same same text", "en")]
#: Columns with names that the operators use inside.
CLASH = "k long, n long, q int, score long, w1 string, phrase string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "x", "y") for r in ODD], "doc_id long, text string, lang string, " + CLASH)


# 11 collocations

def plain_collocations(rows, least, top, share=80):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        for p in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", p)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        cands, inside = {p: a for p, a in c.items() if len(p) > 1 and a >= least}, collections.Counter()
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        found = []
        for p, a in cands.items():
            if p not in inside or 100 * inside[p] < share * a:
                s, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def chatter(spark):
    rng = random.Random(3)
    w = ["The", "a", "of", ".", "New", "York", "é", "x|y", ",", "\n", "\t", "ÉA", "big", "c-d", "  ", "\x0b", "New York City"]
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choice(w) for _ in range(rng.randint(0, 60))))
            for _ in range(300)]
    rows += [("en", None), ("en", ""), ("en", " ".join(["loop"] * 500)), ("fr", "new york " * 3000)]
    return spark.createDataFrame(rows, "lang string, text string").repartition(4)


@pytest.mark.parametrize("least, size, bits", [(5, collocations.BLOCK, collocations.BITS), (3, 200, 1 << 12), (30, 64, 64)])
def test_collocations_equal_plain_counts_with_blocks_inside_texts_and_a_full_filter(chatter, least, size, bits):
    got = rows_of(collocations.collocations(chatter, least=least, top=50, size=size, bits=bits))
    assert got == plain_collocations([tuple(r) for r in chatter.collect()], least, 50)


def test_collocation_blocks_number_whole_texts_at_once():
    """A block keeps texts, not a list of their words; ids lead back to the words, breaks are 0."""
    texts = [("en", b"a  bb\na c \n\n"), ("de", b""), ("de", b"\xc3\xa9 bb"), ("en", b"\n"), ("fr", b" x" * 1000)]
    block = collocations.Block()
    for lang, raw in texts:
        block.add(lang, raw)
    assert block.last(2) == [b"x", b"x"] and len(block.texts) == len(texts)
    ids, langs, words, names = block.arrays()
    want = [(lang, w) for lang, raw in texts for w in raw.replace(b"\n", b" \n ").split(b" ") if w]
    assert [(names[n], words[i] if i else b"\n") for i, n in zip(ids, langs)] == want and words[0] == b""


def test_collocations_of_the_table_and_of_odd_texts(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = rows_of(queries.QUERIES["op11_collocations"](spark, SF))
    assert got == plain_collocations([(r.lang, r.text) for r in docs.collect()], 30, 2000)
    assert rows_of(collocations.collocations(odd, least=2)) == plain_collocations([(r[2], r[1]) for r in ODD], 2, 2000)
    assert collocations.collocations(odd.limit(0)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, b, c = 9 * 10**18, 9_100_000_000_000_000_001, 9_200_000_000_000_000_007
    x = spark.sql(f"SELECT (CAST({a}L AS DECIMAL(19, 0)) * CAST({collocations.SCALE} AS DECIMAL(7, 0))) div "
                  f"(CAST({b}L AS DECIMAL(19, 0)) + CAST({c}L AS DECIMAL(19, 0))) AS x").first().x
    assert x == collocations.SCALE * a // (b + c)


def test_a_word_longer_than_a_block_ends():
    import pyarrow as pa
    text = "a " + "b" * 500 + " c " + "d" * 500 + " " + "e" * 500 + " f"
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    got = list(collocations.blocks(iter([batch]), 4, 16))
    counted = 0
    for b in got:
        ids = b.arrays()[0]
        counted += int((ids[:len(ids) - b.open] > 0).sum())
    assert counted == 6 and len(got) > 1


# 12 fragments

@pytest.fixture(scope="module")
def both():
    return fragments.Splitter(JSON), Tokenizer.from_file(JSON)


def same(both, text, **kw):
    ours, library = both
    got, want = ours.encode(text, **kw).tolist(), library.encode(text, add_special_tokens=False).ids
    assert got == want, text[:100]
    assert ours.decode(got) == library.decode(want, skip_special_tokens=False)


def test_fragments_give_the_ids_of_the_whole_text(both):
    rng = random.Random(5)
    letters = [*"aelrvstdmxqzé漢字😀　 \u0085\x1c\x1f\x0b\t\n\r  ''’.,!|<>1259_-ßẞ​́  ᠎﻿",
               "<|endoftext|>", "'s", "'re", "'ll", "'ve", "'t", "\n\n", "  ", " The", "the", "'S"]
    for _ in range(8000):
        same(both, "".join(rng.choice(letters) for _ in range(rng.randint(0, 14))))
    for size in (1, 7, 100, 1 << 20):
        for _ in range(20):
            same(both, "".join(rng.choice(letters) for _ in range(2000)), block=size)
    for _ in range(300):
        same(both, "".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x2000, 0x3100),
                                           rng.randrange(0x10000, 0x1F900), 32, 10])) for _ in range(60)))


def test_cuts_lie_between_bytes_of_no_token(both):
    ours, _ = both
    tokens = b"\0\0".join(b for b in ours.bytes_of if b)
    for a, b in [(ord("q"), ord("x")), (ord("d"), ord(" ")), (ord("e"), ord(","))]:
        assert ours.cut[a, b] == (bytes([a, b]) not in tokens)
    assert not ours.cut[ord("t"), ord("h")] and not ours.cut[ord("\n"), ord("T")]
    assert len(ours.cuts(np.frombuffer(b"one two, three", np.uint8))) >= 3


def test_a_small_table_gives_the_same_ids(both):
    small = fragments.Splitter(JSON, table=3)
    for text in ["one two three four five six seven", "one two" * 50, "eins zwei drei"]:
        assert small.encode(text).tolist() == both[1].encode(text, add_special_tokens=False).ids


def test_fragment_query_and_odd_texts(spark, odd, both):
    library = both[1]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df, got in [(docs, queries.QUERIES["op12_fragment_bpe"](spark, SF)), (odd, fragments.digests(odd, JSON))]:
        want = []
        for r in df.collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert rows_of(got) == sorted(want, key=str)
    back = fragments.decode(fragments.encode(odd, JSON), JSON)
    assert rows_of(back) == sorted([(r[0], r[1] or "") for r in ODD], key=str)
    assert fragments.digests(odd.limit(0), JSON).collect() == []


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        fragments.Splitter(P.path("word_bpe_49k.json"))


# 13 ranked search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, top):
    held = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n, total = len(held), sum(x for _, _, x in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        terms = set(TERM.findall((text or "").translate(LOWER)))
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in terms}
        scored = [(sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 20 * (50 + 50 * x * n // total))) for t in terms if t in c), i)
                  for i, c, x in held]
        best = sorted((x for x in scored if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:top]
        out += [(item, k + 1, i, s) for k, (s, i) in enumerate(best)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def shelf(spark):
    rng = random.Random(1)
    w = [f"w{i}" for i in range(50)] + ["É", "ÉA", "été", "漢字", "x-y", "A.B", "__"]
    docs = [(i, " ".join(rng.choice(w[:rng.randint(2, 57)]) for _ in range(rng.choice([1, 3, 20, 400])))) for i in range(400)]
    docs += [(None, "w1 w2"), (7, None), (8, ""), (900, " ".join(f"u{i}" for i in range(60_000)) + " w3 w3 w3")]
    docs += [docs[5]] * 60 + [(1000 + i, docs[6][1]) for i in range(70)]
    items = [(i, " ".join(rng.sample(w, rng.randint(1, 12)))) for i in range(30)]
    items += [(31, None), (32, ""), (33, "nothere"), (1, "w1 w1 W2"), (None, "u5 w3")] + [(2, "w5")] * 2
    return docs, items


@pytest.mark.parametrize("top, at_once", [(50, 256), (7, 8)])
def test_search_equals_scoring_all(spark, shelf, top, at_once):
    docs, items = shelf
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, k long").repartition(5)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, q int")
    assert rows_of(lexical.search(d, b, top, at_once)) == plain_search(docs, items, top)


def test_search_of_the_tables_and_empty_ones(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = rows_of(queries.QUERIES["op13_lexical_search"](spark, SF))
    assert got == plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 50)
    assert lexical.search(docs.limit(0), items).collect() == [] == lexical.search(docs, items.limit(0)).collect()


def test_bounds_are_never_below_the_score_and_exclude_most(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    keyed = lexical._keyed(docs)
    index = lexical.stage(lexical.signatures(keyed), "test-index")
    texts = [r.text for r in items.orderBy("item_id").limit(10).collect()]
    terms = [list(dict.fromkeys(lexical.terms_of(t))) for t in texts]
    counted = {bytes(r.term): r.df for r in index.where("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    n, total = index.agg(F.sum("docs"), F.sum("words")).first()
    block = lexical.Items(terms, {t: counted[t] for of in terms for t in of if t in counted}, n, total)
    bound = {}
    for row in index.where("slots IS NOT NULL").collect():
        keys, found = block.bounds(row.asDict())
        bound |= {(q, k): found[q, d] for q in range(10) for d, k in enumerate(keys.tolist())}
    pairs = keyed.select("k").distinct().crossJoin(spark.range(10).select(F.col("id").cast("int").alias("q")))
    key = {r.doc_id: r.k for r in keyed.select("doc_id", "k").collect()}
    exact = {(r.q, key[r.doc_id]): r.score for r in lexical.rescored(keyed, pairs, block).collect()}
    assert all(bound[p] >= s for p, s in exact.items())
    best = {q: sorted(s for (p, _), s in exact.items() if p == q)[-50] for q in range(10)}
    assert lexical.not_excluded(index, block, best).count() < 10 * 50 * 2


# 6 pages that once ended the job

def test_wrapper_pages_with_marked_sections_and_deep_nesting(spark):
    from tallystone.llm import wrappers
    pages = [(1, "http://a.example/1", "<article><p>a</p><![x[ b ]]><![if !IE]><p>c</p><![endif]></article>"),
             (2, "http://b.example/1", "<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>after</p>"),
             (3, "http://b.example/2", "<article>" + "<div><span>" * 3000 + "other")]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "a c", 2: "deep after", 3: "other"}


def test_wrapper_has_every_shape_of_a_host(spark):
    """Twelve rare shapes beyond the eight frequent ones have a template text of their own, and a part beside the article."""
    from tallystone.llm import wrappers
    page = "<body><div class=top>Site</div><article><p>text {0}</p>{1}</article>{2}</body>"
    rows = [(n, page.format(n, f"<div class=s{n % 8}>part {n}</div>", "")) for n in range(80)]
    rows += [(80 + n, page.format(80 + n, f"<div class=strip>Same on rare pages</div><div class=r{n % 12}>part {80 + n}</div>",
                                  f"<div class=beside><p>odd {n}</p></div>")) for n in range(24)]
    frame = spark.createDataFrame([(n, "http://h.example/", html) for n, html in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract(frame.repartition(4)).collect()}
    assert got == {n: f"text {n} part {n}" for n, _ in rows}
    w = wrappers.induce([wrappers.tree(html) for _, html in rows])
    assert {n: w.read(wrappers.tree(html)) for n, html in rows} == got
