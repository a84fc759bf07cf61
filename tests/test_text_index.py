"""The positional index against the search of every text."""

import re

import pytest
from pyspark.sql import functions as F

from tallystone.operators import reconcile, text_index
from tallystone.session import shared_dir

KEYWORDS = [("a", 0, "net income"), ("a", 1, "Income"), ("b", 0, "aa"), ("b", 1, "a a"), ("c", 0, "straße"), ("c", 1, "(net) "),
            ("d", 0, "is"), ("d", 1, "σος"), ("e", 0, "U.S."), ("e", 1, "total of net income, after tax")]


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "concept", "kw_pos", "keyword", "match_idx", "snippet").collect()))


@pytest.fixture(scope="module")
def texts():
    long = " ".join(f"w{i} net  income Net Income{'s' * (i % 3)} (net) u.s. " for i in range(900))
    return [(1, "Planet Income and NET INCOME; net\nincome net_income"), (2, "aaaa aa a a a aA"), (3, None), (4, ""), (5, long),
            (6, "STRASSE Straẞe straße İs IS ıs this"), (7, "ΟΔΟΣΟΣ σοσ σοςx"),
            (8, "The total of net income, after tax. total of net income after tax"), (9, "\U0001f600 (NET) income \U0001f600 in the U.S.A"),
            (10, "x" * 2040 + " net income " + "y" * 3000), (11, "(net) (net)  incomeincome"), (12, "...")]


def test_index_equals_search_of_texts(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("id", F.lit("clash")).repartition(3)
    path = shared_dir(spark, "index-test")
    text_index.build_text_index(docs, path)
    want = rows(reconcile.keyword_snippets(docs, KEYWORDS))
    got = rows(text_index.search_text_index(spark, path, KEYWORDS))
    assert got == want and len({r[3] for r in got}) == len(KEYWORDS)
    wanted = spark.createDataFrame([(1, "a"), (5, "c"), (5, "c"), (2, "zz")], "doc_id long, concept string")
    own = rows(text_index.search_text_index(spark, path, KEYWORDS, wanted=wanted))
    assert own == [r for r in want if (r[0], r[1]) in {(1, "a"), (5, "c")}]


def test_index_reads_no_text_and_only_ranges_with_words(spark, texts):
    path = shared_dir(spark, "index-test")
    text_index.build_text_index(spark.createDataFrame(texts, "doc_id long, text string"), path)
    plan = text_index.search_text_index(spark, path, [("d", 1, "ΟΔΟΣΟΣ")])._jdf.queryExecution().toString()
    assert "regexp_replace" not in plan                       # no text is marked or split
    only = re.search(r"PushedFilters: \[[^\]]*EqualTo\(range,(\d+)\)", plan)       # one spelling, one range
    assert only and int(only[1]) in range(text_index.RANGES)


def test_index_edges(spark, texts):
    path = shared_dir(spark, "index-test")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    text_index.build_text_index(docs.limit(0), path)
    assert text_index.search_text_index(spark, path, KEYWORDS).count() == 0
    with pytest.raises(ValueError):
        text_index.build_text_index(docs.union(docs), path + "-2")
    with pytest.raises(ValueError):
        text_index.search_text_index(spark, path, [("a", 0, "%")])
    with pytest.raises(ValueError):
        text_index.search_text_index(spark, path, KEYWORDS, before=600)


def test_one_word_is_compared_with_spellings_and_blocks_are_met_once(spark, texts):
    """Matches of a keyword of one word come from its postings alone; blocks are read for the snippets, nothing is windowed."""
    path = shared_dir(spark, "index-test")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    text_index.build_text_index(docs, path)
    one = [k for k in KEYWORDS if text_index.WORD.fullmatch(k[2])]
    found = text_index.search_text_index(spark, path, one)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[id#\d+L?,block#\d+,low#\d+,part#\d+\]", plan)) == 1 and "Window" not in plan
    assert rows(found) == rows(reconcile.keyword_snippets(docs, one)) and len(one) > 3


def test_postings_of_more_than_a_piece(spark, texts, monkeypatch):
    monkeypatch.setattr(text_index, "PIECE", 50)
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    text_index.build_text_index(docs, path := shared_dir(spark, "index-test"))
    assert rows(text_index.search_text_index(spark, path, KEYWORDS)) == rows(reconcile.keyword_snippets(docs, KEYWORDS))
