
from tallystone.operators import reconcile


def test_snippet_fixture(spark):
    docs = spark.createDataFrame([(1, "Total net sales 10"), (2, "aaaa")], "doc_id long, text string")
    kws = [("revenue", 0, "net sales"), ("revenue", 1, "total net sales"), ("x", 0, "aa")]
    got = sorted((r.doc_id, r.keyword, r.match_idx, r.snippet)
                 for r in reconcile.keyword_snippets(docs, kws).collect())
    assert got == [(1, "net sales", 0, "Total net sales 10"), (1, "total net sales", 0, "Total net sales 10"),
                   (2, "aa", 0, "aaaa"), (2, "aa", 1, "aaaa")]


def test_snippet_window_and_case(spark):
    text = ("x" * 30) + "\nNet Income" + ("y" * 250)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = reconcile.keyword_snippets(docs, [("net_income", 0, "net income")]).first()
    low = text.lower()
    s = low.index("net income")
    assert r.snippet == text[max(0, s - 20):s + 10 + 200].replace("\n", " ").strip()


def test_unmapped_concept_searches_its_name(spark):
    docs = spark.createDataFrame([(1, "the operating cash rose", "operating_cash")], "doc_id long, text string, concept string")
    r = reconcile.keyword_snippets(docs, [("revenue", 0, "net sales")], concept_col="concept").collect()
    assert [(x.keyword, x.snippet) for x in r] == [("operating cash", "the operating cash rose")]


def test_reconcile_auto_golden_values(spark):
    facts = spark.createDataFrame([(111184000000.0, "Total net sales 111,184 95,359"),
                                   (-1717000000.0, "Other income (1,717)"),
                                   (29578000000.0, "Net income 29,579")], "value double, text string")
    got = [(r.verified, r.matched_scale) for r in reconcile.reconcile_auto(facts).collect()]
    assert got == [(True, 1e6), (True, 1e6), (False, None)]


def test_golden_eval_and_claims(spark):
    golden = spark.createDataFrame([("k1", 10.0), ("k2", 5.0), ("k3", 1.0)], "k string, expected_value double")
    facts = spark.createDataFrame([("k1", 10.0), ("k2", 6.0)], "k string, value double")
    ev = reconcile.golden_eval(golden, facts, ["k"])
    acc = reconcile.golden_accuracy(ev).first()
    assert (acc.n_records, acc.n_found, acc.n_match) == (3, 2, 1)
    claims = spark.createDataFrame([("k1", 10.001), ("k2", 5.0), ("k9", 1.0)], "k string, claimed_value double")
    v = {r.k: r.verdict for r in reconcile.verify_claims(claims, facts, ["k"]).collect()}
    assert v == {"k1": "verified", "k2": "mismatch", "k9": "no_fact"}


def test_general_path_with_marker_char(spark):
    from tallystone.operators.reconcile import MARK
    text = "a" + MARK + "b Net income x net INCOME y"
    docs = spark.createDataFrame([(1, text), (2, text.replace(MARK, "-"))], "doc_id long, text string")
    got = {}
    for r in reconcile.keyword_snippets(docs, [("n", 0, "net income")]).collect():
        got.setdefault(r.doc_id, []).append(r.snippet.replace(MARK, "-"))
    assert got[1] == got[2] and len(got[1]) == 2


def test_normalize_ws_finds_split_phrases(spark):
    docs = spark.createDataFrame([(1, "Total net\nsales 10")], "doc_id long, text string")
    kws = [("revenue", 0, "net sales")]
    assert reconcile.keyword_snippets(docs, kws).count() == 0
    r = reconcile.keyword_snippets(docs, kws, normalize_ws=True).collect()
    assert [x.snippet for x in r] == ["Total net sales 10"]
