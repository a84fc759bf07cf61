import pytest
from pyspark.sql import functions as F

from tallystone.functions.text import html_to_text_expr, word_tokens
from tallystone.operators import chunks


def one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("r")).first()["r"]


def test_html_to_text_fixture(spark):
    h = "<script>x</script><p>Net&nbsp; <b>income</b></p><!-- c --><p>A&amp;B</p>"
    assert one(spark, html_to_text_expr, h) == "Net\nincome\nA&B"
    assert one(spark, html_to_text_expr, "<p>&lt;b&gt;</p>") == "<b>"


def test_html_entities_single_pass(spark):
    h = "<p>&amp;lt; &#169; &#xA9; &copy; &bogus; & x</p>"
    assert one(spark, html_to_text_expr, h) == "&lt; © © © &bogus; & x"


def test_html_whitespace_and_blank_lines(spark):
    h = "<div>  a   b  </div>\n\n<div>\t</div><span>c\r\nd</span>"
    assert one(spark, html_to_text_expr, h) == "a b\nc\nd"


def sections(spark, text, min_tokens=40, merge=True):
    docs = spark.createDataFrame([(0, text)], "doc_id int, text string")
    r = chunks.split_sections(docs, min_tokens=min_tokens, merge=merge).orderBy("section_idx").collect()
    return [(s.title, s.section_text) for s in r]


def test_sections_keep_last_header(spark):
    text = "\n".join(["Cover", "Item 1. Risk", "2", "Item 2. Legal", "3", "item 1.  RISK",
                      "body one", "Item 2. Legal", "body two"])
    got = sections(spark, text, min_tokens=1)
    pre_end = text.index("item 1.  RISK")
    second = text.rindex("Item 2. Legal")
    assert got == [("Cover Page / Table of Contents", text[:pre_end]),
                   ("item 1.  RISK", text[pre_end:second]),
                   ("Item 2. Legal", text[second:])]


def test_sections_no_header(spark):
    assert sections(spark, "just words here") == [("Full Document", "just words here")]


def test_sections_no_merge_concatenates_back(spark):
    text = "intro\nItem 1. A\nx y\nItem 2. B\nz\nItem 1. A\nw"
    got = sections(spark, text, merge=False)
    assert "".join(t for _, t in got) == text


def merge(spark, secs, min_tokens):
    df = spark.createDataFrame([(secs,)], "s array<struct<title:string,text:string>>")
    r = df.select(chunks.merge_small(F.col("s"), min_tokens).alias("r")).first()["r"]
    return [(x["title"], x["text"]) for x in r]


def words(n, w="w"):
    return " ".join([w] * n)


def test_merge_fixture(spark):
    a, b, c = words(5, "a"), words(50, "b"), words(3, "c")
    got = merge(spark, [("a", a), ("b", b), ("c", c)], 40)
    assert got == [("a", a + "\n" + b + "\n" + c)]
    got = merge(spark, [("a", words(5, "a")), ("b", words(6, "b"))], 40)
    assert got == [("a", words(5, "a") + "\n" + words(6, "b"))]


@pytest.mark.parametrize("n,starts", [(0, []), (1, [0]), (500, [0]), (501, [0, 450]),
                                      (950, [0, 450]), (951, [0, 450, 900]),
                                      (1200, [0, 450, 900])])
def test_windows(spark, n, starts):
    text = " ".join(f"t{i}" for i in range(n))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = chunks.token_windows(df).orderBy("window_index").collect()
    assert [r.token_start for r in rows] == starts
    toks = text.split()
    for r in rows:
        assert r.chunk_text == " ".join(toks[r.token_start:r.token_start + 500])
    # windows cover every token
    covered = set()
    for r in rows:
        covered.update(range(r.token_start, r.token_start + r.n_tokens))
    assert covered == set(range(n))


def test_windows_bad_overlap():
    with pytest.raises(ValueError):
        chunks.token_windows_expr(word_tokens(F.lit("a")), 10, 10)


def test_build_chunks_index_across_sections(spark):
    text = "Item 1. Alpha\n" + words(60, "a") + "\nItem 2. Beta\n" + words(700, "b")
    df = spark.createDataFrame([(7, text)], "doc_id long, text string")
    rows = chunks.build_chunks(df).orderBy("chunk_index").collect()
    assert [r.chunk_index for r in rows] == [0, 1, 2]
    assert [r.section for r in rows] == ["Item 1. Alpha", "Item 2. Beta", "Item 2. Beta"]


def test_entities_follow_html5_rules(spark):
    import html as h
    cases = ["and&amp", "&ampx &notit; &copy2024", "&#169 &#x41 &#150; &#0; &#xD800; &#99999999;",
             "&amp;lt; &bogus; & &#; &#x;", "&NotEqualTilde; &rsquo;&nbsp;x"]
    from tallystone.functions.text import decode_entities
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r.r for r in df.select(decode_entities(F.col("t")).alias("r")).collect()]
    assert got == [h.unescape(c) for c in cases]
