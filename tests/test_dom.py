"""Tree construction: recovery, text and tables of malformed pages."""

import random
import time

import pytest

from tallystone.operators import dom, tables

PIECES = ["<b>", "</b>", "<i>", "</i>", "<p>", "</p>", "<div>", "</div>", "<table>", "</table>", "<tr>", "<td>", "</td>",
          "<li>", "<ul>", "</ul>", "x", "y ", "&amp;", "<br>", "<![", "<!--", "-->", "<a href=q>", "</a>", "<h1>", "</h2>",
          "<script>", "</script>", "'", '"', "<", ">", "<th>", "<caption>", "<option>", "<button>"]


def outline(page):
    return " ".join("." * d + (n.tag + "*" * n.again if n.tag else n.text) for n, d, _ in dom.parse(page).walk())


@pytest.mark.parametrize("page, want", [
    ("<p>a</p><![x[ b ]]><p>c</p>", "p .a p .c"),                                  # a marked section is a comment
    ("<b><p>x</b>y</p>", "b p .b* ..x .y"),                                        # the block moves out of the inline part
    ("<p><b>one<br><p>two</b> three", "p .b ..one ..br p .b* ..two . three"),
    ("<b>1<i>2</b>3</i>4", "b .1 .i ..2 i* .3 4"),
    ("<b><i><p>1</i>2</b>3</p>4", "b .i p .b* ..i* ...1 ..2 .3 4"),
    ("<table><td>a<td>b<tr><td>c</table>d", "table .tr ..td ...a ..td ...b .tr ..td ...c d"),
    ("<table><tr><td><b>y<td>z</table>w", "table .tr ..td ...b ....y ..td ...z w"),   # a cell ends its inline parts
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "ul .li ..a .li ..b ..ul ...li ....c .li ..d e"),
    ("<a href='x'>1<a>2</a>", "a .1 a .2"),
    ("<title>a<b>&amp;</title><p>t", "title .a<b>& p .t"),
    ("<p title='a > b' x=\"<p>\">c", "p .c"),
    ("a < b <c", "a < b "),
    ("<h1>a<h2>b</h1>c", "h1 .a h2 .b c"),
    ("</p>x</div>", "p x"),
])
def test_recovery(page, want):
    assert outline(page) == want


@pytest.mark.parametrize("unit", ["<div>", "<b><p>", "<p><b>x<i>y</b>", "<table><tr><td>", '<a b="c>', "<", "<!--", "<script>",
                                  "<a '", "<p><b a=1></p></b>", "<![x["])
def test_long_malformed_pages_take_linear_time(unit):
    start = time.perf_counter()
    nodes = sum(1 for _ in dom.parse(unit * 20_000 + "end").walk())
    assert time.perf_counter() - start < 20 and nodes <= 20_000 * 10 + 1


def test_deep_pages_keep_their_text():
    assert dom.tree_text("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>after") == "deep\nafter"


def test_every_tree_is_a_tree_and_keeps_the_text():
    rng = random.Random(2)
    for _ in range(4000):
        page = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))
        seen = set()
        for node, _, _ in dom.parse(page).walk():
            assert id(node) not in seen and sum(c is node for c in node.parent.children) == 1
            seen.add(id(node))
        plain = [x for x in PIECES if x in ("x", "y ") or x.startswith("<") and x not in ("<", "<![", "<!--", "<script>", "</script>")]
        page = "".join(rng.choice(plain) for _ in range(rng.randint(0, 25)))
        words = "".join(page.split(">")[i].split("<")[0] for i in range(len(page.split(">"))))
        assert dom.tree_text(page).replace("\n", "") == words


def test_nodes_and_text_rows(spark):
    pages = spark.createDataFrame([(1, "<p>a <b>b</b><script>no</script><!-- no --><p>&lt;c&gt;"), (2, None), (3, ""),
                                   (4, "<noscript><p>no</noscript>  <i>x\n y</i>")], "page_id long, html string")
    nodes = dom.html_nodes(pages)
    got = [(r.node_id, r.parent_id, r.depth, r.tag, r.text, r.hidden) for r in nodes.where("page_id = 1").orderBy("node_id").collect()]
    assert got == [(0, None, 0, "p", None, False), (1, 0, 1, None, "a ", False), (2, 0, 1, "b", None, False),
                   (3, 2, 2, None, "b", False), (4, 0, 1, "script", None, True), (5, 4, 2, None, "no", True),
                   (6, None, 0, "p", None, False), (7, 6, 1, None, "<c>", False)]
    assert {r.page_id: r.text for r in dom.nodes_text(nodes).collect()} == {1: "a\nb\n<c>", 4: "x\ny"}
    assert dom.html_nodes(pages.limit(0)).collect() == []


def test_table_cells_of_malformed_tables():
    def grid(page):
        return [c for c in tables.parse_tables(page)]
    assert grid("<table><tr><td>a<td>b<tr><td>c</table>") == [(0, 0, 0, "a"), (0, 0, 1, "b"), (0, 1, 0, "c")]
    assert grid("<![x[<table>]]><table><thead><th>h<tbody><tr><td>1,000<br>x") == [(0, 0, 0, "h"), (0, 1, 0, "1,000 x")]
    outer = grid("<table><tr><td>o<table><tr><td>i</table><td>p</table>")
    assert outer == [(0, 0, 0, "oi"), (0, 0, 1, "p"), (1, 0, 0, "i")]
    assert grid("<script><table><tr><td>no</script><noscript><table><tr><td>no</table></noscript>") == []
    wide = grid("<table><tr><td colspan=1000000000>w</table>")
    assert len(wide) == 1000                                                       # the limit of the HTML standard
    assert len(grid("<table><tr><td rowspan=99999999999 colspan='x'>w<td rowspan=0>v</table>")) == 65_534 + 1
