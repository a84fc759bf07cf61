"""HTML tree construction: pages -> nodes, and text and table cells read from them.

``parse`` builds one page's tree with the recovery that browsers apply: a stack
of open elements, implied end tags (a block ends a paragraph, an item, cell or
row the one before it), implied rows, end tags that match nothing ignored, and
misnested inline parts adopted (``<b><p>x</b>y`` leaves ``y`` plain, an inline
element cut off by a block goes on in the next one). It never raises on any
input, uses no recursion, and takes time linear in the page: elements deeper than
``DEPTH`` become siblings, as browsers do, with no text lost.

``html_nodes`` yields the nodes as rows; ``nodes_text`` joins their text in Spark.
The helper works on one page inside a task; pages are spread by Spark, and a page is
the largest thing in memory.
"""

from __future__ import annotations

import html as _html
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.functions.text import clean_lines

#: Open elements at most; what is nested deeper becomes a sibling.
DEPTH = 512
#: Node rows sent on at once.
ROWS_PER_FRAME = 20_000

# Element groups of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a b big code em font i nobr s small strike strong tt u".split())
ENDS_P = frozenset(("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                    "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul").split())
HEADINGS = frozenset(f"h{i}" for i in range(1, 7))
# What a search for an open element does not look past.
SCOPE = frozenset("html table td th caption button template marquee object applet".split())
_TABLE = frozenset(["table", "html"])
# A start tag ends the open elements on the right, unless one of the third column is met first.
ENDS = {"li": ({"li"}, SCOPE | {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, SCOPE | {"dl"}),
        "dd": ({"dt", "dd"}, SCOPE | {"dl"}), "option": ({"option"}, SCOPE | {"select", "optgroup"}),
        "optgroup": ({"option", "optgroup"}, SCOPE | {"select"}),
        "td": ({"td", "th", "caption"}, _TABLE | {"tr"}), "th": ({"td", "th", "caption"}, _TABLE | {"tr"}),
        "tr": ({"tr", "caption"}, _TABLE), "tbody": ({"tbody", "thead", "tfoot", "caption"}, _TABLE),
        "thead": ({"tbody", "thead", "tfoot", "caption"}, _TABLE), "tfoot": ({"tbody", "thead", "tfoot", "caption"}, _TABLE),
        "caption": ({"tr", "tbody", "thead", "tfoot", "caption"}, _TABLE)}

_TOKEN = re.compile(
    r"<!--(?:-?>|(?P<comment>.*?)(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|<[!/?](?P<bogus>[^>]*)(?:>|\Z)"
    r"|<[a-zA-Z/](?P<cut>[^>]*)\Z", re.S)
_ATTR = re.compile(r"([^\s\"'>/=][^\s>/=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


class Node:
    """An element (``tag``), or a text (``tag`` is None)."""

    __slots__ = ("tag", "attrs", "text", "children", "parent", "again")

    def __init__(self, tag, attrs=None, text=None, again=False):
        self.tag, self.attrs, self.text, self.again = tag, attrs or {}, text, again
        self.children: list[Node] = []
        self.parent = None

    def add(self, child: Node) -> None:
        child.parent = self
        self.children.append(child)

    def walk(self) -> Iterator[tuple[Node, int, bool]]:
        """(node, depth, hidden) below this one, in document order."""
        waiting = [(c, 0, False) for c in reversed(self.children)]
        while waiting:
            node, depth, hidden = waiting.pop()
            hidden = hidden or node.tag in HIDDEN
            yield node, depth, hidden
            waiting += [(c, depth + 1, hidden) for c in reversed(node.children)]


class _Builder:
    def __init__(self):
        self.root = Node("#page")
        self.stack = [self.root]
        self.open = Counter()                       # open elements by tag
        self.inline: list[Node | None] = []         # inline elements to go on; None where a cell began

    def push(self, node: Node) -> None:
        if len(self.stack) > DEPTH:
            self.pop()
        self.stack[-1].add(node)
        self.stack.append(node)
        self.open[node.tag] += 1

    def pop(self) -> Node:
        node = self.stack.pop()
        self.open[node.tag] -= 1
        if node.tag in ("td", "th", "caption"):     # inline elements of a cell end with it
            while self.inline and self.inline.pop() is not None:
                pass
        return node

    def find(self, tags, bounds) -> int:
        """Place in the stack of the innermost open element of ``tags`` within ``bounds``, or 0."""
        if any(self.open[t] for t in tags):
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in tags:
                    return i
                if self.stack[i].tag in bounds:
                    break
        return 0

    def close_to(self, i: int) -> None:
        while len(self.stack) > i:
            self.pop()

    def go_on(self) -> None:
        """Reopen the inline elements that a block has cut off."""
        here = set(map(id, self.stack)) if self.inline else ()
        first = len(self.inline)
        while first and self.inline[first - 1] is not None and id(self.inline[first - 1]) not in here:
            first -= 1
        for i in range(first, len(self.inline)):
            again = Node(self.inline[i].tag, self.inline[i].attrs, again=True)
            self.push(again)
            self.inline[i] = again

    def text(self, text: str) -> None:
        if text:
            if not text.isspace():
                self.go_on()
            self.stack[-1].add(Node(None, text=text))

    def start(self, tag: str, attrs: dict) -> None:
        if tag in ENDS:
            tags, bounds = ENDS[tag]
            while i := self.find(tags, bounds):
                self.close_to(i)
        if tag in ENDS_P and (i := self.find({"p"}, SCOPE)):
            self.close_to(i)
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.pop()
        if tag == "a" and (i := self.find({"a"}, SCOPE)):
            self.end("a")
        if tag in ("td", "th") and self.open["table"] and not self.find({"tr"}, _TABLE):
            self.push(Node("tr"))
        if tag not in ENDS and tag not in ENDS_P:
            self.go_on()
        node = Node(tag, attrs)
        if tag in VOID:
            self.stack[-1].add(node)
            return
        self.push(node)
        if tag in INLINE:
            alike = [n for n in self.inline[-DEPTH:] if n is not None and n.tag == tag and n.attrs == attrs]
            if len(alike) > 2:                      # no more than three alike go on
                self.inline.remove(alike[0])
            self.inline.append(node)
        elif tag in ("td", "th", "caption"):
            self.inline.append(None)

    def end(self, tag: str) -> None:
        if tag in INLINE:
            self.adopt(tag)
        elif tag in ("td", "th", "caption", "tr", "tbody", "thead", "tfoot", "table"):
            if i := self.find({tag}, _TABLE - {tag}):
                self.close_to(i)
        elif tag in HEADINGS:
            if i := self.find(HEADINGS, SCOPE):
                self.close_to(i)
        elif tag == "p" and not self.find({"p"}, SCOPE):
            self.stack[-1].add(Node("p"))
        elif i := self.find({tag}, SCOPE - {tag}):
            self.close_to(i)

    def adopt(self, tag: str) -> None:
        """End an inline element: blocks opened inside it move out of it, their content so far stays marked."""
        at = next((i for i in range(len(self.inline) - 1, -1, -1)
                   if self.inline[i] is None or self.inline[i].tag == tag), None)
        node = None if at is None else self.inline[at]
        if node is None:
            if i := self.find({tag}, SCOPE):
                self.close_to(i)
            return
        del self.inline[at]
        i = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i] is node), 0)
        if not i:
            return
        block = next((j for j in range(i + 1, len(self.stack))
                      if self.stack[j].tag in ENDS_P or self.stack[j].tag in ENDS), 0)
        if any(n.tag in SCOPE for n in self.stack[i + 1:]):
            return                                  # a cell or button inside: nothing to move
        if not block:
            self.close_to(i)                        # inline elements inside go on after it
            return
        moved, above = self.stack[block], self.stack[i - 1]
        moved.parent.children.remove(moved)
        above.add(moved)
        kept = Node(tag, node.attrs, again=True)
        for child in moved.children:
            if len(self.stack) == block + 1 or child is not self.stack[block + 1]:
                kept.add(child)
        moved.children = [c for c in moved.children if c.parent is moved]
        if kept.children:
            kept.parent = moved
            moved.children.insert(0, kept)
        for n in self.stack[i:block]:
            self.open[n.tag] -= 1
        self.stack[i:block] = []


def _attrs(rest: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(rest):
        value = next((v for v in m.groups()[1:] if v is not None), "")
        out.setdefault(m[1].lower(), _html.unescape(value) if "&" in value else value)
    return out


def _decoded(text: str) -> str:
    return _html.unescape(text) if "&" in text else text


def parse(page: str | None) -> Node:
    """The page's tree; null and empty pages give a root without children."""
    page = page or ""
    b, at = _Builder(), 0
    for_raw: dict[str, re.Pattern] = {}
    while m := _TOKEN.search(page, at):
        b.text(_decoded(page[at:m.start()]))
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            b.end(tag)
            continue
        b.start(tag, _attrs(m["rest"] or m["rest2"] or ""))
        if tag in RAW:
            # its content is text up to its end tag, or to the end of the page
            end = for_raw.setdefault(tag, re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I)).search(page, at)
            inside = page[at:end.start() if end else len(page)]
            if inside:
                b.stack[-1].add(Node(None, text=_decoded(inside) if tag in ("title", "textarea") else inside))
            at = end.end() if end else len(page)
            b.end(tag)
    b.text(_decoded(page[at:]))
    return b.root


NODE_FIELDS = [T.StructField("node_id", T.IntegerType()), T.StructField("parent_id", T.IntegerType()),
               T.StructField("depth", T.IntegerType()), T.StructField("tag", T.StringType()),
               T.StructField("text", T.StringType()), T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
               T.StructField("hidden", T.BooleanType()), T.StructField("again", T.BooleanType())]


def iter_nodes(page: str | None) -> Iterator[tuple]:
    """Rows of ``NODE_FIELDS`` in document order; the parent of the outermost ones is null."""
    number: dict[int, int] = {}
    for n, (node, depth, hidden) in enumerate(parse(page).walk()):
        number[id(node)] = n
        yield n, number.get(id(node.parent)), depth, node.tag, node.text, node.attrs or None, hidden, node.again


def html_nodes(pages: DataFrame, html_col: str = "html", id_cols=("page_id",)) -> DataFrame:
    """One row per node of every page's tree: ids, ``NODE_FIELDS``.

    ``tag`` is null for texts; ``hidden``: inside script, style or noscript; ``again``:
    an inline element reopened by the recovery. Comments are no nodes.
    """
    ids = list(id_cols)
    src = pages.select(*ids, html_col)
    schema = T.StructType([src.schema[c] for c in ids] + NODE_FIELDS)
    names = [f.name for f in schema.fields]

    def nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = ((*key, *node) for *key, page in pdf[[*ids, html_col]].itertuples(index=False, name=None)
                    for node in iter_nodes(page))
            while part := list(itertools.islice(rows, ROWS_PER_FRAME)):
                frame = pd.DataFrame(part, columns=names)
                frame["parent_id"] = frame["parent_id"].astype("Int32")
                yield frame

    return src.mapInPandas(nodes, schema)


def nodes_text(nodes: DataFrame, id_cols=("page_id",), out_col: str = "text") -> DataFrame:
    """Visible text of each page (X1) from its nodes: one text per line, blank lines dropped.

    The texts of a page meet in one group, which is no longer than the page.
    """
    line = F.when(F.col("tag").isNull() & ~F.col("hidden"), F.struct("node_id", "text"))
    lines = F.transform(F.sort_array(F.collect_list(line)), lambda x: x["text"])
    return nodes.groupBy(*id_cols).agg(clean_lines(F.array_join(lines, "\n")).alias(out_col))


def tree_text(page: str | None) -> str:
    """The texts of one page's tree, one per line, as they stand."""
    return "\n".join(n.text for n, _, hidden in parse(page).walk() if n.tag is None and not hidden)


def iter_tables(page: str | None) -> Iterator[tuple[int, list[list[Node]]]]:
    """(place among the page's tables, rows of cells) of every visible table; a nested table follows its outer one."""
    for i, (table, _, _) in enumerate((n, d, h) for n, d, h in parse(page).walk() if n.tag == "table" and not h):
        rows, waiting = [], [*reversed(table.children)]
        while waiting:
            node = waiting.pop()
            if node.tag == "tr":
                rows.append(list(_own(node, ("td", "th"))))
            if node.tag not in ("table", "td", "th"):
                waiting += reversed(node.children)
        yield i, rows


def _own(row: Node, tags) -> Iterator[Node]:
    waiting = [*reversed(row.children)]
    while waiting:
        node = waiting.pop()
        if node.tag in tags:
            yield node
        elif node.tag not in ("table", "tr"):
            waiting += reversed(node.children)


def cell_text(cell: Node) -> str:
    """All visible text of a cell, nested tables included; a line break counts as a space."""
    return "".join(" " if n.tag == "br" else n.text for n, _, hidden in cell.walk()
                   if not hidden and (n.tag is None or n.tag == "br"))
