"""html_to_text against an independent parser-based model on the driver pages."""

import re
from html.parser import HTMLParser

from tallystone.operators.html import html_to_text

SF = "/root/testdata/sf0.01"
_WS = re.compile(r"\s+")


class _Visible(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "noscript"):
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style", "noscript"):
            self.skip = max(0, self.skip - 1)

    def handle_data(self, data):
        if not self.skip:
            self.nodes.append(data)


def model(html: str) -> str:
    p = _Visible()
    p.feed(html)
    p.close()
    lines = []
    for line in "\n".join(p.nodes).splitlines():
        line = _WS.sub(" ", line).strip()
        if line:
            lines.append(line)
    return "\n".join(lines)


def test_matches_parser_model_on_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_to_text(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id] == model(r.html), r.page_id
