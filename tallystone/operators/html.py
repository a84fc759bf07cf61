"""HTML -> text (Catalyst regex chain) and HTML -> table cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.functions.text import html_to_text_expr


def html_to_text(pages: DataFrame, html_col: str = "html", id_cols=("page_id",),
                 out_col: str = "text") -> DataFrame:
    """Visible text of each page (X1), one text node per line.

    script/style/noscript subtrees and comments are removed, every tag
    becomes a line break, character references are decoded in one pass,
    whitespace is collapsed per line and blank lines are dropped. Pure
    JVM expressions: one narrow projection over the page scan.
    """
    return pages.select(*id_cols, html_to_text_expr(F.col(html_col)).alias(out_col))
