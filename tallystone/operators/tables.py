"""HTML tables -> long-form cells (X2) and table profiles.

Cells are read from the page's tree (``dom``), so malformed markup gives the cells
that a browser would show. The helper runs inside ``mapInPandas`` over Arrow
batches of pages, one page at a time, and emits one row per cell. Spark
partitions the pages; nothing is collected.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.operators import dom

#: Cells sent on at once; spans can make many of a small page.
CELLS_PER_FRAME = 20_000
_WS = re.compile(r"\s+")
_PLAIN_NUMBER = re.compile(r"^-?\d{1,3}(,\d{3})+(\.\d+)?$")
_NUM = re.compile(r"^-?\d+(\.\d+)?$")


def cell_number(text: str | None) -> float | None:
    """``111,184`` -> 111184; ``(1,717)`` / ``(157,030`` -> negative;
    ``$ % ) — –`` and blanks -> None; ``2.00%`` -> 2.0."""
    if text is None:
        return None
    t = text.strip().replace("$", "").replace(",", "").replace("%", "").strip()
    neg = t.startswith("(")
    t = t.strip("()").strip()
    if not _NUM.match(t):
        return None
    v = float(t)
    return -v if neg else v


def cell_number_expr(c):
    """``cell_number`` as a Catalyst expression (for cells already in Spark)."""
    t = F.trim(F.regexp_replace(c, r"[$,%]", ""))
    neg = t.startswith("(")
    core = F.trim(F.regexp_replace(t, r"^[()]+|[()]+$", ""))
    v = F.when(core.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), core.cast("double"))
    return F.when(neg, -v).otherwise(v)


# The limits of the HTML standard.
_MOST_COLUMNS, _MOST_ROWS = 1000, 65_534


def _span(v: str | None, most: int) -> int:
    """A span attribute: its leading digits, from 1 to ``most``; 1 without any."""
    m = re.match(r"\s*\+?([0-9]{1,9})", v or "")
    return min(most, max(1, int(m[1]))) if m else 1


def _cell(node: dom.Node) -> tuple[str, int, int]:
    """(text, rowspan, colspan); thousands commas of plain numbers are taken out."""
    text = _WS.sub(" ", dom.cell_text(node)).strip()
    if _PLAIN_NUMBER.match(text):
        text = text.replace(",", "")
    return text, _span(node.attrs.get("rowspan"), _MOST_ROWS), _span(node.attrs.get("colspan"), _MOST_COLUMNS)


def _expand(rows) -> Iterator[list[str]]:
    """Rows of cell texts with spans filled in, one at a time; rows that only
    spans from above reach follow the last one. Rows without cells vanish."""
    above: dict[int, tuple[str, int]] = {}          # column -> text, rows still to fill
    rows = iter(rows)
    while True:
        cells = next(rows, None)
        if cells is None and not above:
            return
        line: dict[int, str] = {}
        below: dict[int, tuple[str, int]] = {}
        col = 0
        for text, rs, cs in cells or ():
            while col in above:
                col += 1
            for c in range(col, col + cs):
                line[c] = text
                if rs > 1:
                    below[c] = (text, rs - 1)
            col += cs
        for c, (text, left) in above.items():
            if c not in line:
                line[c] = text
                if left > 1:
                    below[c] = (text, left - 1)
        above = below
        if line:
            yield [line.get(c, "") for c in range(max(line) + 1)]


def iter_cells(html: str | None) -> Iterator[tuple[int, int, int, str]]:
    """(table_idx, row_idx, col_idx, cell) of every non-empty table; empty
    tables are skipped but keep their place in the numbering."""
    for ti, rows in dom.iter_tables(html):
        for ri, row in enumerate(_expand(map(_cell, cells) for cells in rows)):
            for ci, cell in enumerate(row):
                yield ti, ri, ci, cell


def parse_tables(html: str | None) -> list[tuple[int, int, int, str]]:
    """All cells of one page at once (``iter_cells`` yields them one by one)."""
    return list(iter_cells(html))


CELL_FIELDS = [T.StructField("table_idx", T.IntegerType()), T.StructField("row_idx", T.IntegerType()),
               T.StructField("col_idx", T.IntegerType()), T.StructField("cell", T.StringType()),
               T.StructField("num", T.DoubleType())]


def html_tables(pages: DataFrame, html_col: str = "html", id_cols=("page_id",)) -> DataFrame:
    """One row per table cell: ids, table_idx, row_idx, col_idx, cell, num."""
    ids = list(id_cols)
    src = pages.select(*ids, html_col)
    schema = T.StructType([src.schema[c] for c in ids] + CELL_FIELDS[:-1])

    names = [f.name for f in schema.fields]

    def cells(batches):
        for pdf in batches:
            rows = ((*key, *cell) for *key, html in pdf[[*ids, html_col]].itertuples(index=False, name=None)
                    for cell in iter_cells(html))
            while part := list(itertools.islice(rows, CELLS_PER_FRAME)):
                yield pd.DataFrame(part, columns=names)

    # the number rule runs JVM-side, after the parse
    return src.mapInPandas(cells, schema).withColumn("num", cell_number_expr(F.col("cell")))


def table_profile(cells: DataFrame, id_cols=("page_id",), preview_rows: int = 10) -> DataFrame:
    """Shape of every table (S8): rows, columns, cells, numeric cells, and
    the first ``preview_rows`` rows as a preview (the preview limit is the
    feature, not a cap on the computation)."""
    keys = list(id_cols) + ["table_idx"]
    prev = F.filter(F.sort_array(F.collect_list(F.when(
        F.col("row_idx") < preview_rows, F.struct("row_idx", "col_idx", "cell")))),
        lambda x: x.isNotNull())
    return cells.groupBy(*keys).agg(
        (F.max("row_idx") + 1).alias("n_rows"), (F.max("col_idx") + 1).alias("n_cols"),
        F.count(F.lit(1)).alias("n_cells"), F.count("num").alias("n_numeric"),
        prev.alias("preview"))
