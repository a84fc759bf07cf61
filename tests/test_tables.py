from tallystone.operators import tables


def test_cell_numbers():
    cases = {"111184": 111184.0, "(1,717)": -1717.0, "(157,030": -157030.0, ")": None, "$": None,
             "%": None, "—": None, "–": None, "": None, "2.00%": 2.0, "2.01": 2.01}
    assert {k: tables.cell_number(k) for k in cases} == cases


def test_parse_tables_spans_and_numbering():
    html = ("<table></table><script>var x='<table><tr><td>no</td></tr></table>'</script>"
            "<table><tr><th rowspan=2>A</th><td colspan=2>1,234</td></tr><tr><td>(5)</td><td>x</td></tr></table>")
    cells = tables.parse_tables(html)
    assert {c[0] for c in cells} == {1}                 # empty table 0 skipped, numbering kept
    grid = {(r, c): v for _, r, c, v in cells}
    assert grid == {(0, 0): "A", (0, 1): "1234", (0, 2): "1234", (1, 0): "A", (1, 1): "(5)", (1, 2): "x"}


def test_html_tables_dataframe(spark):
    df = spark.createDataFrame([(1, "<table><tr><td>$</td><td>2,000</td></tr></table>"), (2, "<p>none</p>")],
                               "page_id long, html string")
    rows = sorted(tuple(r) for r in tables.html_tables(df).collect())
    assert rows == [(1, 0, 0, 0, "$", None), (1, 0, 0, 1, "2000", 2000.0)]
    prof = tables.table_profile(tables.html_tables(df)).first()
    assert (prof.n_rows, prof.n_cols, prof.n_cells, prof.n_numeric) == (1, 2, 2, 1)


def test_table_csv_source_and_profile(spark):
    import os
    import tempfile

    from pyspark.sql import functions as F

    from tallystone.sources import filings

    base = tempfile.mkdtemp(prefix="tallystone-csv-")
    with open(os.path.join(base, "AAPL_10-Q_2026-05-01_1_table_4.csv"), "w") as f:
        f.write('0,1,2\nNet sales,$,111184\nOther,"(1,717)",\n"say ""hi""",x\n')
    cells = filings.read_table_csvs(spark, base)
    got = {(r.row_idx, r.col_idx): r.cell for r in cells.collect()}
    assert got[(0, 2)] == "111184" and got[(1, 1)] == "(1,717)" and got[(2, 0)] == 'say "hi"'
    assert {r.table_idx for r in cells.collect()} == {4}
    prof = tables.table_profile(cells, id_cols=("file_name",)).first()
    assert (prof.n_rows, prof.n_cols, prof.n_cells, prof.n_numeric) == (3, 3, 8, 2)


def test_table_csv_quotes_hold_line_ends_and_commas(spark):
    import csv
    import os
    import tempfile

    from tallystone.sources import filings

    base = tempfile.mkdtemp(prefix="tallystone-csv-")
    rows = [["0", "1"], ["Three Months\nEnded, March 31", 'say "hi", twice'], ["x" * 200_000, ""], ["", "(1,717)", "ragged"], ["\r\n", ","]]
    with open(os.path.join(base, "T_table_7.csv"), "w", newline="") as f:
        csv.writer(f).writerows(rows)
    open(os.path.join(base, "T_table_8.csv"), "w").close()
    got = {(r.table_idx, r.row_idx, r.col_idx): (r.cell, r.num) for r in filings.read_table_csvs(spark, base).collect()}
    assert {k: v[0] for k, v in got.items()} == {(7, i, j): c for i, row in enumerate(rows[1:]) for j, c in enumerate(row)}
    assert got[7, 2, 1][1] == -1717.0
    # 40,000 cells of one line, quotes everywhere: linear
    with open(os.path.join(base, "T_table_8.csv"), "w") as f:
        f.write("0\n" + ",".join(['"a,b"'] * 40_000))
    assert filings.read_table_csvs(spark, base).where("table_idx = 8 AND cell = 'a,b'").count() == 40_000


def test_cell_number_expr_matches_python(spark):
    from pyspark.sql import functions as F
    cases = ["111184", "(1,717)", "(157,030", ")", "$", "%", "—", "–", "", "2.00%", "2.01", " 3 ", "-4.5", "x1"]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = [r.n for r in df.select(tables.cell_number_expr(F.col("c")).alias("n")).collect()]
    assert got == [tables.cell_number(c) for c in cases]
