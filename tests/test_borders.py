"""Layout and linear tables: what is written is what is read, however cells are aligned, and whatever is missing."""

import random

import pytest

from factloom.operators import borders, columns

NAMES = ["Gene", "Change", "Number of carriers", "Affected", "Signs seen"]


def some_table(rng, rows):
    out = []
    for k in range(rows):
        n = rng.randrange(10, 900)
        out.append(["GENE1" if k % 3 else "SCN5A", rng.choice((f"p.Arg{n}Trp", f"R{n}W", f"c.{n}A>G")), str(rng.randrange(1, 200)), str(rng.randrange(50)), rng.choice(("long pauses", "none", "syncope at rest"))])
    return out


def written(rng, rows, inner=False):
    """Columns of their widest cell, two to four blanks between, each to the left or the right; a double blank within a cell of one row."""
    table = [NAMES, *rows]
    if inner:
        table = [list(r) for r in table]
        table[2][4] = "long  pauses"
    widths = [max(len(r[c]) for r in table) for c in range(5)]
    gaps, right = [rng.randrange(2, 5) for _ in range(5)], [rng.random() < 0.5 for _ in range(5)]
    return "\n".join("".join((r[c].rjust(widths[c]) if right[c] else r[c].ljust(widths[c])) + " " * gaps[c] for c in range(5)).rstrip() for r in table)


@pytest.mark.parametrize("seed", range(60))
def test_layouts_come_back(seed):
    rng = random.Random(seed)
    rows = some_table(rng, rng.randrange(1, 9))
    inner = len(rows) > 3
    found = borders.layout_tables("Before.\n\nTable 2 Changes\n" + written(rng, rows, inner) + "\n\nplain words behind it")
    expected = [list(r) for r in rows]
    if inner:
        expected[1][4] = "long pauses"
    assert found == [{"table_no": 1, "caption": "Table 2 Changes", "header": NAMES, "rows": expected}]


@pytest.mark.parametrize("seed", range(20))
def test_empty_cells_and_lines_that_go_on(seed):
    rng = random.Random(seed)
    rows = some_table(rng, 8)
    for r in rows[2:]:
        if rng.random() < 0.4:
            r[rng.choice((2, 3))] = ""
    text = written(random.Random(seed + 1), rows)
    lines = text.split("\n")
    at = lines[0].index("Change")
    lines.insert(4, " " * at + "(old)") if len(lines[0]) - len(lines[0].lstrip()) == 0 and at > 6 else None
    found = borders.layout_tables("\n".join(lines))[0]
    expected = [list(r) for r in rows]
    if len(lines) == 10:
        expected[2][1] += " (old)"
    assert found["rows"] == expected and found["header"] == NAMES


def test_one_row_tabs_and_prose():
    assert borders.layout_tables("Gene\tChange\tN\nGENE1\tR14W\t3")[0]["rows"] == [["GENE1", "R14W", "3"]]
    assert borders.layout_tables("A line of  prose\nwithout anything\n\n  another  one here") == []
    assert borders.layout_tables("") == [] and borders.layout_tables("é  ß\n漢  字") != []


def test_a_long_cell_may_reach_into_the_next_column():
    lines = ["Gene   Change   N", *[f"GENE1  R{10 + k}W     {k}" for k in range(20)]]
    lines[7] = "GENE1  R16Wlonger 6"  # parts one word of twenty lines
    found = borders.layout_tables("\n".join(lines))[0]
    assert found["rows"][6] == ["GENE1", "R16Wlonger", "6"] and found["rows"][0] == ["GENE1", "R10W", "0"]


@pytest.mark.parametrize("seed", range(40))
def test_linear_tables_come_back(seed):
    rng = random.Random(seed)
    rows = some_table(rng, rng.randrange(2, 12))
    for r in rows[1:]:
        if rng.random() < 0.3:
            r[rng.choice((0, 4))] = ""
    cells = NAMES + [c for r in rows for c in r if c]
    found = borders.linear_tables("Words.\n\nTable S1 All changes\n" + "\n".join(cells) + "\n\nEnd.")
    assert found == [{"table_no": 1, "caption": "Table S1 All changes", "header": NAMES, "rows": rows}]


def test_linear_text_that_is_no_table():
    assert borders.linear_tables("Table 1 Words\n" + "\n".join(["some", "plain", "words"] * 9)) == []
    assert borders.linear_tables("Table 1") == [] and borders.linear_tables("") == []


def test_facts_of_layout_tables(spark):
    rng = random.Random(3)
    rows = [["GENE1", "R14W", "9", "5", "none"], ["GENE1", "R20W", "4", "4", "none"], ["SCN5A", "R30W", "8", "1", "none"]]
    linear = "Table S1 All changes\n" + "\n".join(NAMES + [c for r in rows for c in r])
    docs = spark.createDataFrame([(1, written(rng, rows)), (2, linear), (3, None), (4, ""), (5, written(rng, rows) + "\n\n" + linear)], "doc_id long, text string")
    found = sorted((r.doc_id, r.variant, r.carriers, r.affected) for r in borders.table_facts(docs, "GENE1").collect())
    assert found == [(d, v, c, a) for d in (1, 2, 5) for v, c, a in (("R14W", 9, 5), ("R20W", 4, 4))]
    pipes = borders.rebuilt(docs.where("doc_id = 2")).first().pipes
    assert columns.grids(pipes)[0]["rows"] == rows
