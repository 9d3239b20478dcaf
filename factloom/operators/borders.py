"""Tables that only their layout tells: columns of text between blanks, and tables with one cell on a line.

Borders of columns are placed for a whole run of lines at once: a border gains
where lines have a wide gap and loses where it parts a word, and the best set
is found by dynamic programming. Cells on lines of their own are put into rows
by the period of their types, cells that are missing included.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators import columns, layouts
from factloom.operators.columns import CELLS, _is_head, _joined_head

_TAB = 8
_WORD = re.compile(r"\S+")
_WIDE = re.compile(r"\S(?:\t+| {2,})\S")
_CAPTION = re.compile(r"^\s*(?:e|(?:supplementary|supplemental)\s+)?table\s+\w+", re.IGNORECASE)
_LOOK_BACK, _HEADER_ROWS = 3, 3
#: What a parted word and a parted phrase (words with one blank between) cost, the share of lines that must have a gap at a border, and that which may have a word parted.
_PARTED, _PHRASE, _SHARE, _MOST_PARTED = 4.0, 1.5, 0.5, 0.1


def column_borders(lines: list[str]) -> list[int]:
    """Where new columns begin, for lines of one table; 0 is not among them.

    Candidates are the bands of places where at most a tenth of the lines would
    have a word parted, each at its last place with the fewest. A border's gain
    is the number of lines with a gap of two blanks or more there, less what it
    parts, less half of the lines that reach it; columns between borders must
    have words in two lines (in one of two).
    """
    width = max(map(len, lines))
    filled = np.zeros((len(lines), width + 2), bool)
    for i, line in enumerate(lines):
        filled[i, : len(line)] = np.frombuffer(line.encode("utf-32-le"), np.uint32) != 32
    reach = np.array([len(line) for line in lines])
    first = np.array([len(line) - len(line.lstrip()) for line in lines])
    x = np.arange(1, width)
    parted = (filled[:, x - 1] & filled[:, x]).sum(0)
    inside = (x < reach[:, None]) & (x > first[:, None])
    # A gap of two: blank at x - 1 and beside it.
    blank = ~filled
    wide = inside & blank[:, x - 1] & (blank[:, np.maximum(x - 2, 0)] | blank[:, x])
    phrase = inside & ((blank[:, x - 1] & filled[:, np.maximum(x - 2, 0)] & filled[:, x]) | (blank[:, x] & filled[:, x - 1] & filled[:, x + 1]))
    support, reached = wide.sum(0) - _PHRASE * phrase.sum(0), inside.sum(0)
    candidates, k = [], 0
    while k < len(x):
        if parted[k] > _MOST_PARTED * len(lines):
            k += 1
            continue
        end = k
        while end + 1 < len(x) and parted[end + 1] <= _MOST_PARTED * len(lines):
            end += 1
        # One place for each stretch of the band in which the same lines gain.
        at = k
        while at <= end:
            to = at
            while to + 1 <= end and support[to + 1] - _PARTED * parted[to + 1] >= support[to] - _PARTED * parted[to]:
                to += 1
            candidates.append(int(x[to]))
            while to + 1 <= end and support[to + 1] - _PARTED * parted[to + 1] <= support[to] - _PARTED * parted[to]:
                to += 1
            at = to + 1
        k = end + 1
    gains = [float(support[c - 1] - _PARTED * parted[c - 1] - max(1.0, _SHARE * reached[c - 1])) for c in candidates]
    own = [(c, g) for c, g in zip(candidates, gains, strict=True) if g >= 0]
    before = np.concatenate([np.zeros((len(lines), 1), np.int64), np.cumsum(filled, 1)], 1)
    least = min(2, len(lines) - 1)
    full = lambda a, b: int((before[:, b] > before[:, a]).sum()) >= least
    best: list[tuple[float, int]] = []  # gain of the borders up to this one, the one before it
    for i, (c, g) in enumerate(own):
        options = [(g, -1)] if full(0, c) else []
        options += [(best[j][0] + g, j) for j in range(i) if best[j][0] > float("-inf") and full(own[j][0], c)]
        best.append(max(options, key=lambda o: (o[0], o[1]), default=(float("-inf"), -1)))
    ends = [i for i in range(len(own)) if best[i][0] > 0 and full(own[i][0], width)]
    out, at = [], max(ends, key=lambda i: best[i][0], default=-1)
    while at >= 0:
        out.append(own[at][0])
        at = best[at][1]
    return out[::-1]


def _cells(line: str, borders: list[int]) -> list[str]:
    """Words of a line by the column that has most of them."""
    edges = [0, *borders, max(len(line), borders[-1] if borders else 0) + 1]
    out: list[list[str]] = [[] for _ in range(len(borders) + 1)]
    for word in _WORD.finditer(line):
        k = max(range(len(out)), key=lambda k: min(word.end(), edges[k + 1]) - max(word.start(), edges[k]))
        out[k].append(word.group())
    return [" ".join(words) for words in out]


def layout_tables(text: str) -> list[dict]:
    """Runs of two or more lines with a wide gap in each: table_no, caption, header, rows.

    A line with one cell that stands below a later column goes on with the cell
    above it. Rows of names that come first are the header, up to three of them.
    """
    lines = [x.expandtabs(_TAB).rstrip() for x in text.split("\n")]
    out, i = [], 0
    while i < len(lines):
        if "|" in lines[i] or not _WIDE.search(lines[i]):
            i += 1
            continue
        run, j = [], i
        while j < len(lines) and lines[j] and "|" not in lines[j]:
            alone = not _WIDE.search(lines[j])
            if alone and not lines[j].startswith("  "):
                break
            run.append((lines[j], alone))
            j += 1
        whole = [line for line, alone in run if not alone]
        borders = column_borders(whole) if len(whole) > 1 else []
        if borders:
            rows: list[list[str]] = []
            for line, alone in run:
                cells = _cells(line, borders)
                if alone and rows and not cells[0] and sum(map(bool, cells)) == 1:
                    rows[-1] = [f"{a} {b}".strip() for a, b in zip(rows[-1], cells, strict=True)]
                else:
                    rows.append(cells)
            names = 0
            while names < min(_HEADER_ROWS, len(rows) - 1) and _is_head(rows[names]):
                names += 1
            if names and all(_is_head(r) for r in rows):
                names = 1
            caption = next((lines[k].strip() for k in range(i - 1, max(-1, i - 1 - _LOOK_BACK), -1) if _CAPTION.match(lines[k])), None)
            out.append({"table_no": len(out) + 1, "caption": caption, "header": _joined_head(rows[:names], len(borders) + 1), "rows": rows[names:]})
        i = max(j, i + 1)
    return out


_TYPES = [(k, re.compile(CELLS[k])) for k in ("coding", "protein", "count", "gene", "person")]
_LONGEST_CELL, _WIDEST, _ALIKE = 60, 12, 0.8


def _type(cell: str) -> str:
    return next((k for k, p in _TYPES if p.search(cell)), "words")


def _unlike(a: str, b: str) -> int:
    return 0 if a == b else 1 if {a, b} == {"coding", "protein"} else 3


def _aligned(types: list[str], pattern: list[str]) -> tuple[int, list[int]]:
    """Least cost of laying cells into rows of the pattern in order, and the column of each: a missing cell costs 2, a wrong type 3, a change of the other kind 1."""
    p, far = len(pattern), 1 << 30
    cost = [far] * p
    cost[0] = 0
    steps: list[bytearray] = []  # for each cell and column after it: the column that was next before it
    for t in types:
        new, taken = [far] * p, bytearray(p)
        for start in range(p):
            if cost[start] >= far:
                continue
            for gap in range(p):  # columns that are left empty before this cell
                c = (start + gap) % p
                if start + gap >= p and start == 0:
                    break
                total = cost[start] + 2 * gap + _unlike(pattern[c], t)
                after = (c + 1) % p
                if total < new[after]:
                    new[after], taken[after] = total, start
        steps.append(taken)
        cost = new
    last = min(range(p), key=lambda c: (cost[c] + 2 * ((p - c) % p), c))
    total, out = cost[last] + 2 * ((p - last) % p), []
    for taken in reversed(steps):
        out.append((last - 1) % p)
        last = taken[last]
    return total, out[::-1]


def linear_tables(text: str) -> list[dict]:
    """Tables below a caption with one cell on a line: header cells first, then rows of as many.

    The width is that whose rows agree best in the types of their cells, rows
    that lack cells included; of equal ones the least. Tables of one type of
    cell, or without any mention of a change, are none.
    """
    out, lines, i = [], [x.strip() for x in text.split("\n")], 0
    while i < len(lines):
        if not _CAPTION.match(lines[i]):
            i += 1
            continue
        j = i + 1
        while j < len(lines) and not lines[j] and j == i + 1:
            j += 1
        first = j
        while j < len(lines) and lines[j] and len(lines[j]) <= _LONGEST_CELL and "|" not in lines[j] and not re.search(r"\t| {2,}", lines[j]) and not _CAPTION.match(lines[j]):
            j += 1
        cells = lines[first:j]
        types = [_type(c) for c in cells]
        found = None
        for width in range(2, min(_WIDEST, len(cells) // 2) + 1):
            if any(t in ("coding", "protein", "count") for t in types[:width]):
                break  # names of columns are no changes and no counts
            body = types[width:]
            pattern = body[:width]
            if len(set(pattern)) == 1 or not {"coding", "protein"} & set(pattern):
                continue
            cost, places = _aligned(body, pattern)
            if cost <= 3 * (1 - _ALIKE) * len(body) and (found is None or cost / len(body) < found[0]):
                found = (cost / len(body), width, places)
        if found:
            _, width, places = found
            rows: list[list[str]] = []
            for cell, c in zip(cells[width:], places, strict=True):
                if not rows or c <= last:  # noqa: F821  set below, with the first cell
                    rows.append([""] * width)
                rows[-1][c] = cell
                last = c
            out.append({"table_no": len(out) + 1, "caption": lines[i], "header": cells[:width], "rows": rows})
        i = max(j, i + 1)
    return out


def all_tables(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pipe, layout and linear tables of each text, numbered in this order; null texts have none."""

    def read(text: str) -> list[dict]:
        found = columns.grids(text) + layout_tables(text) + linear_tables(text)
        return [t | {"table_no": k} for k, t in enumerate(found, 1)]

    return layouts.read_tables(docs, read, id_col, text_col)


def table_facts(docs: DataFrame, gene: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Facts of all tables of a text, whatever their layout; a table that a text has twice, in one layout or two, is used once."""
    return columns.facts(columns.typed(layouts.distinct_tables(all_tables(docs, id_col, text_col), [id_col])), gene, [id_col])


def rebuilt(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and pipes: each layout and linear table of a text as a pipe table below its caption."""
    found = layouts.read_tables(docs, lambda text: [t | {"table_no": k} for k, t in enumerate(layout_tables(text) + linear_tables(text), 1)], id_col, text_col)
    row = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.size("header")))
    body = F.array_join(F.concat(F.array(row(F.col("header")), rule), F.transform("rows", row)), "\n")
    return found.select(id_col, "table_no", F.concat_ws("\n\n", "caption", body).alias("pipes"))
