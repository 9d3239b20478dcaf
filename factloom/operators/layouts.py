"""Tables of other layouts than pipes, and the facts in table rows.

A reader turns lines into the same shape as documents.tables (caption, header,
rows); it only looks at how cells stand. What the cells mean (roles of columns,
genes, notations, counts) is told by Columns on one row per table row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import counts, notation
from factloom.operators import documents
from factloom.operators.documents import MENTIONS

_GAP = re.compile(r"\t+|\s{2,}")
_CAPTION = re.compile(r"^\s*(?:e|(?:supplementary|supplemental)\s+)?(?:table|figure)\s+\w+", re.IGNORECASE)
_CELL_CHARS = 60
_MENTION = re.compile("|".join(pattern for pattern, _ in MENTIONS.values()) + r"|^\d+[acgt]>[acgt]$", re.IGNORECASE)


def join_wrapped(text: str) -> str:
    """A pipe row that goes on in the next lines, which hold a bar but do not start with one, becomes one line."""
    out: list[str] = []
    for line in text.split("\n"):
        goes_on = out and out[-1].lstrip().startswith("|") and "|" in line and not line.lstrip().startswith("|")
        if goes_on:
            out[-1] = f"{out[-1].rstrip()} {line.strip()}"
        else:
            out.append(line)
    return "\n".join(out)


def _spans(line: str) -> list[tuple[int, str]]:
    """Cells of a line that are parted by tabs or two spaces, with where they begin."""
    at, out = 0, []
    for gap in _GAP.finditer(line):
        if line[at : gap.start()].strip():
            out.append((at, line[at : gap.start()].strip()))
        at = gap.end()
    if line[at:].strip():
        out.append((at, line[at:].strip()))
    return out


def fixed_width_tables(text: str, least_rows: int = 2) -> list[dict]:
    """Runs of lines with two or more wide gaps or columns; a cell belongs to the header it stands next to."""
    out, lines, i = [], text.split("\n"), 0
    while i < len(lines):
        j = i
        while j < len(lines) and "|" not in lines[j] and len(_spans(lines[j])) >= 2:
            j += 1
        if j - i > least_rows:
            header = _spans(lines[i])
            rows = []
            for line in lines[i + 1 : j]:
                cells = [""] * len(header)
                for start, cell in _spans(line):
                    k = min(range(len(header)), key=lambda k: abs(header[k][0] - start))
                    cells[k] = f"{cells[k]} {cell}".strip()
                rows.append(cells)
            caption = next((lines[k].strip() for k in range(i - 1, max(-1, i - 4), -1) if _CAPTION.match(lines[k])), None)
            out.append({"table_no": len(out) + 1, "caption": caption, "header": [h for _, h in header], "rows": rows})
        i = max(j, i + 1)
    return out


def vertical_tables(text: str) -> list[dict]:
    """Tables with one cell per line below a caption: header cells up to the first row, which starts as every row does.

    Rows are cut where mentions of changes stand, so that each mention is in the
    column of the first one; a row with too few cells is filled, surplus cells
    join the last.
    """
    out, lines, i = [], [x.strip() for x in text.split("\n")], 0
    while i < len(lines):
        if not _CAPTION.match(lines[i]):
            i += 1
            continue
        first = i + 1
        j = first
        while j < len(lines) and lines[j] and len(lines[j]) <= _CELL_CHARS and "|" not in lines[j] and len(_spans(lines[j])) == 1 and not _CAPTION.match(lines[j]):
            j += 1
        cells = lines[first:j]
        hits = [k for k, cell in enumerate(cells) if _MENTION.search(cell)]
        head = next((k for k, cell in enumerate(cells[: hits[0]]) if k and re.search(r"(?i)variant|mutation|protein|amino|change|cdna|nucleotide", cell)), 0) if hits else 0
        lead = head if hits and re.search(r"(?i)variant|mutation|protein|amino|change|cdna|nucleotide", cells[head]) else None
        if lead is not None:
            width = hits[0] - lead
            starts = [k - lead for k in hits if (k - lead) >= width]
            starts = [s for n, s in enumerate(starts) if not n or s - starts[n - 1] > lead]
            if width > lead and starts:
                rows = []
                for s, e in zip(starts, [*starts[1:], min(len(cells), starts[-1] + width)], strict=True):
                    row = cells[s:e]
                    rows.append([*row[: width - 1], " ".join(row[width - 1 :])] if len(row) >= width else row + [""] * (width - len(row)))
                out.append({"table_no": len(out) + 1, "caption": lines[i], "header": cells[:width], "rows": rows})
        i = max(j, i + 1)
    return out


def as_pipes(table: dict) -> str:
    """A table rebuilt as pipe rows under its caption."""
    line = lambda cells: "| " + " | ".join(cells) + " |"
    body = [line(table["header"]), line(["---"] * len(table["header"])), *map(line, table["rows"])]
    return "\n".join(([table["caption"], ""] if table["caption"] else []) + body)


_FORM = pa.struct([("table_no", pa.int32()), ("caption", pa.string()), ("header", pa.list_(pa.string())), ("rows", pa.list_(pa.list_(pa.string())))])
_TYPE = "array<struct<table_no:int,caption:string,header:array<string>,rows:array<array<string>>>>"


#: Characters of texts whose tables a task holds before it hands them on.
READ_AT_ONCE = 1 << 20


def read_tables(docs: DataFrame, reader: Callable[[str], list[dict]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per table that a reader finds in a text; null texts have none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, first, size = [], 0, 0
            for i, x in enumerate(batch.column(1), 1):
                text = x.as_py() or ""
                found.append(reader(text))
                size += len(text)
                if size >= READ_AT_ONCE or i == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, i - first), pa.array(found, pa.list_(_FORM))], names=[id_col, "tables"])
                    found, first, size = [], i, 0

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(read, f"{id_col} {kind}, tables {_TYPE}").select(id_col, F.inline("tables"))


def pipe_tables(text: str) -> list[dict]:
    """Pipe tables, wrapped rows joined first."""
    return [{k: t[k] for k in ("table_no", "caption", "header", "rows")} for t in documents.pipe_tables(join_wrapped(text))]


def rebuilt(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts with their one-cell-per-line tables added as pipe tables at the end."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for x in batch.column(1):
                text = x.as_py()
                blocks = [as_pipes(t) for t in vertical_tables(text or "")]
                texts.append("\n\n".join([text.rstrip(), "## Rebuilt tables", *blocks]) if blocks else text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, text_col])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(read, f"{id_col} {kind}, {text_col} string")


# What a header says a column is, in the order they are tried.
ROLES = (
    ("gene", r"(?i)^\s*genes?\b"), ("coding", r"(?i)cdna|nucleotide|coding|\bdna\b"), ("protein", r"(?i)protein|amino"), ("variant", r"(?i)variant|mutation|change"),
    ("total", r"(?i)total|screened|sample size|tested|denominator"), ("unaffected", r"(?i)unaffected|asymptomatic|controls?\b"), ("affected", r"(?i)affected|symptomatic|\bcases?\b"),
    ("carriers", r"(?i)carriers?|heterozyg|(?:no\.?|number|n)\s*(?:of)?\s*(?:patients?|probands?|subjects?)|^\s*n\s*$|^\s*count\s*$"), ("person", r"(?i)patient|proband|subject|individual|family|kindred"), ("phenotype", r"(?i)phenotype|diagnosis|clinical"),
)
CEILING = 10_000


def role_of(header: Column) -> Column:
    out = F.when(F.lit(False), "")
    for name, pattern in ROLES:
        out = out.when(header.rlike(pattern), name)
    return out


def table_facts(tables: DataFrame, gene: str, key: list[str]) -> DataFrame:
    """Facts of table rows: key columns, table_no, variant, carriers, affected, unaffected, phenotype.

    A row counts if its change is told by a column for it, else by the first cell
    that holds a mention. With a gene column, rows of other genes are left out.
    Counts are first whole numbers up to CEILING. Without any count column, a
    table with a column of persons has one carrier per row. Rows of one change
    and table are summed; null is "not stated".
    """
    roles = F.transform("header", role_of)
    rows = tables.select(*key, "table_no", roles.alias("_roles"), F.posexplode("rows").alias("_place", "_cells"))
    cell = lambda role: F.nullif(F.trim(F.try_element_at("_cells", F.nullif(F.array_position(F.coalesce("_roles", F.array()), F.lit(role)).cast("int"), F.lit(0)))), F.lit(""))
    pattern = "|".join(p for p, _ in MENTIONS.values())
    mention = F.get(F.filter(F.transform("_cells", lambda c: F.regexp_extract(c, pattern, 0)), lambda m: m != ""), F.lit(0))
    spelled = lambda c: F.coalesce(notation.short_protein(c), notation.cdna(F.regexp_replace(c, r"^c(?=\d)", "c.")), notation.canonical(c))
    said = F.array(cell("protein"), cell("variant"), F.regexp_replace(F.upper(cell("coding")), r"^C\.?", "c."))
    named = F.coalesce(F.get(F.array_compact(F.transform(said, spelled)), F.lit(0)), notation.match_key(mention))
    counted = F.arrays_overlap("_roles", F.array(*[F.lit(r) for r in ("carriers", "affected", "unaffected")]))
    number = lambda role: F.when(counts.first_int(cell(role)) <= CEILING, counts.first_int(cell(role)))
    carriers = F.when(counted, number("carriers")).when(F.array_contains("_roles", "person"), F.when(cell("person").isNotNull(), 1))
    facts = rows.select(*key, "table_no", "_place", cell("gene").alias("_gene"), named.alias("variant"), carriers.alias("carriers"), number("affected").alias("affected"), number("unaffected").alias("unaffected"), cell("phenotype").alias("phenotype"))
    facts = facts.where(F.col("variant").isNotNull() & (F.col("variant") != "") & (F.col("_gene").isNull() | F.contains(F.upper("_gene"), F.lit(gene.upper()))))
    sums = [F.sum(c).cast("long").alias(c) for c in ("carriers", "affected", "unaffected")]
    return facts.groupBy(*key, "table_no", "variant").agg(*sums, F.min_by("phenotype", "_place").alias("phenotype"))


def distinct_tables(tables: DataFrame, key: list[str]) -> DataFrame:
    """Tables of a document whose header and rows say the same are used once, the first of them."""
    fold = lambda c: F.lower(F.regexp_replace(F.trim(c), r"\s+", " "))
    content = F.xxhash64(F.transform("header", fold), F.transform("rows", lambda r: F.transform(r, fold)))
    marked = tables.withColumn("_content", content)
    packed = F.min_by(F.struct(*[F.col(c) for c in tables.columns if c not in key]), "table_no").alias("_t")
    return marked.groupBy(*key, "_content").agg(packed).select(*key, "_t.*")


def pseudo_zones(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_rows: int = 3) -> DataFrame:
    """Runs of `least_rows` or more lines with column gaps of which any holds a mention: first and last line, number of mentions."""
    lines = docs.select(id_col, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line", "_s"))
    pattern = "|".join(p for p, _ in MENTIONS.values())
    wide = lines.where(~F.contains("_s", F.lit("|")) & F.trim("_s").rlike(r"\S(\t+|\s{2,})\S")).withColumn("_n", F.regexp_count("_s", F.lit(pattern))).withColumn("_to", F.col("line"))
    runs = documents.coalesce_intervals(wide.select(id_col, "line", "_to", "_n"), [id_col], "line", "_to", 1, [F.sum("_n").alias("mentions"), F.count(F.lit(1)).alias("rows")])
    return runs.where((F.col("rows") >= least_rows) & (F.col("mentions") > 0)).select(id_col, F.col("line").alias("first"), F.col("_to").alias("last"), "rows", "mentions")
