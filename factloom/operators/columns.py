"""What the columns of a table are, told by header and cells together, and the facts of its rows.

A reader gives pipe tables with all their header rows, tables without headers
and continued ones included. Each column has a score for each role, from words
of its header and from the share of its cells that look like the role; columns
and roles are then matched one to one for the greatest sum. Scores and facts
are Columns over one row per table or table row; only the matching is Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from factloom.functions import notation
from factloom.operators import layouts
from factloom.operators.documents import MENTIONS, split_cells

_MENTION = re.compile("|".join(p for p, _ in MENTIONS.values()) + r"|\bp\.\(|^\W*[ACDEFGHIKLMNPQRSTVWY]\d{1,5}(?:[ACDEFGHIKLMNPQRSTVWYX*]|fs)\W*$|^c?\.?\d+(?:[+-]\d+)?[ACGT]>[ACGT]|\d(?:del|dup|ins)")
_NUMBER = re.compile(r"^\W*\d{1,5}(?:\s*/\s*\d{1,5})?\W*\w{0,10}\W*$")
_RULE = re.compile(r"^\s*\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)*\|?\s*$")
_CAPTION = re.compile(r"^\s*\|?\s*(?:#+\s*|\**\s*)?(?:e|(?:supplementary|supplemental)\s+)?table\s+\w+", re.IGNORECASE)
_CONTINUED = re.compile(r"(?i)\bcont(?:inued|\.?d)?\b")
_LOOK_BACK, _HEADER_ROWS = 4, 3


def _is_head(cells: list[str]) -> bool:
    """A row of names: more than one cell filled, none of them a mention or a count."""
    filled = [c for c in cells if c]
    return len(filled) > 1 and not any(_MENTION.search(c) or _NUMBER.match(c) for c in filled)


def _joined_head(rows: list[list[str]], width: int) -> list[str]:
    """One name for each column: those of its header rows joined; in all but the last row a name holds for the empty cells behind it."""
    spread = []
    for k, row in enumerate(rows):
        own, last = [], ""
        for c in [*row, *[""] * width][:width]:
            last = c if c or k + 1 == len(rows) else last
            own.append(last)
        spread.append(own)
    return [" ".join(dict.fromkeys(x for x in column if x)) for column in zip(*spread, strict=True)] if rows else [""] * width


def grids(text: str) -> list[dict]:
    """Pipe tables of a text: table_no, caption, header, rows.

    Rows above a rule are header rows, and so are up to three rows of names that
    come first below it, or first in a table without a rule. A table without any
    is a continuation if the one before it, of as many columns, ended within
    four lines, or the caption between them says so; else its header is empty.
    """
    lines, out, i, ended = layouts.join_wrapped(text).split("\n"), [], 0, -_LOOK_BACK - 1
    while i < len(lines):
        if "|" not in lines[i]:
            i += 1
            continue
        j = i
        while j < len(lines) and "|" in lines[j]:
            j += 1
        block = lines[i:j]
        rule = next((k for k, line in enumerate(block) if _RULE.match(line)), 0)
        caption = next((lines[k].strip() for k in range(i - 1, max(-1, i - 1 - _LOOK_BACK), -1) if _CAPTION.match(lines[k])), None)
        head = [split_cells(x) for x in block[:rule]]
        body = [split_cells(x) for x in block[rule:] if not _RULE.match(x)]
        if head and len([c for c in head[0] if c]) == 1 and _CAPTION.match(next(c for c in head[0] if c)):
            caption, head = next(c for c in head[0] if c), head[1:]  # a caption written as the first row
        names = 0
        while names < min(_HEADER_ROWS, len(body)) and _is_head(body[names]) and len(body) > names + 1:
            names += 1
        # Rows of names are headers only before rows that are none.
        if names and (head or not all(_is_head(r) for r in body)):
            head, body = head + body[:names], body[names:]
        width = max((len(r) for r in [*head, *body]), default=0)
        goes_on = out and not head and width == len(out[-1]["header"]) and (i - ended <= _LOOK_BACK or bool(caption and _CONTINUED.search(caption)))
        if goes_on or (out and head and caption and _CONTINUED.search(caption) and _joined_head(head, width) == out[-1]["header"]):
            out[-1]["rows"] += body
        elif body:
            out.append({"table_no": len(out) + 1, "caption": caption, "header": _joined_head(head, width), "rows": body})
        i = ended = j
    return out


def read_grids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """grids() of each text, a row a table; null texts and texts without a bar have none."""
    return layouts.read_tables(docs.where(F.contains(text_col, F.lit("|"))), grids, id_col, text_col)


# Words of headers for each role, the more telling first.
HEADERS: tuple[tuple[str, str], ...] = (
    ("gene", r"(?i)^\s*(?:gene|symbol|locus)s?\b"),
    ("coding", r"(?i)\bcdna\b|nucleotide|coding|\bdna\b|\bc\."),
    ("protein", r"(?i)protein|amino|\baa\b|\bp\."),
    ("variant", r"(?i)variant|mutation|change|allele\s*name"),
    ("total", r"(?i)^(?!.*carrier).*(?:\btotal\b|screened|sample\s*size|tested|denominator|cohort)"),
    ("unaffected", r"(?i)unaffected|asymptomatic|controls?\b|healthy"),
    ("affected", r"(?i)(?<!un)affected|(?<!a)symptomatic|\bcases?\b"),
    ("carriers", r"(?i)carriers?|heterozyg|(?:no\.?|number|n|#)\s*(?:of)?\s*(?:patients?|probands?|subjects?|families)|^\s*n\s*$|^\s*(?:count|no\.?)\s*$"),
    ("person", r"(?i)^\s*(?:patient|proband|subject|individual|family|kindred|case)\s*(?:id|no\.?|number|#)?\s*$"),
    ("phenotype", r"(?i)phenotype|diagnosis|clinical|symptoms?\b"),
)
ROLES = tuple(r for r, _ in HEADERS)
COUNTS = ("carriers", "affected", "unaffected", "total")

#: What cells of a role look like.
CELLS = {
    "gene": r"^\W*(?!(?:[ACDEFGHIKLMNPQRSTVWY]\d+[A-Z*]|[IVX]+)\W*$)[A-Z][A-Z0-9]{1,7}(?:-[A-Z0-9]+)?\W*$",
    "coding": r"(?i)^\W*c\.[\d*-]|^\W*\d+(?:[+-]\d+)?(?:_\d+)?(?:[ACGT]>[ACGT]|(?:del|dup|ins)[ACGT]*\W*$)|^\W*IVS\d",
    "protein": r"(?i)^\W*p\.|^\W*(?:" + "|".join(notation.RESIDUES) + r")\d+|^\W*[ACDEFGHIKLMNPQRSTVWY]\d{1,5}(?:[ACDEFGHIKLMNPQRSTVWYX*]|fs|del|dup|ins)",
    "count": r"^\W*\d{1,5}(?:\s*/\s*\d{1,5})?(?:\s*\(\s*\d+(?:\.\d+)?\s*%?\s*\))?\W*(?:[a-z]\W*|patients?|carriers?|cases?|subjects?|probands?|individuals?)?\W*$",
    "person": r"^\W*(?:[A-Z]{1,3}\W?\d{1,4}|[IVX]+\W\d{1,3}|(?i:patient|family|proband)\W*\d+)\W*$",
    "words": r"[a-z]{3,}[\s,]",
}
#: Points: a header that names the role; a column full of its cells; the least that a match must have.
NAMED, FULL, LEAST = 100, 120, 40


def _parts(rows: Column, col: Column) -> Column:
    return F.filter(F.transform(rows, lambda r: F.trim(F.coalesce(F.try_element_at(r, col), F.lit("")))), lambda c: c != "")


def _points(header: Column, cells: Column) -> Column:
    """Points of one column for each role, in the order of ROLES."""
    n = F.greatest(F.size(cells), F.lit(1))
    share = {k: F.size(F.filter(cells, lambda c: c.rlike(p))) / n for k, p in CELLS.items()}  # noqa: B023  the lambda is called at once
    named = F.lit(None).cast("string")
    for role, pattern in reversed(HEADERS):
        named = F.when(header.rlike(pattern), F.lit(role)).otherwise(named)
    own = {
        "gene": FULL * share["gene"], "coding": FULL * share["coding"], "protein": FULL * share["protein"],
        "variant": 70 * F.greatest(share["protein"], share["coding"]), "person": 60 * share["person"], "phenotype": 45 * share["words"],
    }
    out = []
    for role in ROLES:
        said = F.when(named == role, NAMED).otherwise(0)
        if role in COUNTS:  # words without numbers are no counts
            points = F.when(share["count"] >= 0.5, said + 30 * share["count"]).otherwise(0)
        else:  # numbers are none of these, whatever the header says
            points = F.when((share["count"] >= 0.5) & (role != "person"), 0).otherwise(said + own[role])
            points = F.when((role in ("gene", "coding", "protein")) & (F.size(cells) > 0) & (own[role] < 12) & (F.greatest(share["coding"], share["protein"]) > 0.5), 0).otherwise(points)
        out.append(F.round(points).cast("int"))
    return F.array(*out)


def best_roles(points: list[list[int]], least: int = LEAST) -> list[int]:
    """For each column the place of its role, -1 for none: the one-to-one matching with the greatest sum of points above `least`; of equal sums the earlier columns and roles.

    Shortest augmenting paths with potentials, a role at a time; each role has
    an own column of no points, in which it may stay alone.
    """
    width = len(points)
    if not width:
        return []
    roles = len(points[0])
    columns = width + roles
    scale = 1000  # points come first, then the order
    cost = [[-(max(0, points[c][r] - least) * scale - (c if points[c][r] > least else 0)) if c < width else (0 if c - width == r else 1) for c in range(columns)] for r in range(roles)]
    by_role, by_column = [0] * (roles + 1), [0] * (columns + 1)
    owner, way = [0] * (columns + 1), [0] * (columns + 1)
    for r in range(1, roles + 1):
        owner[0], at = r, 0
        least_to, used = [float("inf")] * (columns + 1), [False] * (columns + 1)
        while owner[at]:
            used[at] = True
            row, delta, nearest = owner[at], float("inf"), 0
            for c in range(1, columns + 1):
                if not used[c]:
                    now = cost[row - 1][c - 1] - by_role[row] - by_column[c]
                    if now < least_to[c]:
                        least_to[c], way[c] = now, at
                    if least_to[c] < delta:
                        delta, nearest = least_to[c], c
            for c in range(columns + 1):
                if used[c]:
                    by_role[owner[c]] += delta
                    by_column[c] -= delta
                else:
                    least_to[c] -= delta
            at = nearest
        while at:
            owner[at], at = owner[way[at]], way[at]
    return [owner[c + 1] - 1 if owner[c + 1] and points[c][owner[c + 1] - 1] > least else -1 for c in range(width)]


def _matched(tables: DataFrame) -> DataFrame:
    """Tables with the matching of their points as `_roles`."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = [best_roles(m) for m in batch.column("_points").to_pylist()]
            yield batch.append_column("_roles", pa.array(roles, pa.list_(pa.int32())))

    return tables.mapInArrow(match, StructType([*tables.schema.fields, StructField("_roles", ArrayType(IntegerType()))]))


def _sums(tables: DataFrame, counted: list[Column]) -> Column:
    """Whether three columns of counts without names hold carriers, affected and unaffected, the first the sum of the others, in all rows that have them."""
    a, b, c = counted
    rows = F.filter("rows", lambda r: F.try_element_at(r, a).rlike(r"^\d{1,5}$") & F.try_element_at(r, b).rlike(r"^\d{1,5}$") & F.try_element_at(r, c).rlike(r"^\d{1,5}$"))
    whole = lambda r, k: F.try_element_at(r, k).cast("int")
    return (F.size(rows) >= 2) & F.forall(rows, lambda r: whole(r, a) == whole(r, b) + whole(r, c))


def typed(tables: DataFrame) -> DataFrame:
    """Tables with `roles`: for each column the name of its role, or null.

    Counts without a header are told by arithmetic: of three such columns the
    one that is the sum of the other two in every row is that of carriers, the
    others affected and unaffected in order; a single one is that of carriers.
    """
    width = F.size("header")
    numbers = F.when(width > 0, F.sequence(F.lit(1), width)).otherwise(F.array().cast("array<int>"))
    points = F.transform(numbers, lambda k: _points(F.element_at("header", k), _parts(F.col("rows"), k)))
    scored = _matched(tables.withColumn("_points", points))
    names = F.array(*[F.lit(r) for r in ROLES])
    told = F.transform("_roles", lambda r: F.when(r >= 0, F.element_at(names, r + 1)))
    scored = scored.withColumn("_told", told)
    blank = F.filter(numbers, lambda k: (F.element_at("header", k) == "") & F.element_at("_told", k).isNull() & (F.size(F.filter(_parts(F.col("rows"), k), lambda c: c.rlike(CELLS["count"]))) * 2 >= F.greatest(F.size(_parts(F.col("rows"), k)), F.lit(1))))
    scored = scored.withColumn("_blank", blank)
    at = [F.try_element_at("_blank", F.lit(i)) for i in (1, 2, 3)]
    three = F.size("_blank") == 3
    orders = [(0, 1, 2), (1, 0, 2), (2, 0, 1)]
    sums = F.when(F.size("_blank") == 1, F.array(at[0], F.lit(None).cast("int"), F.lit(None).cast("int")))
    for o in orders:
        picked = [at[i] for i in o]
        sums = sums.when(three & _sums(scored, picked), F.array(*picked))
    scored = scored.withColumn("_sums", sums)
    free = lambda role: ~F.array_contains("_told", role)
    final = F.transform("_told", lambda t, i: F.coalesce(t, F.when((F.col("_sums")[0] == i + 1) & F.coalesce(free("carriers"), F.lit(True)), "carriers").when(F.col("_sums")[1] == i + 1, "affected").when(F.col("_sums")[2] == i + 1, "unaffected")))
    return scored.withColumn("roles", final).drop("_points", "_roles", "_told", "_blank", "_sums")


# What a column of counts counts, by words of its header.
_COUNT_TYPES = (
    ("family_count", r"(?i)famil|kindred"), ("proband_count", r"(?i)proband"), ("unaffected_control", r"(?i)control"), ("case", r"(?i)^\s*cases?\s*$"),
    ("cohort_total", r"(?i)total\s*(?:cases?|controls?|samples?)|sample\s*size|cohort\s*size"), ("screened_N", r"(?i)screened|(?:n|number)\s*tested"),
)
CEILING = 10_000


def count_type(header: Column) -> Column:
    out = F.when(F.coalesce(header, F.lit("")) == "", None)
    for name, pattern in _COUNT_TYPES:
        out = out.when(header.rlike(pattern), name)
    return out.otherwise("per_variant_carrier")


def facts(tables: DataFrame, gene: str, key: list[str]) -> DataFrame:
    """Facts of the rows of typed tables: key columns, table_no, variant, carriers, affected, unaffected, total, count_type, phenotype.

    A row is of the gene that its gene cell names; else of that of the last row
    before it with a single filled cell, a gene's name; else of the caption's.
    Rows of other genes are left out. The change is that of the protein column,
    else the variant or coding one, else the first mention of the row.

    Of n/N in a column of carriers n are carriers and N the total; in one of
    affected ones n are affected and N are carriers, unless other columns say
    these. Percentages, footnote marks and units are no counts; numbers beyond
    CEILING are left out. Without any column of counts, persons count one each.
    Rows of one change and table are summed; null is "not stated".
    """
    rows = tables.select(*key, "table_no", "caption", "header", "roles", F.col("rows").alias("_rows"), F.posexplode("rows").alias("_place", "_cells"))
    at = lambda role: F.nullif(F.array_position(F.coalesce("roles", F.array().cast("array<string>")), F.lit(role)).cast("int"), F.lit(0))
    cell = lambda role: F.nullif(F.trim(F.try_element_at("_cells", at(role))), F.lit(""))
    name = r"^\W*([A-Z][A-Z0-9]{1,7})\W*$"
    single = lambda r: F.filter(F.transform(r, F.trim), lambda c: c != "")
    divider = lambda r: (F.size(single(r)) == 1) & (F.size(r) > 1) & F.get(single(r), F.lit(0)).rlike(name)
    dividers = F.filter(F.transform("_rows", lambda r, i: F.when(divider(r), F.struct(i.alias("i"), F.regexp_extract(F.get(single(r), F.lit(0)), name, 1).alias("g")))), lambda d: d.isNotNull())
    # Dividers of a table are told once; a row takes the last before it.
    sections = tables.select(*key, "table_no", F.col("rows").alias("_rows")).select(*key, "table_no", dividers.alias("_dividers"))
    rows = rows.drop("_rows").join(sections, [*key, "table_no"])
    section = F.try_element_at(F.filter("_dividers", lambda d: d["i"] < F.col("_place")), F.lit(-1))["g"]
    named_in = F.regexp_extract_all(F.coalesce("caption", F.lit("")), F.lit(r"\b([A-Z][A-Z0-9]{2,7})\b"), F.lit(1))
    of = F.coalesce(cell("gene"), section)
    own = F.contains(F.upper(of), F.lit(gene.upper()))
    by_caption = (F.size(F.filter(named_in, lambda g: g.rlike(r"\d"))) == 0) | F.exists(named_in, lambda g: g == gene.upper())
    mine = F.when(of.isNotNull(), own).otherwise(by_caption)

    pattern = "|".join(p for p, _ in MENTIONS.values())
    mention = F.get(F.filter(F.transform("_cells", lambda c: F.regexp_extract(c, pattern, 0)), lambda m: m != ""), F.lit(0))
    plain = lambda c: F.regexp_replace(c, r"^\W*|[()]|(?<=\w)[†‡§¶#]+$", "")
    spelled = lambda c: F.coalesce(notation.short_protein(plain(c)), notation.cdna(F.regexp_replace(plain(c), r"^c(?=\d)", "c.")), notation.canonical(plain(c)))
    said = F.array(cell("protein"), cell("variant"), F.regexp_replace(F.upper(plain(cell("coding"))), r"^C\.?", "c."))
    change = F.coalesce(F.get(F.array_compact(F.transform(said, spelled)), F.lit(0)), notation.match_key(mention))

    whole = lambda c: F.regexp_extract(c, r"(?<![\d.,/%])(\d{1,5})(?![\d,]|\.\d|\s*%)", 1).try_cast("int")
    fits = lambda n: F.when(n <= CEILING, n)
    behind = lambda c: F.regexp_extract(c, r"\d{1,5}\s*/\s*(\d{1,5})", 1).try_cast("int")
    number = {r: fits(whole(cell(r))) for r in COUNTS}
    has = lambda r: at(r).isNotNull()
    counted = has("carriers") | has("affected") | has("unaffected")
    carriers = F.when(has("carriers"), number["carriers"]).when(has("affected") & behind(cell("affected")).isNotNull(), fits(behind(cell("affected")))).when(~counted & cell("person").isNotNull(), 1)
    total = F.when(has("total"), number["total"]).when(has("carriers"), fits(behind(cell("carriers"))))
    kind = count_type(F.try_element_at("header", F.coalesce(at("carriers"), at("affected"))))
    made = rows.where(mine).select(*key, "table_no", "_place", change.alias("variant"), carriers.alias("carriers"), number["affected"].alias("affected"), number["unaffected"].alias("unaffected"), total.alias("total"), kind.alias("count_type"), cell("phenotype").alias("phenotype"))
    sums = [F.sum(c).cast("long").alias(c) for c in ("carriers", "affected", "unaffected", "total")]
    firsts = [F.min_by(c, "_place").alias(c) for c in ("count_type", "phenotype")]
    return made.where((F.col("variant").isNotNull()) & (F.col("variant") != "")).groupBy(*key, "table_no", "variant").agg(*sums, *firsts)


def typed_facts(docs: DataFrame, gene: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Facts of all pipe tables of the texts; a table that a text has twice is used once."""
    return facts(typed(layouts.distinct_tables(read_grids(docs, id_col, text_col), [id_col])), gene, [id_col])
