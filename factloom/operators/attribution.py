"""Which gene a mention belongs to: the nearest name in its clause, sentence or table row, else what its paragraph, column header, caption or section says.

Reading a text gives scopes: stretches in which mentions and names stand. A
mention looks at its scopes from the inside out. In the near ones the closest
name before it decides (an as-of join by position within the scope), else the
closest behind; the outer ones decide by the names that are in them at all.
Everything is keyed by (document, scope, its start), so no step gathers a
whole document.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: From the inside out.
NEAR = ("clause", "row", "sentence")
FAR = ("header", "paragraph", "caption", "section")
SCOPES = ("clause", "row", "sentence", "header", "paragraph", "caption", "section")
_HEADING = re.compile(r"^\s{0,3}#{1,6}\s+\S|^\s*(?:\d+(?:\.\d+)*\.?\s+)?(?:abstract|introduction|background|methods|materials and methods|results|discussion|conclusions?|case reports?)\s*:?\s*$", re.IGNORECASE)
_CAPTION = re.compile(r"^\s*(?:#+\s*|\**\s*)?(?:(?:supplementary|supplemental)\s+)?(?:table|figure|fig\.)\s+\w+", re.IGNORECASE)
_RULE = re.compile(r"^\s*\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)*\|?\s*$")
_CLAUSE, _SENTENCE = re.compile(r";|[.!?](?=\s)|\n"), re.compile(r"[.!?](?=\s)|\n")
_LOOK_BACK = 3


class Scopes:
    """The scopes of one text. `chain(at)`: those around a place, as (scope, start); `told(at)`: those for which a name at the place speaks."""

    def __init__(self, text: str):
        self.lines: list[tuple[int, str]] = []
        at = 0
        for line in text.split("\n"):
            self.lines.append((at, line))
            at += len(line) + 1
        self.starts = [s for s, _ in self.lines]
        self.clauses, self.sentences = ([0, *(m.end() for m in p.finditer(text))] for p in (_CLAUSE, _SENTENCE))
        self.kind: list[str] = []  # of each line: row, head, rule, caption, heading, blank or text
        self.table: list[int] = []  # of each line: start of its table, -1 elsewhere
        self.section: list[int] = []
        self.paragraph: list[int] = []
        self._lines_told()

    def _lines_told(self) -> None:
        section, paragraph, captions = -1, 0, {}
        n, i = len(self.lines), 0
        while i < n:
            start, line = self.lines[i]
            if "|" in line:
                j = i
                while j < n and "|" in self.lines[j][1]:
                    j += 1
                rule = next((k for k in range(i, j) if _RULE.match(self.lines[k][1])), None)
                for k in range(i, j):
                    self.kind.append("rule" if k == rule else "head" if rule is not None and k < rule else "row")
                    self.table.append(start)
                    self.section.append(section)
                    self.paragraph.append(start)
                caption = next((k for k in range(i - 1, max(-1, i - 1 - _LOOK_BACK), -1) if self.kind[k] == "caption"), None)
                captions[start] = caption
                i = j
                paragraph = -1
                continue
            kind = "heading" if _HEADING.match(line) else "caption" if _CAPTION.match(line) else "text" if line.strip() else "blank"
            if kind == "heading":
                section = start
            if kind != "text" or paragraph < 0 or (i and self.kind[-1] != "text"):
                paragraph = start
            self.kind.append(kind)
            self.table.append(-1)
            self.section.append(section)
            self.paragraph.append(paragraph)
            i += 1
        self.caption_of = {t: (self.lines[k][0] if k is not None else -1) for t, k in captions.items()}

    def _column(self, line: int, at: int) -> int:
        start, text = self.lines[line]
        return text[: at - start].count("|") - (1 if text.lstrip().startswith("|") else 0)

    def chain(self, at: int) -> list[tuple[str, int]]:
        k = bisect_right(self.starts, at) - 1
        out = []
        if self.table[k] >= 0:
            table = self.table[k]
            out += [("row", self.lines[k][0]), ("header", table * 1000 + self._column(k, at) % 1000)]
            if self.caption_of[table] >= 0:
                out.append(("caption", self.caption_of[table]))
        else:
            out += [("clause", self.clauses[bisect_right(self.clauses, at) - 1]), ("sentence", self.sentences[bisect_right(self.sentences, at) - 1]), ("paragraph", self.paragraph[k])]
        return [*out, ("section", self.section[k])] if self.section[k] >= 0 else out

    def told(self, at: int) -> list[tuple[str, int]]:
        k = bisect_right(self.starts, at) - 1
        if self.kind[k] == "head":
            return [("header", self.table[k] * 1000 + self._column(k, at) % 1000), ("row", self.lines[k][0])]
        if self.table[k] >= 0:
            return [("row", self.lines[k][0])]
        own = [("clause", self.clauses[bisect_right(self.clauses, at) - 1]), ("sentence", self.sentences[bisect_right(self.sentences, at) - 1]), ("paragraph", self.paragraph[k])]
        return [*own, *([("caption", self.lines[k][0])] if self.kind[k] == "caption" else []), *([("section", self.lines[k][0])] if self.kind[k] == "heading" else [])]


def _borders(terms: Mapping[str, str]) -> re.Pattern:
    names = "|".join(re.escape(t) for t in sorted(terms, key=lambda t: (-len(t), t)))
    return re.compile(rf"(?<![A-Za-z0-9])(?:{names})(?![A-Za-z0-9])", re.IGNORECASE) if terms else re.compile("(?!)")


def places(docs: DataFrame, mentions: DataFrame, terms: Mapping[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, end, gene, scopes) of mentions (gene is null; scopes from the inside out) and of names (those they speak for).

    Mentions come to their text as one list per document, as long as the text
    allows; the text is read once.
    """
    listed = mentions.groupBy(id_col).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    joined = docs.select(id_col, text_col).join(listed, id_col).select(id_col, text_col, "_spans")
    genes = {t.lower(): g for t, g in terms.items()}
    scope = pa.list_(pa.struct([("scope", pa.string()), ("at", pa.int64())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _borders(genes)
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                found = Scopes(text)
                rows = [(s["start"], s["end"], None, found.chain(s["start"])) for s in batch.column(2)[i].as_py()]
                rows += [(m.start(), m.end(), genes[m.group().lower()], found.told(m.start())) for m in pattern.finditer(text)]
                starts, ends, named, scopes = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([i] * len(rows))), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(named, pa.string()), pa.array([[{"scope": s, "at": a} for s, a in own] for own in scopes], scope)],
                    names=[id_col, "start", "end", "gene", "scopes"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(read, f"{id_col} {kind}, start int, `end` int, gene string, scopes array<struct<scope:string,at:bigint>>")


def attribute(docs: DataFrame, mentions: DataFrame, terms: Mapping[str, str], id_col: str = "doc_id", text_col: str = "text", before: int = 180, behind: int = 80) -> DataFrame:
    """For each mention that a gene claims: id, start, end, genes (sorted), scope (that decided).

    `terms` maps names, in any case, to genes. In a clause, row or sentence the
    nearest name that ends up to `before` characters ahead decides, in rows at
    any distance; else the nearest up to `behind` after it. A header, paragraph,
    caption or section gives all genes it names: more than one leaves it open
    which. Mentions that no scope has a gene for give no row. Null texts have
    no names; ids must be unique in `docs`; repeated mentions count once.
    """
    placed = places(docs, mentions, terms, id_col, text_col)
    each = placed.select(id_col, "start", "end", "gene", F.explode("scopes").alias("s")).select(id_col, "start", "end", "gene", F.col("s.scope").alias("scope"), F.col("s.at").alias("at"))
    of = Window.partitionBy(id_col, "scope", "at").orderBy("start", F.col("gene").isNull())
    name = F.when(F.col("gene").isNotNull(), F.struct("gene", "start", "end"))
    near = each.where(F.col("scope").isin(*NEAR)).withColumn("_before", F.last(name, True).over(of.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_behind", F.first(name, True).over(of.rowsBetween(1, Window.unboundedFollowing)))
    ahead = (F.col("_before.end") <= F.col("start")) & ((F.col("scope") == "row") | (F.col("start") - F.col("_before.end") <= before))
    after = (F.col("_behind.start") >= F.col("end")) & ((F.col("scope") == "row") | (F.col("_behind.start") - F.col("end") <= behind))
    closest = F.when(ahead, F.col("_before.gene")).when(after, F.col("_behind.gene"))
    by_name = near.where("gene is null").select(id_col, "start", "end", "scope", F.array(closest).alias("genes")).where(F.col("genes")[0].isNotNull())
    named = each.where(F.col("scope").isin(*FAR) & F.col("gene").isNotNull()).groupBy(id_col, "scope", "at").agg(F.array_sort(F.collect_set("gene")).alias("genes"))
    by_scope = each.where(F.col("scope").isin(*FAR) & F.col("gene").isNull()).join(named, [id_col, "scope", "at"]).select(id_col, "start", "end", "scope", "genes")
    level = F.array_position(F.array(*[F.lit(s) for s in SCOPES]), F.col("scope"))
    inner = F.min_by(F.struct("genes", "scope"), level).alias("b")
    return by_name.union(by_scope).groupBy(id_col, "start", "end").agg(inner).select(id_col, "start", "end", "b.genes", "b.scope")


def genes_of_changes(described: DataFrame, attributed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document and change: genes that claim any of its mentions by themselves, and the innermost scope that decided one."""
    sure = attributed.where(F.size("genes") == 1).select(id_col, "start", F.col("genes")[0].alias("gene"), "scope")
    level = F.array_position(F.array(*[F.lit(s) for s in SCOPES]), F.col("scope"))
    return described.join(sure, [id_col, "start"]).groupBy(id_col, "normalized").agg(F.array_sort(F.collect_set("gene")).alias("genes"), F.min_by("scope", level).alias("scope"))
