"""Text of article and supplement files: XML, HTML, spreadsheets, word documents, archives.

Files are scanned with Spark's binaryFile source, one row per file (so files of
up to 2 GB), or come as rows with a path and content. A file's bytes become
Markdown: headings, paragraphs and pipe tables; an archive becomes its members.
"""

from __future__ import annotations

import csv
import io
import posixpath
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What elements of article XML mean, by local name; the vocabularies of JATS and of three publishers.
TITLES = frozenset("title article-title section-title ce:section-title label-title chaptertitle".split())
PARAGRAPHS = frozenset("p para simple-para abstract-sec note-para".split())
ROWS, CELLS = frozenset(("tr", "row")), frozenset(("td", "th", "entry"))
CAPTIONS = frozenset(("caption", "legend"))
#: Blocks of text, beside paragraphs and captions, and what only holds blocks.
TEXT_BLOCKS = PARAGRAPHS | CAPTIONS | frozenset("list-item def-item disp-quote preformat verse-line attrib ce:list-item ce:displayed-quote fn".split())
CONTAINERS = frozenset("sec section ce:section body abstract front back article list def-list verse-group boxed-text fig table-wrap fn-group ack app app-group supplementary-material statement floats-group ce:list ce:display".split())
IDENTIFIERS = frozenset(("article-id", "pub-date"))
SKIPPED = frozenset("ref-list bibliography references back-matter-refs tex-math math script style permissions journal-meta history contrib-group aff".split())
HTML_SKIPPED = frozenset("script style noscript template svg nav footer header form button iframe".split())
HTML_BLOCKS = frozenset("p div section article li ul ol table tr h1 h2 h3 h4 h5 h6 blockquote figcaption caption br main body".split())
#: Members of an archive nested deeper, and archives that unpack to more than this, are listed without text.
DEEPEST, LARGEST = 3, 256 << 20


def _pipes(rows: list[list[str]]) -> str:
    rows = [[re.sub(r"\s+", " ", c).replace("|", "/").strip() for c in r] for r in rows]
    rows = [r for r in rows if any(r)]
    if not rows:
        return ""
    width = max(map(len, rows))
    rows = [r + [""] * (width - len(r)) for r in rows]
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return "\n".join([line(rows[0]), line(["---"] * width), *map(line, rows[1:])])


def _name(element: ET.Element) -> str:
    return element.tag.rsplit("}", 1)[-1].lower() if isinstance(element.tag, str) else ""


def _words(element: ET.Element) -> str:
    """All text of an element but that of skipped ones within."""
    pieces, todo = [], [element]
    while todo:
        e = todo.pop()
        if isinstance(e, str):
            pieces.append(e)
        elif _name(e) not in SKIPPED and _name(e) not in IDENTIFIERS and (_name(e) or e is element):
            pieces.append(e.text or "")
            todo += [x for child in reversed(e) for x in (child.tail or "", child)]
        # what stands behind a skipped element is its parent's
    return re.sub(r"\s+", " ", "".join(pieces)).strip()


class _Blocks:
    """Text blocks of an XML tree in order; words gather until a block begins or ends."""

    def __init__(self):
        self.out: list[str] = []
        self.pieces: list[str] = []
        self.mark = ""  # what a block begins with: the figures of a heading, or those of a list item

    def flush(self) -> None:
        if said := re.sub(r"\s+", " ", "".join(self.pieces)).strip():
            self.out.append(f"{self.mark}{said}")
            self.mark = ""
        self.pieces.clear()

    def table(self, element: ET.Element) -> None:
        """Rows as pipes; titles and captions within the table come before it, other text outside cells behind it."""
        self.flush()
        ahead, behind, rows = [], [], []
        todo: list[tuple[ET.Element, bool]] = [(element, False)]
        while todo:
            e, named = todo.pop()
            name = _name(e)
            if e is not element and (name in SKIPPED or name in IDENTIFIERS or not name):
                continue
            if name in CELLS:
                if not rows:
                    rows.append([])
                rows[-1].append(_words(e))
                continue
            if name in ROWS:
                rows.append([])
            named = named or name in TITLES or name in CAPTIONS
            (ahead if named else behind).append(e.text or "")
            todo += [(child, named) for child in reversed(e)]
            (ahead if named else behind).extend(child.tail for child in e if (child.tail or "").strip())
        for said in (ahead, None, behind):
            block = _pipes(rows) if said is None else re.sub(r"\s+", " ", " ".join(said)).strip()
            if block:
                self.out.append(block)


def xml_text(content: bytes) -> str:
    """Article XML as Markdown: titles as headings by their depth, blocks of text, tables, wherever they stand.

    All text outside SKIPPED elements is in the result once, but for the
    identifiers of IDENTIFIERS. An element of a known block kind is a block by
    itself, within a paragraph too, which goes on behind it; any other element
    is part of the block around it; where none is open it is one if it has words
    of its own, else its elements are.
    """
    made = _Blocks()
    todo: list[tuple] = [("open", ET.fromstring(content), 0, False)]
    while todo:
        step, element, depth, within = todo.pop()
        if step == "text":
            made.pieces.append(element)
            continue
        if step == "end":
            made.flush()
            made.mark = ""
            continue
        name = _name(element)
        if name in SKIPPED or not name or name in IDENTIFIERS:
            continue
        if name in ("table", "tgroup"):
            made.table(element)
            continue
        block = name in TITLES or name in TEXT_BLOCKS or name in CONTAINERS
        if block or not within:
            made.flush()
        if name in TITLES:
            made.mark = f"{'#' * min(6, max(1, depth))} "
        opens = name in TITLES or name in TEXT_BLOCKS
        if block or not within:
            todo.append(("end", None, depth, False))
        deeper = depth + (name in ("sec", "section", "ce:section", "body", "abstract"))
        mixed = bool((element.text or "").strip()) or any((child.tail or "").strip() for child in element)
        inside = within or opens or (not block and mixed)
        for child in reversed(element):
            if child.tail:
                todo.append(("text", child.tail, 0, False))
            todo.append(("open", child, deeper, inside and not (name in CONTAINERS and not opens)))
        if element.text:
            made.pieces.append(element.text)
    made.flush()
    return "\n\n".join(made.out)


class _Html(HTMLParser):
    """Blocks, headings and tables of a page in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.text: list[str] = []
        self.skip, self.level = 0, 0
        self.tables: list[list[list[str]]] = []

    def flush(self) -> None:
        said = re.sub(r"\s+", " ", "".join(self.text)).strip()
        self.text.clear()
        if not said:
            return
        if self.tables and self.tables[-1]:
            self.tables[-1][-1].append(said)
        else:
            self.out.append(f"{'#' * self.level} {said}" if self.level else said)

    def handle_starttag(self, tag, attrs):
        if tag in HTML_SKIPPED:
            self.skip += 1
        elif tag == "table":
            self.flush()
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.flush()
            self.tables[-1].append([])
        elif tag in ("td", "th"):
            self.flush()
        elif tag in HTML_BLOCKS and not self.tables:
            self.flush()
            self.level = int(tag[1]) if re.fullmatch("h[1-6]", tag) else 0

    def handle_endtag(self, tag):
        if tag in HTML_SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            said = re.sub(r"\s+", " ", "".join(self.text)).strip()
            self.text.clear()
            self.tables[-1][-1].append(said)
        elif tag == "table" and self.tables:
            self.flush()
            if rows := _pipes(self.tables.pop()):
                self.out.append(rows)
        elif tag in HTML_BLOCKS and not self.tables:
            self.flush()
            self.level = 0

    def handle_data(self, data):
        if not self.skip:
            self.text.append(data)


def html_text(content: bytes) -> str:
    page = _Html()
    page.feed(content.decode("utf-8", "replace"))
    page.close()
    page.flush()
    return "\n\n".join(page.out)


def _cell_column(reference: str) -> int:
    column = 0
    for c in re.match("[A-Z]*", reference)[0]:
        column = column * 26 + ord(c) - 64
    return column - 1


def sheet_text(content: bytes) -> str:
    """Every sheet of a workbook as a heading and a pipe table."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        members = book.namelist()
        shared = [_words(s) for s in ET.fromstring(book.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in members else []
        names = [s.get("name", "") for s in ET.fromstring(book.read("xl/workbook.xml")).iter() if _name(s) == "sheet"]
        sheets = sorted((m for m in members if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", m)), key=lambda m: int(re.search(r"\d+", m.rsplit("/", 1)[1])[0]))
        out = []
        for n, member in enumerate(sheets):
            rows = []
            for row in (r for r in ET.fromstring(book.read(member)).iter() if _name(r) == "row"):
                cells: dict[int, str] = {}
                for k, cell in enumerate(c for c in row if _name(c) == "c"):
                    value = next((_words(v) for v in cell if _name(v) in ("v", "is")), "")
                    if cell.get("t") == "s" and value:
                        value = shared[int(value)]
                    cells[_cell_column(cell.get("r", "")) if cell.get("r") else k] = value
                rows.append([cells.get(k, "") for k in range(max(cells, default=-1) + 1)])
            if table := _pipes(rows):
                out.append(f"## {names[n] if n < len(names) else member}\n\n{table}")
    return "\n\n".join(out)


def word_text(content: bytes) -> str:
    """Paragraphs and tables of a word document in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as document:
        body = next(e for e in ET.fromstring(document.read("word/document.xml")) if _name(e) == "body")
    said = lambda e: "".join(t.text or "" for t in e.iter() if _name(t) == "t").strip()
    out = []
    for element in body:
        if _name(element) == "p":
            out.append(said(element))
        elif _name(element) == "tbl":
            out.append(_pipes([[said(c) for c in r if _name(c) == "tc"] for r in element if _name(r) == "tr"]))
    return "\n\n".join(x for x in out if x)


def delimited(content: bytes, mark: str) -> str:
    return _pipes(list(csv.reader(io.StringIO(content.decode("utf-8", "replace")), delimiter=mark)))


READERS = {
    ".xml": xml_text, ".nxml": xml_text, ".html": html_text, ".htm": html_text, ".xlsx": sheet_text, ".docx": word_text,
    ".csv": lambda c: delimited(c, ","), ".tsv": lambda c: delimited(c, "\t"), ".txt": lambda c: c.decode("utf-8", "replace"), ".md": lambda c: c.decode("utf-8", "replace"),
}


def members(path: str, content: bytes, depth: int = 0) -> Iterator[tuple[str, str | None, str | None]]:
    """(path, text, problem) of a file, or of each member of an archive; what cannot be read has a problem and no text."""
    kind = posixpath.splitext(path.lower())[1]
    try:
        if kind == ".zip":
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                files = [m for m in archive.infolist() if not m.is_dir() and not posixpath.basename(m.filename).startswith(".")]
                if depth >= DEEPEST or sum(m.file_size for m in files) > LARGEST:
                    yield path, None, "archive too deep or too large"
                    return
                for member in files:
                    yield from members(f"{path}!{member.filename}", archive.read(member), depth + 1)
        elif kind in READERS:
            yield path, READERS[kind](content), None
        else:
            yield path, None, "unknown format"
    except (ET.ParseError, zipfile.BadZipFile, KeyError, StopIteration, ValueError, IndexError, RecursionError, csv.Error) as problem:
        yield path, None, type(problem).__name__


def to_text(files: DataFrame, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """One row per file, or per member of an archive: path, text, problem. Null content is empty."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = list(members(path.as_py() or "", content.as_py() or b""))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["path", "text", "problem"])

    return files.select(path_col, F.col(content_col).cast("binary")).mapInArrow(read, "path string, text string, problem string")


def scan(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The text of all files below a folder whose name fits the pattern."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return to_text(files)


def curation_rows(text_lines: DataFrame, line: str, order: str, gene: str, first: str = "GENE SYMBOL", second: str = "DISEASE LABEL") -> DataFrame:
    """Rows (array of cells) of a decorated CSV for one gene: what stands before the header line, rules of + and blank lines are passed over.

    The header is found by a partial aggregation, so the lines need not stand in one place.
    """
    cells = F.transform(F.regexp_extract_all(F.col(line), F.lit(r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1)), lambda c: F.trim(F.replace(F.regexp_replace(c, r'^"|"$', ""), F.lit('""'), F.lit('"'))))
    is_header = F.contains(line, F.lit(first)) & F.contains(line, F.lit(second))
    header = text_lines.where(is_header).agg(F.min(F.struct(F.col(order).alias("at"), cells.alias("names"))).alias("h"))
    rows = text_lines.where((F.col(line) != "") & ~F.col(line).rlike(r'^[+",]*$') & ~is_header).select(F.col(order).alias("_at"), cells.alias("cells"))
    out = rows.join(F.broadcast(header), F.col("_at") > F.col("h.at"))  # one row
    return out.where(F.upper(F.try_element_at("cells", F.array_position("h.names", F.lit(first)).cast("int"))) == gene.upper()).select(F.col("_at").alias(order), "cells", F.col("h.names").alias("names"))


def sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Reference sequences of FASTA files named after their gene: gene, sequence, length."""
    lines = spark.read.format("text").option("wholetext", "true").option("pathGlobFilter", "*.fasta").load(folder).select(F.upper(F.regexp_extract(F.input_file_name(), r"([^/]+)\.fasta$", 1)).alias("gene"), "value")
    sequence = F.regexp_replace(F.regexp_replace("value", r"(?m)^>.*$", ""), r"\s+", "")
    return lines.select("gene", F.upper(sequence).alias("sequence"), F.length(sequence).alias("length"))
