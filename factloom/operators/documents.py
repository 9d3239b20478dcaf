"""Rows out of documents: pipe tables, mentions, links, captions, zones.

Tables need the lines of a text in order and are read by a Python table
function in Arrow batches; everything a pattern can say is a Column expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import notation
from factloom.functions.text import evidence_score
from factloom.operators.relational import coalesce_intervals

_RULE = re.compile(r"^\s*\|?\s*:?-{2,}:?\s*(\|\s*:?-{2,}:?\s*)*\|?\s*$")
_CAPTION = re.compile(r"^\s*(?:#+\s*|\**\s*)?(?:supplementary\s+)?table\s+\w+", re.IGNORECASE)

TABLE_TYPE = "table_no int, caption string, header array<string>, rows array<array<string>>, start_char long, end_char long"


def split_cells(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def pipe_tables(text: str, look_back: int = 3) -> list[dict]:
    """Bordered and borderless pipe tables: two or more lines with a bar, one of them a rule; the caption stands within a few lines above."""
    lines, out, at = text.split("\n"), [], 0
    starts = []
    for line in lines:
        starts.append(at)
        at += len(line) + 1
    i = 0
    while i < len(lines):
        if "|" not in lines[i]:
            i += 1
            continue
        j = i
        while j < len(lines) and "|" in lines[j]:
            j += 1
        block = lines[i:j]
        rule = next((k for k, line in enumerate(block) if _RULE.match(line)), None)
        if rule and len(block) > rule:
            caption = next((lines[k].strip() for k in range(i - 1, max(-1, i - 1 - look_back), -1) if _CAPTION.match(lines[k])), None)
            rows = [split_cells(line) for line in block[rule + 1 :] if not _RULE.match(line)]
            out.append({"table_no": len(out) + 1, "caption": caption, "header": split_cells(block[rule - 1]), "rows": rows, "start_char": starts[i], "end_char": starts[j - 1] + len(lines[j - 1])})
        i = j
    return out


def tables(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per table of each document; null texts have none."""
    form = pa.struct([("table_no", pa.int32()), ("caption", pa.string()), ("header", pa.list_(pa.string())), ("rows", pa.list_(pa.list_(pa.string()))), ("start_char", pa.int64()), ("end_char", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pipe_tables(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(form))], names=[id_col, "tables"])

    kind = docs.schema[id_col].dataType.simpleString()
    made = docs.select(id_col, text_col).where(F.contains(text_col, F.lit("|"))).mapInArrow(read, f"{id_col} {kind}, tables array<struct<{TABLE_TYPE.replace(' int', ':int').replace(' string', ':string').replace(' array', ':array').replace(' long', ':bigint')}>>")
    return made.select(id_col, F.inline("tables"))


# Header words in the order they are tried.
_ROLES = (("unaffected", r"(?i)unaffected|asymptomatic|control"), ("affected", r"(?i)affected|symptomatic|cases?"), ("carriers", r"(?i)carriers?|heterozyg|patients?|\bn\b"))
_DENOMINATOR = r"(?i)total|screened|sample size|tested"


def table_counts(found: DataFrame, keys: list[str], ceiling: int = 10_000) -> DataFrame:
    """Sum of the first whole number of each cell by the role of its column; larger numbers and denominators are left out."""
    cell = F.posexplode("row").alias("col", "cell")
    cells = found.select(*keys, "header", F.explode("rows").alias("row")).select(*keys, "header", cell).withColumn("label", F.try_element_at("header", F.col("col") + 1))
    role = F.when(F.col("label").rlike(_DENOMINATOR), None)
    for name, pattern in _ROLES:
        role = role.when(F.col("label").rlike(pattern), name)
    number = F.regexp_extract("cell", r"\d{1,5}", 0).try_cast("int")
    return cells.select(*keys, role.alias("role"), number.alias("n")).where(F.col("role").isNotNull() & (F.col("n") <= ceiling)).groupBy(*keys, "role").agg(F.sum("n").cast("long").alias("total"))


#: Patterns of mentions, with the confidence of each.
MENTIONS = {
    "hgvs_protein": (r"\bp\.\(?[A-Z][a-z]{2}\d{1,5}(?:[A-Z][a-z]{2}|\*|=|fs\S*|del|dup)", 0.95),
    "coding": (r"\bc\.\d+(?:[+\-]\d+)?(?:_\d+(?:[+\-]\d+)?)?(?:[ACGT]>[ACGT]|del[ACGT]*|dup[ACGT]*|ins[ACGT]+)", 0.95),
    "three_letter": (r"\b(?:Ala|Arg|Asn|Asp|Cys|Gln|Glu|Gly|His|Ile|Leu|Lys|Met|Phe|Pro|Ser|Thr|Trp|Tyr|Val)\d{1,5}(?:Ala|Arg|Asn|Asp|Cys|Gln|Glu|Gly|His|Ile|Leu|Lys|Met|Phe|Pro|Ser|Thr|Trp|Tyr|Val|Ter|fs)", 0.85),
    "one_letter": (r"\b[ACDEFGHIKLMNPQRSTVWY]\d{2,4}[ACDEFGHIKLMNPQRSTVWY*X]\b", 0.6),
    "splice": (r"\bIVS\d+[+\-]\d+[ACGT]>[ACGT]", 0.9),
}


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct mentions of changes in each document: kind, raw, normalized, confidence; the surest spelling of each stands."""

    def family(kind: str, pattern: str, confidence: float):
        return F.transform(F.regexp_extract_all(text_col, F.lit(pattern), F.lit(0)), lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("raw"), F.lit(confidence).alias("confidence")))

    each = F.concat(*[family(k, p, c) for k, (p, c) in MENTIONS.items()])
    rows = docs.select(id_col, F.explode(each).alias("m")).select(id_col, "m.*").withColumn("normalized", notation.match_key(F.col("raw")))
    best = F.max_by(F.struct("kind", "raw", "confidence"), F.struct("confidence", "raw")).alias("b")
    return rows.groupBy(id_col, "normalized").agg(best, F.count(F.lit(1)).alias("n")).select(id_col, "normalized", "b.*", "n")


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Paragraphs with their place and character span."""
    parts = F.split(F.col(text_col), r"\n\s*\n", -1)
    return docs.select(id_col, F.posexplode(parts).alias("place", "paragraph"))


def zones(docs: DataFrame, gene: str, id_col: str = "doc_id", text_col: str = "text", top: int = 30, least: float = 0.1) -> DataFrame:
    """Scored paragraphs, those next to each other merged to zones; the best `top` zones of a document by the score of their joint signals, the earlier of equals."""
    p = paragraphs(docs, id_col, text_col)
    n = lambda pattern: F.regexp_count("paragraph", F.lit(pattern))
    signals = {
        "gene": F.col("paragraph").rlike(gene), "variants": n(MENTIONS["one_letter"][0] + "|" + MENTIONS["coding"][0]), "individuals": n(r"(?i)\b(patients?|probands?|carriers?|individuals?)\b"), "keywords": n(r"(?i)\b(mutation|phenotype|cohort|family|penetrance)\w*"),
        "table": F.contains("paragraph", F.lit("|")), "caption": F.col("paragraph").rlike(r"(?i)^\s*table\s"), "supplement": F.col("paragraph").rlike("(?i)supplement"),
    }
    scored = p.select(id_col, "place", F.col("place").alias("last"), *[c.alias(f"_{k}") for k, c in signals.items()])
    scored = scored.withColumn("_score", evidence_score(*[F.col(f"_{k}") for k in signals])).where(F.col("_score") >= least)
    counted = ("variants", "individuals", "keywords")
    joint = [(F.sum if k in counted else F.max)(f"_{k}").alias(f"_{k}") for k in signals]
    merged = coalesce_intervals(scored, [id_col], "place", "last", 1, [*joint, F.max("_score").alias("_score")])
    from pyspark.sql import Window

    whole = F.round(F.least(evidence_score(*[F.col(f"_{k}") for k in signals]), F.lit(1.0)), 2)
    of = Window.partitionBy(id_col)
    ranked = merged.withColumn("_whole", whole).withColumn("best_score", F.max("_score").over(of)).withColumn("_r", F.row_number().over(of.orderBy(F.desc("_whole"), "place")))
    return ranked.where(F.col("_r") <= top).select(id_col, "island", "place", "last", "n", "best_score")


def captions(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Figure and table captions in HTML, each once per page, in order."""
    found = F.regexp_extract_all(html_col, F.lit(r"(?is)<(?:figcaption|caption)[^>]*>(.*?)</(?:figcaption|caption)>"), F.lit(1))
    plain = F.array_distinct(F.transform(found, lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))))
    return pages.select(id_col, F.posexplode(plain).alias("place", "caption"))


def supplement_mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tables, figures and files of a supplement that a text names."""
    pattern = r"(?i)supplement(?:ary|al)?\s+(table|figure|fig\.?|file|data|material)s?\s*([A-Z]?\d+)"
    whole = F.transform(F.regexp_extract_all(text_col, F.lit(pattern), F.lit(0)), lambda m: F.struct(F.lower(F.regexp_extract(m, pattern, 1)).alias("kind"), F.upper(F.regexp_extract(m, pattern, 2)).alias("label")))
    return docs.select(id_col, F.explode(F.array_distinct(whole)).alias("s")).select(id_col, "s.*")
