"""Texts prepared for reading, what to look for in them, and what was found: abstracts, windows, hints, attribution, census, cards, stages."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import links
from factloom.functions import notation as spelled
from factloom.functions import text as texts
from factloom.operators.documents import MENTIONS

MENTION = "|".join(pattern for pattern, _ in MENTIONS.values())


def inject_abstract(docs: DataFrame, abstracts: DataFrame, key: str, text_col: str = "text", abstract_col: str = "abstract") -> DataFrame:
    """Texts headed by their abstract, unless its first 200 characters stand in their first 10,000 (case, line ends and double spaces aside)."""
    flat = lambda c: F.replace(F.replace(F.lower(c), F.lit("\n"), F.lit(" ")), F.lit("  "), F.lit(" "))
    said = F.trim(abstract_col)
    there = F.contains(flat(F.left(text_col, F.lit(10_000))), flat(F.left(said, F.lit(200))))
    headed = F.concat(F.lit("## PUBMED ABSTRACT (Authoritative Source)\n\n"), said, F.lit("\n\n---\n\n## FULL TEXT CONTENT\n\n"), F.col(text_col))
    joined = docs.join(abstracts.select(key, abstract_col), key, "left")
    return joined.withColumn(text_col, F.when(F.coalesce((said != "") & ~there, F.lit(False)), headed).otherwise(F.col(text_col))).drop(abstract_col)


def scout_source(raw: Column, cleaned: Column, above: int) -> Column:
    """The raw text while it is small; else the cleaned one if there is any; else the raw one."""
    return F.when(F.length(raw) <= above, raw).when(F.trim(cleaned) != "", cleaned).otherwise(raw)


MARK = "\n\n[TRUNCATED FOR PROMPT - non-adjacent segments preserved to keep tables]\n\n"
MIDDLE, TRAILING = "### MIDDLE SEGMENT (around tables/supplements) ###\n", "### TRAILING SEGMENT ###\n"


def three_parts(text: Column, size: int) -> Column:
    """Head, middle and tail of a longer text, in thirds of the limit; the middle lies about the last mention of a table or supplement."""
    room = size - 2 * len(MARK) - len(MIDDLE) - len(TRAILING)
    room = size if room < 0 else room
    part, tail = room // 3, room - 2 * (room // 3)
    last = lambda word: F.length(text) - F.instr(F.reverse(F.lower(text)), word[::-1]) - len(word) + 1
    at = F.greatest(*[F.when(F.contains(F.lower(text), F.lit(w)), last(w)) for w in ("table 2", "table", "supplement")])
    start = F.greatest(F.coalesce(at, F.floor(F.length(text) / 2)).cast("int") - part // 2, F.lit(0))
    cut = F.concat(F.left(text, F.lit(part)), F.lit(MARK + MIDDLE), F.substr(text, start + 1, F.lit(part)), F.lit(MARK + TRAILING), F.right(text, F.lit(tail)))
    return F.when(F.length(text) <= size, text).otherwise(F.left(cut, F.lit(size)))


def gene_windows(docs: DataFrame, gene: str, around: int, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The parts of each text within `around` characters of a mention of the gene, overlapping ones merged, in order and up to `most` characters; documents without a mention have no row.

    `gene` is a pattern of plain letters and digits, matched whatever its case.
    Windows are merged by one pass over a document's hits in order.
    """
    word = re.escape(gene.lower())
    parts = F.split(F.lower(text_col), word, -1)
    sizes = F.transform(parts, lambda p: F.length(p))
    empty = F.array().cast("array<int>")
    first = F.struct(F.lit(0).alias("at"), empty.alias("hits"))
    hits = F.aggregate(F.slice(sizes, F.lit(1), F.greatest(F.size(sizes) - 1, F.lit(0))), first, lambda a, n: F.struct((a["at"] + n + len(gene)).alias("at"), F.concat(a["hits"], F.array(a["at"] + n)).alias("hits")), lambda a: a["hits"])
    span = F.array().cast("array<struct<s:int,e:int>>")

    def merge(spans: Column, at: Column) -> Column:
        own = F.struct(F.greatest(at - around, F.lit(0)).alias("s"), F.least(at + len(gene) + around, F.length(text_col)).alias("e"))
        last = F.try_element_at(spans, F.lit(-1))
        joined = F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(F.struct(last["s"].alias("s"), own["e"].alias("e"))))
        return F.when((F.size(spans) > 0) & (last["e"] >= own["s"]), joined).otherwise(F.concat(spans, F.array(own)))

    spans = docs.where(F.contains(F.lower(text_col), F.lit(gene.lower()))).select(id_col, text_col, F.aggregate(hits, span, merge).alias("_spans"))
    said = F.array_join(F.transform("_spans", lambda x: F.substr(F.col(text_col), x["s"] + 1, x["e"] - x["s"])), "\n[...]\n")
    return spans.select(id_col, F.size("_spans").alias("windows"), F.left(said, F.lit(most)).alias("focused"))


def hints(mentions: DataFrame, id_col: str = "doc_id", top: int = 50) -> DataFrame:
    """The surest distinct changes of a document as a list for a prompt: name, kind, HIGH from 0.8, MED from 0.5, else LOW."""
    label = F.when(F.col("confidence") >= 0.8, "HIGH").when(F.col("confidence") >= 0.5, "MED").otherwise("LOW")
    line = F.concat("normalized", F.lit(" ["), "kind", F.lit("] ("), label, F.lit(")"))
    best = mentions.groupBy(id_col, "normalized").agg(F.max_by(F.struct("confidence", line.alias("line")), "confidence").alias("b"))
    ordered = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("b.confidence")).alias("c"), "normalized", F.col("b.line").alias("line")))), 1, top)
    return best.groupBy(id_col).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("hints"))


# What a line says that speaks against a mention.
NEGATIVE = r"(?i)\b(not (?:found|detected|observed|present|identified)|absent|no (?:mutation|variant|carrier)s?|excluded|negative for|previously (?:reported|described)|et al\.?|polymorphism|reviewed in)\b"
POSITIVE = r"(?i)\b(identified|detected|found|carried|carriers?|harbou?r(?:ed|ing|s)|segregat\w+|proband|patient|heterozyg\w+|homozyg\w+)\b"


def scan_additions(docs: DataFrame, known: DataFrame, gene: str, other_genes: tuple[str, ...], least: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Changes that a text mentions and an extraction does not have: id, variant, confidence, line.

    Fail-closed: a mention counts only on a line of prose that says something
    positive, nothing negative, does not cite, and names no other gene; the text
    must name the gene. `known` has id and variant (match keys).
    """
    others = r"(?i)\b(" + "|".join(map(re.escape, other_genes)) + r")\b" if other_genes else "(?!)"
    lines = docs.where(F.col(text_col).rlike(rf"(?i)\b{re.escape(gene)}\b")).select(id_col, F.posexplode(F.split(text_col, "\n", -1)).alias("line", "_s"))
    fair = lines.where(~F.contains("_s", F.lit("|")) & ~F.col("_s").rlike(r"\t|\S\s{3,}\S") & F.col("_s").rlike(POSITIVE) & ~F.col("_s").rlike(NEGATIVE) & ~F.col("_s").rlike(r"\[\d+(?:[,–-]\d+)*\]") & ~F.col("_s").rlike(others))
    said = F.explode(F.concat(*[_found(p, c) for p, c in MENTIONS.values()]))
    rows = fair.select(id_col, "line", said.alias("m")).select(id_col, "line", spelled.match_key(F.col("m.raw")).alias("variant"), F.col("m.confidence").alias("confidence")).where(F.col("confidence") >= least)
    best = rows.groupBy(id_col, "variant").agg(F.max("confidence").alias("confidence"), F.min("line").alias("line"))
    return best.join(known.select(id_col, "variant").distinct(), [id_col, "variant"], "left_anti")


def _found(pattern: str, confidence: float) -> Column:
    return F.transform(F.regexp_extract_all("_s", F.lit(pattern), F.lit(0)), lambda m: F.struct(m.alias("raw"), F.lit(confidence).alias("confidence")))


def gene_attribution(rows: DataFrame, genes: tuple[str, ...], id_col: str, line_col: str) -> DataFrame:
    """Per document and change the genes named on its lines or table rows, sorted; changes on lines without a gene have none."""
    word = r"\b(" + "|".join(map(re.escape, genes)) + r")\b"
    named = F.regexp_extract_all(line_col, F.lit(word), F.lit(1))
    said = rows.select(id_col, named.alias("_genes"), F.explode(F.array_distinct(F.regexp_extract_all(line_col, F.lit(MENTION), F.lit(0)))).alias("_raw"))
    return said.groupBy(id_col, spelled.match_key(F.col("_raw")).alias("variant")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("_genes")))).alias("genes"))


def census(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What a text holds at a glance: lines with a change, distinct changes, the largest number of carriers or patients named, and the most of rows and changes as an estimate."""
    lines = F.split(F.coalesce(text_col, F.lit("")), "\n", -1)
    rows = F.size(F.filter(lines, lambda x: x.rlike(MENTION)))
    variants = F.size(F.array_distinct(F.regexp_extract_all(text_col, F.lit(MENTION), F.lit(0))))
    people = F.array_max(F.transform(F.regexp_extract_all(text_col, F.lit(r"(?i)\b(\d{1,5})\s+(?:carriers|patients|probands|individuals|subjects)\b"), F.lit(1)), lambda n: n.cast("int")))
    return docs.select(id_col, rows.alias("rows"), F.greatest(variants, F.lit(0)).alias("variants"), people.alias("carriers"), F.greatest(rows, variants, F.lit(0)).alias("estimate"))


def supplement_gap(text: Column, downloaded: Column, extracted: Column) -> Column:
    """(gap, expected, mentioned): fewer files than supplementary tables named, or under half of the changes the text speaks of."""
    expected = F.size(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)(?:supplementa(?:ry|l)\s+table|table\s+s)\s*s?(\d+)"), F.lit(1)), lambda n: n)))
    mentioned = F.array_max(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)\b(\d{1,5})\s+(?:\w+\s+){0,2}(?:variants|mutations)\b"), F.lit(1)), lambda n: n.cast("int")))
    gap = F.coalesce((expected > 0) & (downloaded < expected), F.lit(False)) | F.coalesce(extracted < mentioned * 0.5, F.lit(False))
    return F.struct(gap.alias("gap"), F.greatest(expected, F.lit(0)).alias("expected"), mentioned.alias("mentioned"))


def claim_card(text: Column, variant: Column, size: int = 400) -> Column:
    """The part of a text about the first mention of a variant; null without one."""
    at = F.position(F.lower(variant), F.lower(text))
    return F.when((variant != "") & (at > 0), F.trim(F.substr(text, F.greatest(at - size // 2, F.lit(1)), F.lit(size))))


# What stands beside a number that is no count of persons, and what names its role.
NOT_A_COUNT = r"(?i)\b(?:population|total of|screened|cohort of|controls? of|alleles?|chromosomes|years?|months?|codon|exon|residue|position|amino acids?)\b|%|\bms\b"
ROLE_WORDS = {"carriers": r"(?i)carriers?|heterozyg|harbou?r|patients?|probands?|individuals?", "affected": r"(?i)affected|symptomatic|patients?|cases?|diagnos", "unaffected": r"(?i)unaffected|asymptomatic|healthy|controls?"}


def quote_supports(quote: Column, value: Column, field: str, near: int = 35, wide: int = 90) -> Column:
    """Whether a quote states the value as a count of the field: as a number by itself, away from what is no count, not as "of N" or "/N", with a word of the role near by."""
    number = value.cast("string")
    at = F.regexp_instr(quote, F.concat(F.lit(r"(?<![\w.])"), number, F.lit(r"(?![\w]|\.\d)")))
    about = lambda n: F.substr(quote, F.greatest(at - n, F.lit(1)), F.length(number) + F.least(at - 1, F.lit(n)) + n)
    denominator = F.substr(quote, F.greatest(at - 8, F.lit(1)), F.least(at - 1, F.lit(8))).rlike(r"(?i)(?:\bof|/|among)\s*$")
    return F.coalesce((at > 0) & ~about(near).rlike(NOT_A_COUNT) & ~denominator & about(wide).rlike(ROLE_WORDS[field]), F.lit(False))


def tiered(papers: DataFrame, key: str, words: tuple[str, ...], second: Callable[[Column], Column], done: DataFrame | None = None, text_col: str = "text", least: int = 2) -> DataFrame:
    """Papers not yet done with the stage that decided, its decision and reason: words first, and only what passes is shown to the second tier.

    `second` gives PASS or FAIL of a text Column; it is not called for papers that
    the first tier refused, so a costly classifier sees few.
    """
    todo = papers if done is None else papers.join(done.select(key).distinct(), key, "left_anti")
    first = todo.withColumn("_t1", texts.keyword_filter(F.col(text_col), words, least))
    refused = first.where("_t1.decision = 'FAIL'").select(key, F.lit("tier1").alias("stage"), F.lit("FAIL").alias("decision"), F.concat(F.lit("keywords: "), F.col("_t1.hits").cast("string")).alias("reason"))
    asked = first.where("_t1.decision = 'PASS'").select(key, F.lit("tier2").alias("stage"), second(F.col(text_col)).alias("decision"))
    return refused.unionByName(asked.withColumn("reason", F.when(F.col("decision") == "PASS", "relevant").otherwise("not relevant")))


# What a caption says of a table of other people's work.
SECONDARY = r"(?i)\b(?:previously (?:reported|published|described)|literature review|review of|meta-?analys\w+|reported in the literature|published (?:cases|variants|mutations))\b"


def current_study(rows: DataFrame, gene: str, genes: tuple[str, ...], caption: str, source: str, row_gene: str) -> DataFrame:
    """Rows with why they are skipped: secondary_study, wrong_gene, gene_ambiguous; null where they are taken."""
    word = r"\b(" + "|".join(map(re.escape, genes)) + r")\b"
    named = F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", caption, source), F.lit(word), F.lit(1)))
    reason = F.when(F.coalesce(F.col(caption).rlike(SECONDARY), F.lit(False)), "secondary_study").when(F.coalesce(F.upper(F.trim(row_gene)) != gene.upper(), F.lit(False)) & (F.trim(row_gene) != ""), "wrong_gene")
    unsure = (F.coalesce(F.trim(row_gene), F.lit("")) == "") & (F.size(named) > 1)
    return rows.withColumn("skipped", reason.when(unsure, "gene_ambiguous"))


def supplement_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Anchors of a page that go to a document file, each address once: place, href, label."""
    from factloom.functions.gates import supplement_file

    anchor = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    whole = F.regexp_extract_all(html_col, F.lit(anchor), F.lit(0))
    each = pages.select(id_col, F.posexplode(whole).alias("place", "_a")).select(id_col, "place", F.regexp_extract("_a", anchor, 1).alias("href"), F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("_a", anchor, 2), "<[^>]+>", " "), r"\s+", " ")).alias("label"))
    good = each.where(supplement_file(F.col("href"))).withColumn("_k", links.normal_url(F.col("href")))
    return good.groupBy(id_col, "_k").agg(F.min_by(F.struct("place", "href", "label"), "place").alias("b")).select(id_col, "b.*")


def rendered_captions(captions: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The captions of a page as one block of text, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("place", "caption")))
    return captions.groupBy(id_col).agg(F.concat(F.lit("## Captions\n\n"), F.array_join(F.transform(ordered, lambda x: F.concat(F.lit("- "), x["caption"])), "\n")).alias("block"))
