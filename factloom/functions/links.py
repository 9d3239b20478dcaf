"""Identifiers, links and locators in text and HTML as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOI = r"10\.\d{4,9}/[^\s\"'<>]+"


def all_of(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches in order of first occurrence, each once."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))


def dois(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(DOI), F.lit(0)), lambda d: F.regexp_replace(d, r"[.,;:)\]]+$", "")))


def hrefs(html: Column) -> Column:
    return all_of(html, r'(?i)href\s*=\s*"([^"]*)"', 1)


def paper_ids(text: Column) -> Column:
    """Ids after "PMID:" or in links, in order, each once."""
    return all_of(text, r"(?i)(?:pmid:?\s*|pubmed[^\s\"'<>]*?/)(\d{1,8})", 1)


def normal_url(url: Column) -> Column:
    """Without fragment and trailing slash."""
    return F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "/+$", "")


def encode_segment(text: Column) -> Column:
    """Percent-encoding of everything but unreserved characters."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def encode_doi(doi: Column) -> Column:
    return F.replace(F.replace(encode_segment(doi), F.lit("%2F"), F.lit("/")), F.lit("%3A"), F.lit(":"))


def image_path(path: Column) -> Column:
    return F.lower(path).rlike(r"\.(png|jpe?g|gif|tiff?|bmp|webp)$")


def data_url(content: Column, mime: Column) -> Column:
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.replace(F.base64(content), F.lit("\r\n"), F.lit("")))


def locator(text: Column) -> Column:
    """The first table, row, paragraph and section that a place in a paper names."""
    part = lambda p: F.nullif(F.regexp_extract(text, p, 1), F.lit(""))
    return F.struct(
        part(r"(?i)\btable\s+([A-Z]?\d+[A-Za-z]?)").alias("table"),
        part(r"(?i)\brow\s+(\d+)").alias("row"),
        part(r"(?i)\bparagraph\s+(\d+)").alias("paragraph"),
        part(r"(?i)\bsection\s+([\w.]+)").alias("section"),
    )


def country(affiliation: Column, countries: tuple[str, ...]) -> Column:
    """The country among the last three comma parts, from the end; else anywhere in the text."""
    parts = F.reverse(F.transform(F.split(affiliation, ","), lambda p: F.lower(F.trim(F.regexp_replace(p, r"[.\s]+$", "")))))
    known = F.array(*[F.lit(c.lower()) for c in countries])
    near = F.filter(F.slice(parts, 1, 3), lambda p: F.array_contains(known, p))
    anywhere = F.filter(known, lambda c: F.contains(F.lower(affiliation), c))
    return F.coalesce(F.get(near, F.lit(0)), F.get(anywhere, F.lit(0)))


def percentage_quoted(quote: Column, expected: Column, within: float = 0.05) -> Column:
    """Whether some percentage in the quote is the expected one."""
    said = F.regexp_extract_all(quote, F.lit(r"(\d+(?:\.\d+)?)\s*%"), F.lit(1))
    return F.exists(said, lambda x: F.abs(x.cast("double") - expected) <= within)


def verbatim(quote: Column, source: Column) -> Column:
    """Whether a quote stands in its source, white space and case aside."""
    fold = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    return F.coalesce((fold(quote) != "") & F.contains(fold(source), fold(quote)), F.lit(False))


# Source layers in their order of markers.
LAYERS = ("llm_text", "llm_table", "regex_text", "regex_table", "clinvar", "pubtator", "figure", "mixed")


def layer_primary(layer: Column) -> Column:
    first = F.lower(F.trim(F.element_at(F.split(layer, ","), 1)))
    return F.when(first.isin(*LAYERS), first)


def layer_union(*layers: Column) -> Column:
    """An ordered set of layers from comma lists."""
    parts = F.flatten(F.array(*[F.split(F.coalesce(x, F.lit("")), r"\s*,\s*") for x in layers]))
    return F.array_distinct(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != ""))
