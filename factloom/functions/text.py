"""Text quality, cleaning, gating and triage as Column functions; all run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases, words and limits of the gates.
JUNK_DOMAINS = ("assays.cancer.gov", "antibodies.cancer.gov", "biocyc.org", "glygen.org", "malacards.org", "lens.org", "clinicaltrials.gov", "medlineplus.gov")
PAPER_WORDS = ("abstract", "introduction", "methods", "results", "discussion", "conclusion", "references", "materials and methods", "patients and methods", "study population")
VARIANT_PATTERNS = (r"(?i)[A-Z]\d{2,4}[A-Z]", r"(?i)p\.[A-Z][a-z]{2}\d+", r"(?i)c\.\d+[ACGT]>[ACGT]", "(?i)mutation", "(?i)variant")
PAYWALL_MARKERS = (
    "purchase this article", "buy this article", "rent this article", "subscribe to access", "get access", "institutional sign in",
    "institutional login", "log in to your personal account", "your access options", "this content requires a subscription", "please sign in",
    "you do not have access", "access through your institution", "no access", "checking your browser before accessing", "verify you are human",
    "ddos protection by cloudflare",
)
HARD_PHRASES = (
    "available to purchase", "you do not currently have access to this content", "log in, subscribe or purchase for full access",
    "get full access to this article", "view all available purchase options and get full access", "checking your browser before accessing",
    "this content requires a subscription",
)
FULLTEXT_MARKERS = (
    "references", "materials and methods", "patients and methods", "study population", "results", "discussion", "supplementary",
    "supporting information", "acknowledgments", "conflicts of interest",
)


def markers(text: Column, phrases: tuple[str, ...]) -> Column:
    """How many of the phrases the text holds."""
    return reduce(lambda a, b: a + b, [F.contains(text, F.lit(p)).cast("int") for p in phrases])


def first_of(text: Column, phrases: tuple[str, ...]) -> Column:
    """The first phrase of the list that the text holds."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(p)), F.lit(p)) for p in phrases])


def keyword_hits(text: Column, words: tuple[str, ...]) -> Column:
    """Number of distinct words of the list that stand in the text as whole words."""
    return F.size(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\b(" + "|".join(words) + r")\b"), F.lit(1))))


def keyword_filter(text: Column, words: tuple[str, ...], least: int = 2) -> Column:
    """(decision, hits, confidence): a missing text passes with confidence 0."""
    hits = keyword_hits(text, words)
    missing = text.isNull() | (F.trim(text) == "")
    return F.struct(
        F.when(missing | (hits >= least), "PASS").otherwise("FAIL").alias("decision"),
        F.when(missing, 0).otherwise(hits).alias("hits"),
        F.when(missing, 0.0).otherwise(F.least(hits / 10, F.lit(1.0))).alias("confidence"),
    )


def text_class(text: Column) -> Column:
    """empty, abstract_only, garbled_xml, full_text, content_no_sections or partial."""
    bare = F.length(F.trim(F.regexp_replace(text, r"<[^>]+>", "")))
    tags = F.regexp_count(text, F.lit(r"<[^>]+>"))
    sections = F.regexp_count(text, F.lit(r"(?i)(introduction|methods|results|discussion|conclusion|background|patients)"))
    size = F.length(text)
    return (
        F.when(size < 200, "empty")
        .when(size < 3000, "abstract_only")
        .when(tags / F.greatest(bare, F.lit(1)) > 0.1, "garbled_xml")
        .when(sections >= 3, "full_text")
        .when(size > 10000, "content_no_sections")
        .otherwise("partial")
    )


# Tag, entity and line patterns that cleaning removes.
_TAGS = (
    (r"(?s)<ce:para[^>]*>", ""), (r"</ce:para>", "\n"), (r"<ce:section[^>]*>", ""), (r"</ce:section>", ""),
    (r"(?s)<ce:section-title[^>]*>(.*?)</ce:section-title>", "## $1"), (r"(?s)<ce:bold>(.*?)</ce:bold>", "**$1**"),
    (r"(?s)<[^>]{1,200}>", ""), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&nbsp;", " "), (r"&#\d+;", ""),
)
_NOISE = (
    r"https?://api\.(elsevier|springer|wiley)\.com/.*", r"doi:.*", r"\d+-s\d+\.\d+-\S+", r"text/plain\s*", r"Copyright ©.*", r"All rights reserved\.?\s*",
    r"Published by .*", r"\[Wiley PDF content for.*\]", r"Received \d+.*Accepted \d+.*", r"Available online.*",
)


def clean(text: Column) -> Column:
    """Tags, entities and noise lines removed, a real reference list cut off, white space runs shortened."""
    for pattern, to in _TAGS:
        text = F.regexp_replace(text, pattern, to)
    noise = r"^\s*(" + "|".join(_NOISE) + ")$"
    text = F.array_join(F.filter(F.split(text, "\n", -1), lambda line: ~line.rlike(noise)), "\n")
    head = r"\n##?\s*(?:References|Bibliography|REFERENCES)\s*\n"
    at = F.length(F.element_at(F.split(text, head, 2), 1))
    after = F.substr(text, at + 1)
    cut = text.rlike(head) & (F.regexp_count(after, F.lit(r"(?m)^\s*\d+[.)]\s+")) > 3)
    text = F.when(cut, F.concat(F.substr(text, F.lit(1), at), F.lit("\n\n[References section removed]\n"))).otherwise(text)
    text = F.regexp_replace(F.regexp_replace(text, r"\n{4,}", "\n\n\n"), r" {3,}", " ")
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def binary_reason(text: Column) -> Column:
    """Why a text looks like binary data; null if it does not."""
    sample = F.substring(text, 1, 1000)
    size = F.greatest(F.length(sample), F.lit(1))
    control = F.length(F.regexp_replace(sample, r"[^\x00-\x08\x0B\x0C\x0E-\x1F]", "")) / size
    high = F.length(F.regexp_replace(sample, r"[\x00-\x7F]", "")) / size
    return (
        F.when(text.startswith("%PDF"), "pdf")
        .when(control > 0.1, "control characters")
        .when(F.contains(sample, F.lit("\x00")), "null bytes")
        .when(high > 0.3, "high bytes")
    )


def quality_reason(text: Column, url: Column | None = None) -> Column:
    """Why a text is no paper ("ok" if it may be one): binary, junk domain, short, or without structure and variants."""
    low = F.lower(text)
    domain = F.lower(F.coalesce(F.parse_url(url, F.lit("HOST")), F.lit(""))) if url is not None else F.lit("")
    found = reduce(lambda a, b: a + b, [text.rlike(p).cast("int") for p in VARIANT_PATTERNS])
    # The first that is not null: each test runs once, and only if those before it say nothing.
    return F.coalesce(
        F.when(text.isNull() | (text == ""), "empty"),
        F.concat(F.lit("binary: "), binary_reason(text)),
        F.when(markers(domain, JUNK_DOMAINS) > 0, "junk domain"),
        F.when(F.length(text) < 1500, "too short"),
        F.when((markers(low, PAPER_WORDS) < 2) & (found < 2), "no structure"),
        F.lit("ok"),
    )


def lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda x: F.trim(x))


def cells(row: Column) -> Column:
    """The cells of a pipe-table row, trimmed."""
    return F.transform(F.split(F.regexp_replace(row, r"^\|+|\|+$", ""), r"\|", -1), lambda c: F.trim(c))


def body_chars(text: Column, least: int = 80) -> Column:
    """Characters of long paragraph lines and of table rows with two or more filled cells."""

    def own(line: Column) -> Column:
        filled = F.filter(cells(line), lambda c: (c != "") & ~c.rlike(r"^-{3,}$"))
        table = F.when(F.size(filled) >= 2, F.aggregate(filled, F.lit(0), lambda a, c: a + F.length(c))).otherwise(0)
        skip = (line == "") | line.rlike(r"^(#|>|- |\* |\+ )")
        return F.when(skip, 0).when(line.startswith("|"), table).when(F.length(line) >= least, F.length(line)).otherwise(0)

    return F.aggregate(F.transform(lines(text), own), F.lit(0), lambda a, n: a + n)


def body_lines(text: Column) -> Column:
    return F.size(F.filter(lines(text), lambda x: (x != "") & ~x.rlike("^[#>]")))


def worst_repeat(text: Column, least: int = 20) -> Column:
    """How often the most repeated line of `least` or more characters stands; table furniture does not count."""
    useful = F.filter(
        lines(text),
        lambda s: (F.length(s) >= least) & ~s.rlike(r"^[\s|:\-]+$") & (~s.startswith("|") | (F.size(F.filter(cells(s), lambda c: ~c.isin("", "---", "-"))) >= 2)),
    )
    ordered = F.array_sort(useful)
    # the longest run of equal lines in order, kept as (line, run, best)
    start = F.struct(F.lit("").alias("line"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(state: Column, line: Column) -> Column:
        run = F.when(state["line"] == line, state["run"] + 1).otherwise(1)
        return F.struct(line.alias("line"), run.alias("run"), F.greatest(state["best"], run).alias("best"))

    return F.aggregate(ordered, start, step, lambda s: s["best"])


def article_reason(text: Column, least_chars: int = 5000, least_words: int = 800, least_body: int = 3000) -> Column:
    """Why a rendered page is no full article; "ok" if it is."""
    body = F.trim(text)
    low, size = F.lower(body), F.length(body)
    chars, pay, full = body_chars(body), markers(low, PAYWALL_MARKERS), markers(low, FULLTEXT_MARKERS)
    words = F.regexp_count(body, F.lit(r"\b\w+\b"))
    return (
        F.when(text.isNull() | (text == ""), "empty")
        .when(first_of(low, HARD_PHRASES).isNotNull(), "paywall phrase")
        .when(F.contains(low, F.lit("checking your browser")) & (size < 20000), "interstitial")
        .when(F.contains(low, F.lit("verify you are human")) & (size < 20000), "captcha")
        .when(chars < least_body, "thin body")
        .when((chars < 10000) & (worst_repeat(body) >= 5), "padding")
        .when((pay >= 2) & (full < 3), "paywall markers")
        .when(size < max(2000, least_chars // 2), "short")
        .when((size < least_chars) & (full < 4), "short")
        .when((words < least_words) & (full < 4), "few words")
        .otherwise("ok")
    )


def better_text(primary: Column, other: Column, share: float = 0.8) -> Column:
    """The other text where the first is missing or shorter than `share` of it."""
    return F.when(primary.isNull() | (F.length(primary) < share * F.length(other)), other).otherwise(primary)


def challenge_page(html: Column) -> Column:
    low = F.lower(html)
    return F.contains(low, F.lit("checking your browser")) | F.contains(low, F.lit("cf-browser-verification")) | (F.contains(low, F.lit("just a moment")) & F.contains(low, F.lit("cloudflare")))


def embargo_open(published: Column, months: Column, today: Column) -> Column:
    """Without an embargo open; without a date closed; else by days over 30.44, not by calendar months."""
    return F.when(months.isNull() | (months <= 0), True).when(published.isNull(), False).otherwise(F.datediff(today, published) / 30.44 >= months)


def head_and_tail(text: Column, size: int) -> Column:
    """Two thirds of the limit from the start and the rest from the end of a longer text."""
    head = size * 2 // 3
    return F.when(F.length(text) <= size, text).otherwise(F.concat(F.substring(text, 1, head), F.lit("\n"), F.right(text, F.lit(size - head))))


def co_occurrence(text: Column, first: str, second: str, cap: int) -> Column:
    """Lines that match both patterns, up to a cap."""
    return F.least(F.size(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(first) & x.rlike(second))), F.lit(cap))


def capped_count(text: Column, pattern: str, cap: int) -> Column:
    return F.least(F.regexp_count(text, F.lit(pattern)), F.lit(cap))


# Words that tell somatic from germline.
SOMATIC = ("somatic", "tumor", "tumour", "cancer cell line", "loss of heterozygosity")
GERMLINE = ("germline", "inherited", "hereditary", "segregat", "proband", "de novo")


def origin_class(text: Column) -> Column:
    low = F.lower(text)
    s, g = markers(low, SOMATIC) > 0, markers(low, GERMLINE) > 0
    return F.when(s & g, "ambiguous").when(s, "somatic").when(g, "germline").otherwise("unknown")


def evidence_score(gene: Column, variants: Column, individuals: Column, keywords: Column, table: Column, caption: Column, supplement: Column) -> Column:
    """The score of a zone of text from its signals."""
    yes = lambda c, w: F.when(c, w).otherwise(0.0)
    return yes(gene, 0.3) + F.least(variants * 0.05, F.lit(0.25)) + F.least(individuals * 0.05, F.lit(0.25)) + F.least(keywords * 0.01, F.lit(0.1)) + yes(table, 0.1) + yes(caption, 0.1) + yes(supplement, 0.1)
