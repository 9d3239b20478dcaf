"""Mentions of changes in texts, with their spans: every family of notations is searched, and the best set of spans that do not overlap stands.

A text is read once in an Arrow batch and gives (start, end) in code points.
What a mention means, and whether it is one, is then told by Columns.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import gates, notation

_THREE = "(?:" + "|".join([*notation.RESIDUES, "Ter"]) + ")"
_ONE = "[ACDEFGHIKLMNPQRSTVWY]"
_ANY = f"(?:{_THREE}|{_ONE})"
_SHIFT = r"fs(?:(?:[X*]|Ter)?\d*)"
_BASES = "[ACGT]"
_PLACE = r"\d+(?:[+-]\d+)?"
_END = r"(?![A-Za-z0-9_])"
_START = r"(?<![A-Za-z0-9_])"

#: Families of notations: name, kind of notation, confidence in hundredths (fixed values), pattern. The span is that of group v, or of the whole.
FAMILIES: tuple[tuple[str, str, int, str], ...] = (
    ("protein_predicted", "protein", 95, rf"{_START}p\.\((?:{_THREE})\d+(?:{_THREE}|{_SHIFT}|del|dup|ins|[*=])(?:\*?\d*)\)"),
    ("protein_full", "protein", 95, rf"{_START}p\.{_THREE}\d+(?:{_THREE}?{_SHIFT}|{_THREE}|del|dup|ins|\*)(?:\*?\d*){_END}"),
    ("protein_short", "protein", 90, rf"{_START}p\.{_ONE}\d+(?:{_ONE}?{_SHIFT}|{_ONE}|X|del|dup|ins|\*){_END}"),
    ("three_letter", "protein", 85, rf"{_START}{_THREE}\d{{2,4}}(?:{_THREE}|del|dup|ins|\*)(?:[X*]?\d*){_END}"),
    ("one_letter", "protein", 70, rf"{_START}{_ONE}\d{{2,4}}(?:{_ONE}|X|\*){_END}"),
    ("frameshift", "protein", 90, rf"{_START}(?:p\.)?{_ANY}\d{{2,4}}(?:{_ANY})?{_SHIFT}{_END}"),
    ("nonsense", "protein", 90, rf"{_START}(?:p\.)?{_ANY}\d{{2,4}}(?:\*|X|Ter|stop|sp){_END}"),
    ("range_deletion", "protein", 90, rf"{_START}(?:p\.)?{_ANY}\d{{2,4}}[_-]{_ANY}\d{{2,4}}del{_ANY}*{_END}"),
    ("deletion", "protein", 90, rf"{_START}(?:p\.)?(?:{_ANY}\d{{2,4}}del|del\s?{_ONE}?\d{{2,4}}(?:[_-]{_ONE}?\d{{2,4}})?){_END}"),
    ("duplication", "protein", 90, rf"{_START}(?:p\.)?{_ANY}\d{{2,4}}(?:_{_ANY}\d{{2,4}})?dup{_END}"),
    ("insertion", "protein", 85, rf"{_START}(?:p\.)?{_ANY}\d{{2,4}}(?:_{_ANY}\d{{2,4}})?ins{_ANY}*{_END}"),
    ("coding", "cdna", 95, rf"{_START}c\.{_PLACE}{_BASES}>{_BASES}{_END}"),
    ("coding_bare", "cdna", 90, rf"{_START}\d{{3,5}}{_BASES}>{_BASES}{_END}"),
    ("coding_indel", "cdna", 92, rf"{_START}c\.{_PLACE}(?:_{_PLACE})?(?:del|dup|ins){_BASES}*{_END}"),
    ("coding_delins", "cdna", 92, rf"{_START}c\.{_PLACE}(?:_{_PLACE})?del{_BASES}*ins{_BASES}+{_END}"),
    ("splice", "splice", 95, rf"{_START}IVS\d+[+-]\d+{_BASES}>{_BASES}{_END}"),
    ("splice_indel", "splice", 90, rf"{_START}IVS\d+[+-]\d+(?:del|dup|ins){_BASES}*{_END}"),
    ("old_indel", "legacy", 75, rf"(?<![A-Za-z0-9_.])\d{{3,5}}(?:del|dup|ins)(?:(?-i:{_BASES}{{1,20}})|\d{{1,3}}){_END}"),
    ("exon_event", "structural", 85, rf"{_START}(?:del(?:etion)?|dup(?:lication)?)\s*(?:of\s+)?exons?\s*\d{{1,3}}(?:\s*(?:[-–—]|to)\s*\d{{1,3}})?{_END}"),
    ("whole_gene", "structural", 80, rf"{_START}(?:(?:whole[\s-]gene|entire\s+gene)\s+del(?:etion)?|del(?:etion)?\s+of\s+the\s+(?:whole|entire)\s+gene){_END}"),
)

# What makes a bare one-letter change surer, and what a clause says for or against an event told in words.
_SAID = ("mutation", "variant", "substitution", "carrier")
_AROUND, _SURER = 50, 85
_AGAINST_BEFORE = re.compile(r"(?i)\b(?:no|not|without|negative\s+for|absence|absent|exclud(?:e[ds]?|ing)|ruled?s?\s+out)\b[^.;:!?]{0,40}$")
_AGAINST_BEHIND = re.compile(r"(?i)^[^.;:!?\n]{0,60}\b(?:(?:not|never)\s+(?:be(?:en)?\s+)?(?:detected|identified|found|observed|seen|confirmed|demonstrated|present)|(?:was|were|is|are)\s+(?:absent|excluded|ruled\s+out))\b")
_FOUND = re.compile(r"(?i)\b(?:identif(?:y|ied)|detect(?:ed)?|found|observed?|report(?:ed)?|confirm(?:ed)?|revealed|showed|demonstrated?|harbou?r(?:s|ed)|carrie[ds]|segregate[ds]|present)\b")
_ARROWS = str.maketrans({"→": ">", "⇒": ">", "←": "<"})


@lru_cache(16)
def _patterns(prefixes: tuple[str, ...]) -> list[tuple[int, int, re.Pattern]]:
    made = [(k, confidence, re.compile(p, re.IGNORECASE)) for k, (_, _, confidence, p) in enumerate(FAMILIES)]
    if prefixes:  # a change written onto the name of its gene
        names = "|".join(sorted(map(re.escape, prefixes), key=len, reverse=True))
        made.append((len(FAMILIES), 90, re.compile(rf"{_START}(?:{names})[-_]?(?P<v>{_ONE}\d{{2,4}}(?:{_ONE}?{_SHIFT}|{_ONE}|X|del|dup|ins|\*)){_END}", re.IGNORECASE)))
    return made


def _event_stands(text: str, start: int, end: int) -> bool:
    """An event in words counts where its sentence says that it was found, and its clause does not say that it was not."""
    left = max(text.rfind(c, max(0, start - 400), start) for c in ".;!?\n") + 1
    stops = [x for x in (text.find(c, end, end + 400) for c in ".;!?\n") if x >= 0]
    sentence = text[left : min(stops, default=min(len(text), end + 400))]
    return bool(_FOUND.search(sentence)) and not _AGAINST_BEFORE.search(text[max(left, start - 80) : start]) and not _AGAINST_BEHIND.search(text[end : end + 120])


def candidates(text: str, prefixes: tuple[str, ...] = ()) -> list[tuple[int, int, int, int]]:
    """(start, end, family, confidence) of all hits of all families; hits of one family do not overlap."""
    text, out = text.translate(_ARROWS), []
    for k, confidence, pattern in _patterns(prefixes):
        group = "v" if k == len(FAMILIES) else 0
        kind = FAMILIES[k][1] if k < len(FAMILIES) else "protein"
        for m in pattern.finditer(text):
            start, end = m.span(group)
            sure = confidence
            if k < len(FAMILIES) and FAMILIES[k][0] == "one_letter":
                near = text[max(0, start - _AROUND) : end + _AROUND].lower()
                sure = _SURER if any(w in near for w in _SAID) else confidence
            if kind != "structural" or _event_stands(text, start, end):
                out.append((start, end, k, sure))
    return out


def best_spans(found: Sequence[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The spans without overlap whose lengths times confidences sum to the most; of equal sums that with fewer spans, then the surer and earlier families.

    Weighted interval scheduling: spans by their end, each with the last that
    ends before it starts, so it takes n log n steps for n spans.
    """
    spans = sorted(set(found), key=lambda s: (s[1], s[0], -s[3], s[2]))
    ends = [s[1] for s in spans]
    best: list[tuple[tuple[int, int, int], int, int]] = [((0, 0, 0), -1, -1)]  # (sum, -spans, -families), span taken, place before it
    for i, (start, end, family, sure) in enumerate(spans):
        before = bisect_right(ends, start, 0, i)
        weight, number, families = best[before][0]
        taken = (weight + (end - start) * sure, number - 1, families - family)
        best.append((taken, i, before) if taken > best[i][0] else (best[i][0], -1, i))
    out, at = [], len(spans)
    while at:
        _, i, before = best[at]
        if i >= 0:
            out.append(spans[i])
        at = before
    return out[::-1]


def scan(docs: DataFrame, prefixes: Sequence[str] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per mention: id, start, end (code points, end exclusive), raw, family, notation, confidence.

    `prefixes` are names onto which a change may be written (HERGG604S). Arrows
    are read as > and <. Null and empty texts have no mentions; rows that share
    an id are read each; other columns are ignored.
    """
    names = [f[0] for f in FAMILIES] + ["joined_name"]
    kinds = [f[1] for f in FAMILIES] + ["protein"]
    own = tuple(prefixes)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            for i, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                for start, end, family, sure in best_spans(candidates(text, own)):
                    for out, x in zip(rows, (i, start, end, text[start:end].translate(_ARROWS), names[family], kinds[family], sure / 100), strict=True):
                        out.append(x)
            types = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[0], pa.int64())), *(pa.array(r, t) for r, t in zip(rows[1:], types, strict=True))], names=[id_col, "start", "end", "raw", "family", "notation", "confidence"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).where(F.col(text_col).rlike(r"\d|(?i)gene")).mapInArrow(read, f"{id_col} {kind}, start int, `end` int, raw string, family string, notation string, confidence double")


# Tokens that look like a change and are none (references, temperatures, amounts, doses, cell lines, magnifications).
FALSE_TOKENS = r"^(?:[STFR]\d|[A-Z]\d{1,2}|\d+\s*°?[CF]|IC\d+|EC\d+|LD\d+|K\d+|\d+[xX])$|^(?:(?i:Table\s*\d|Fig)|\d+\s*[mkμn]?[gGlLmM]|HEK\d+|CHO\s)"


def described(mentions: DataFrame) -> DataFrame:
    """Mentions with normalized, variant_type and position."""
    plain = F.regexp_replace("raw", r"[()]", "")
    protein = F.coalesce(notation.short_protein(plain), notation.canonical(plain), F.upper(plain))
    coding = F.regexp_replace(F.regexp_replace(plain, r"^(?i)(?:c\.)?(?=\d)", "c."), r"(?i)[acgt]+(?=>|$)|>[acgt]", "$0")
    bases = F.concat(F.regexp_extract(coding, r"^(c\.[\d+_\-]*)", 1), F.regexp_replace(F.upper(F.regexp_replace(coding, r"^c\.[\d+_\-]*", "")), "(DEL|DUP|INS)", "$1"))
    lower = F.replace(F.replace(F.replace(bases, F.lit("DEL"), F.lit("del")), F.lit("DUP"), F.lit("dup")), F.lit("INS"), F.lit("ins"))
    normal = F.when(F.col("notation") == "protein", protein).when(F.col("notation") == "cdna", lower).when(F.col("notation") == "legacy", plain).otherwise(notation.match_key(plain))
    kind = F.when(F.col("notation") == "splice", "splice").when(F.col("notation") == "structural", F.when(F.lower("raw").startswith("dup"), "duplication").otherwise("deletion"))
    coded = F.when(F.col("notation").isin("cdna", "legacy") & F.contains(F.lower("raw"), F.lit("ins")) & F.contains(F.lower("raw"), F.lit("del")), "delins").when(F.contains("raw", F.lit(">")), F.when(F.col("raw").rlike(r"\d[+-]\d"), "splice").otherwise("substitution"))
    named = mentions.withColumn("normalized", normal)
    return named.withColumn("variant_type", F.coalesce(kind, coded, notation.variant_type(F.col("normalized")))).withColumn("position", F.regexp_extract("raw", r"\d+", 0).try_cast("int"))


def rejection(gene: str, length: int | None) -> Column:
    """Why a described mention is none of the gene's: token, hotspot (known from another gene) or beyond (past the protein's end); null where none holds."""
    other = gates.non_target_reason(F.col("normalized"), F.lit(gene.upper()), F.lit(length).cast("int"))
    past = (F.col("notation") == "protein") & ~gates.valid_position(F.col("position"), F.lit(length).cast("int"))
    return F.when(F.col("raw").rlike(FALSE_TOKENS) | (F.length("raw") < 3), "token").when(F.col("notation") == "protein", other).when(past, "beyond")


def variants(mentions: DataFrame, attributed: DataFrame | None, gene: str, length: int | None = None, id_col: str = "doc_id") -> DataFrame:
    """One row per document and change of the gene: normalized, notation, variant_type, position, confidence, start, end, n.

    The surest mention stands for a change, the earlier of equals. `attributed`
    (attribution.attribute's rows) tells the genes of mentions. A mention of
    other genes alone is left out, and so is each mention of a token that the
    document gives to other genes only: a single mention in the gene's own
    company, or none that any gene claims, keeps the token.
    """
    rows = described(mentions)
    rows = rows.withColumn("_reason", F.coalesce(rejection(gene, length), F.lit(""))).where("_reason = ''").drop("_reason")
    if attributed is not None:
        own = F.array_contains("genes", gene)
        rows = rows.join(attributed.select(id_col, "start", "genes"), [id_col, "start"], "left")
        told = F.size(F.coalesce("genes", F.array().cast("array<string>"))) > 0
        tokens = rows.groupBy(id_col, F.lower("raw").alias("_token")).agg(F.max(told & own).alias("_own"), F.max(told & ~own).alias("_other"))
        rows = rows.withColumn("_token", F.lower("raw")).join(tokens, [id_col, "_token"])
        rows = rows.where(~(told & ~own) & (F.coalesce("_own", F.lit(False)) | ~F.coalesce("_other", F.lit(False))))
    best = F.min_by(F.struct("notation", "variant_type", "position", "confidence", "start", "end"), F.struct(-F.col("confidence"), F.col("start"))).alias("b")
    return rows.groupBy(id_col, "normalized").agg(best, F.count(F.lit(1)).alias("n")).select(id_col, "normalized", "b.*", "n")


def extraction_rows(found: DataFrame, docs: DataFrame, gene: str, id_col: str = "doc_id", text_col: str = "text", around: int = 50) -> DataFrame:
    """variants() in the shape of extracted ones: a notation in the column of its kind, the words around as a quote, evidence_level scanner."""
    kind = lambda *kinds: F.when(F.col("notation").isin(*kinds), F.col("normalized"))
    first = F.greatest(F.col("start") - around, F.lit(0))
    quote = F.trim(F.regexp_replace(F.substr(F.col(text_col), first + 1, F.col("end") + around - first), r"\s+", " "))
    return found.join(docs.select(id_col, text_col), id_col).select(
        id_col,
        F.lit(gene).alias("gene_symbol"),
        kind("protein").alias("protein_notation"),
        kind("cdna", "splice").alias("cdna_notation"),
        kind("legacy").alias("legacy_notation"),
        kind("structural").alias("structural_description"),
        F.lit("scanner").alias("evidence_level"),
        "confidence",
        quote.alias("key_quote"),
    )
