"""Gates on documents and rows before and after extraction: scope, layers, notation, claims, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import notation
from factloom.functions.links import layer_primary
from factloom.functions.text import markers

# Words and patterns of the gates.
SPECIES = r"(?:canine|feline|murine|bovine|porcine|equine|ovine|rat|mouse|mice|dog|dogs|cat|cats|zebrafish|chicken|rabbit|xenopus|drosophila|c\.\s?elegans)"
TABLE_MARKS = ("regex", "deterministic", "fixed-width", "router", "vertical gene table", "lqt mutation table")
NOISY_LAYERS = ("regex_text", "regex_table", "figure")
RESIDUE_PROSE = r"(?i)\b(?:amino acids?|residues?|codons?)\b"
STRUCTURAL_CLASSES = ("structural", "exon_deletion", "exon_duplication", "whole_gene_deletion", "cnv")
PROTEIN_SHAPE = r"^(?i)(?:p\.)?(?:[A-Z]|[A-Z]{3})\d+\S*$|^\d+(?:fs|del|dup|ins)\S*$"
CODING_SHAPE = r"^(?i)c\.[-*]?\d+"
FAILURES = ("text extraction failed", "manual review required", "[pdf file available at")


def nonhuman_ortholog(text: Column, gene: str) -> Column:
    """A species right before the gene, or after it with in, of or from, unless the gene is called human."""
    before = text.rlike(rf"(?i)\b{SPECIES}\s+(?:\w+\s+)?{gene}\b")
    after = text.rlike(rf"(?i)(?<!\bhuman\s)\b{gene}\b.{{0,40}}\b(?:in|of|from)\s+(?:the\s+)?{SPECIES}\b")
    return F.coalesce(before | after, F.lit(False))


def infer_layer(layer: Column, *places: Column) -> Column:
    """The explicit layer, else by what the places say."""
    said = F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in places]))
    has = lambda *words: markers(said, words) > 0
    guess = (
        F.when(has("clinvar"), "clinvar").when(has("pubtator"), "pubtator").when(has("figure"), "figure").when(has(*TABLE_MARKS), "regex_table")
        .when(has("scanner", "text scan"), "regex_text").when(has("table"), "llm_table").otherwise("llm_text")
    )
    return F.coalesce(layer_primary(layer), guess)


def junk_reason(layer: Column, protein: Column, coding: Column, gene: Column) -> Column:
    """Why a notation of a noisy layer is none: the gene's own name, a stub, or prose on residues."""
    squeeze = lambda c: F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", ""))
    short = F.regexp_replace(squeeze(protein), r"^P\.", "")
    named = (squeeze(protein) == squeeze(gene)) | (squeeze(coding) == squeeze(gene))
    reason = F.when(named & (squeeze(gene) != ""), "gene_symbol_as_variant").when((short != "") & (F.length(short) <= 2), "short_protein_notation").when(F.coalesce(protein.rlike(RESIDUE_PROSE) | coding.rlike(RESIDUE_PROSE), F.lit(False)), "residue_prose")
    return F.when(layer_primary(layer).isin(*NOISY_LAYERS), reason)


def sanitize(rows: DataFrame) -> DataFrame:
    """Malformed notations and classes nulled, p.(..) unwrapped, and whether any identity is left."""
    bare = lambda c: F.regexp_replace(F.trim(F.col(c)), r"\s+", "")
    protein = F.regexp_replace(bare("protein_notation"), r"^(?i)p\.\((.+)\)$", "p.$1")
    out = rows.withColumn("protein_notation", F.when(protein.rlike(PROTEIN_SHAPE), protein)).withColumn("cdna_notation", F.when(bare("cdna_notation").rlike(CODING_SHAPE), F.col("cdna_notation")))
    out = out.withColumn("variant_class", F.when(F.lower(F.trim("variant_class")).isin("point", "indel", "splice", *STRUCTURAL_CLASSES), F.lower(F.trim("variant_class"))))
    filled = lambda c: F.coalesce(F.trim(F.col(c)) != "", F.lit(False))
    structural = F.coalesce(F.col("variant_class").isin(*STRUCTURAL_CLASSES), F.lit(False)) & filled("structural_description")
    return out.withColumn("usable", filled("protein_notation") | filled("cdna_notation") | filled("legacy_notation") | filled("genomic_position") | structural)


def artifact_reason(protein: Column, coding: Column, other: Column, protein_length: Column) -> Column:
    """Why an extracted row is no change: nameless, a bare number or allele, or beyond the protein."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    return (
        F.when(blank(protein) & blank(coding) & blank(other), "nameless")
        .when(F.coalesce(protein.rlike(r"^(?i)(?:[ACGT]|[ACGT]/[ACGT]|p\s*[<=>].*|n\s*=.*|[\d.]+%?)$"), F.lit(False)), "table artifact")
        .when(~blank(protein) & ~protein.rlike(PROTEIN_SHAPE) & blank(coding) & blank(other), "malformed")
        .when(notation.position(protein) > protein_length, "out_of_range")
    )


def keep_target_gene(rows: DataFrame, attribution: DataFrame, target: str) -> DataFrame:
    """Rows of the target gene: those labelled so, and unlabelled ones unless their notation is attributed to other genes alone."""
    others = attribution.groupBy("raw").agg(F.max((F.col("gene") == target).cast("int")).alias("_own"))
    both = rows.join(others, "raw", "left")
    unlabelled = F.col("gene").isNull() | F.upper("gene").isin("", "UNKNOWN")
    return both.where(F.when(unlabelled, F.coalesce(F.col("_own"), F.lit(1)) == 1).otherwise(F.upper("gene") == target.upper())).drop("_own")


def input_reason(text: Column, gene: str, least: int = 500, alnum: float = 0.5) -> Column:
    """Why a text is no input for extraction; "ok" if it is."""
    low = F.lower(text)
    size = F.length(text)
    marked = F.filter(F.split(low, "\n", -1), lambda x: markers(x, FAILURES) > 0)
    rest = F.aggregate(F.filter(F.split(low, "\n", -1), lambda x: markers(x, FAILURES) == 0), F.lit(0), lambda a, x: a + F.length(x))
    plain = F.length(F.trim(F.regexp_replace(text, r"<[^>]{1,200}>", "")))
    useful = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}\s]", ""))
    return (
        F.when(text.isNull() | (text == ""), "empty")
        .when(size < least, "short")
        .when((F.size(F.array_distinct(F.transform(marked, lambda x: F.trim(x)))) >= 2) & (rest < 1000), "failed extraction")
        .when(((size - plain) / size >= 0.5) & (plain < least), "markup")
        .when(useful / size < alnum, "few letters")
        .when(text.rlike(r"(?i)c\.\d+|p\.[A-Z]|[A-Z]\d+[A-Z]|mutation|variant|carrier"), "ok")
        .when(F.contains(F.upper(text), F.lit(gene.upper())), "ok")
        .otherwise("off topic")
    )


def specificity(known: Column, gene_near: Column, other_near: Column, in_range: Column) -> Column:
    """supported, weak or off_target for a change of the target gene."""
    return F.when(other_near & ~gene_near, "off_target").when(F.coalesce(~in_range, F.lit(False)), "off_target").when(known | gene_near, "supported").otherwise("weak")


def claim_score(layer: Column, total: Column, affected: Column, unaffected: Column, uncertain: Column, repeated: Column, declared: Column, notes: Column) -> Column:
    """Points for checking a claim: its layer, size, arithmetic, repetition and provenance; 0 without counts."""
    yes = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    largest, low = F.greatest(total, affected, unaffected, uncertain), F.lower(F.coalesce(notes, F.lit("")))
    by_layer = F.when(layer.isin("regex_table", "regex_text"), 7).when(layer == "figure", 5).when(layer == "mixed", 4).when(layer == "llm_table", 2).otherwise(0)
    by_size = F.when(largest >= 100, 4).when(largest >= 50, 3).when(largest >= 10, 1).otherwise(0)
    source = F.when(declared.isNull(), 2).when(declared != "per_variant_carrier", 6).otherwise(0)
    points = F.lit(2) + by_layer + by_size + yes(affected + unaffected + F.coalesce(uncertain, F.lit(0)) != total, 6) + yes(repeated, 5) + source
    points = points + yes(low.rlike("auto-detected|pattern scanning"), 3) + yes(F.contains(low, F.lit("regex")), 2)
    return F.when(largest.isNull(), 0).otherwise(points)


def reference_gate(rows: DataFrame, sequences: DataFrame, policy: str = "flag", guard: int = 50) -> DataFrame:
    """Rows with ref_verdict; under drop, simple substitutions beyond the guard that disagree with the sequence go."""
    if policy not in ("off", "flag", "drop"):
        raise ValueError(f"unknown policy: {policy}")
    if policy == "off":
        return rows
    both = rows.join(sequences.select(F.col("gene").alias("_gene"), "sequence"), F.col("gene_symbol") == F.col("_gene"), "left").drop("_gene")
    out = both.withColumn("ref_verdict", notation.reference_verdict(F.col("protein_notation"), F.col("sequence"))).drop("sequence")
    bad = F.col("ref_verdict").isin("mismatch", "out_of_range") & (notation.position(F.col("protein_notation")) > guard) & notation.bare(F.col("protein_notation")).rlike(r"^[A-Za-z]{1,3}\d+(?:[A-Z]|[A-Z][a-z]{2})$")
    return out.where(~F.coalesce(bad, F.lit(False))) if policy == "drop" else out


# Severities in order.
SEVERITY = ("low", "medium", "high", "critical")


def compose_final_check(tiered: DataFrame, findings: DataFrame, key: list[str], least: str = "high") -> DataFrame:
    """Reasons of grounded, current findings of enough severity added to those of the rules; earlier ones of this kind are dropped first."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITY)), F.lower("severity"))
    good = findings.where((rank >= SEVERITY.index(least) + 1) & F.col("grounded") & (F.col("source_hash") == F.col("current_hash")))
    codes = good.groupBy(*key).agg(F.array_sort(F.collect_set(F.concat(F.lit("paper_final_check:"), F.col("code")))).alias("_codes"))
    base = F.filter("trust_reasons", lambda r: ~r.startswith("paper_final_check:"))
    out = tiered.join(codes, key, "left").withColumn("trust_reasons", F.array_sort(F.array_union(base, F.coalesce("_codes", F.array().cast("array<string>"))))).drop("_codes")
    return out.withColumn("trust_tier", F.when(F.size("trust_reasons") > 0, "quarantine").otherwise("trusted"))


def redact(values: Column, secret: str = r"(?i)(api[_-]?key|authorization|token|password|cookie)") -> Column:
    """A map with the values of secret names hidden."""
    return F.transform_values(values, lambda k, v: F.when(k.rlike(secret), "[redacted]").otherwise(v))


def fold_supplement(full: Column, supplement: Column) -> Column:
    """The text with its fenced supplement block replaced; the same input gives the same output."""
    base = F.regexp_replace(full, r"(?s)\n*<!-- supplement:start -->.*?<!-- supplement:end -->\n*", "")
    return F.when(supplement.isNull(), full).otherwise(F.concat(F.rtrim(base), F.lit("\n\n<!-- supplement:start -->\n"), supplement, F.lit("\n<!-- supplement:end -->\n")))
