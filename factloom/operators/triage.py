"""Which documents to read, and how closely, from counted signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.counts import stable_sample
from factloom.functions.text import capped_count, co_occurrence

VARIANT = r"\b[A-Z]\d{2,4}[A-Z*X]\b|\bp\.[A-Z][a-z]{2}\d+|\bc\.\d+"
CARRIER = r"(?i)\b(carriers?|heterozyg\w+|homozyg\w+|probands?|patients?)\b"
TABLE = r"(?i)\btable\s+\d+|supplement"
ORIGINAL = r"(?i)\b(we (?:identified|found|screened|sequenced)|our (?:cohort|patients))\b"


def signals(text: Column, title: Column, gene: str, limit: int = 2_000_000) -> Column:
    """Counted signals of a document for a target gene pattern."""
    return F.struct(
        F.regexp_count(title, F.lit(gene)).alias("title_mentions"),
        capped_count(text, gene, 50).alias("gene_mentions"),
        co_occurrence(text, gene, VARIANT, 20).alias("gene_variant_lines"),
        co_occurrence(text, gene, CARRIER, 20).alias("gene_carrier_lines"),
        capped_count(text, TABLE, 20).alias("tables"),
        capped_count(text, ORIGINAL, 20).alias("original"),
        capped_count(text, CARRIER, 50).alias("carriers"),
        title.rlike(r"(?i)\b(review|editorial|protocol)\b").alias("review"),
        (F.length(text) > limit).alias("oversized"),
    )


def triage(s: Column) -> Column:
    """(decision, confidence, reason) by the first rule that holds."""
    say = lambda d, c, r: F.struct(F.lit(d).alias("decision"), F.lit(c).alias("confidence"), F.lit(r).alias("reason"))
    gene = s["title_mentions"] + s["gene_mentions"] > 0
    return (
        F.when(s["oversized"], say("skip", 0.98, "oversized"))
        .when(s["review"] & (s["gene_variant_lines"] == 0), say("skip", 0.9, "review"))
        .when(~gene, say("skip", 0.9, "no gene"))
        .when((s["gene_variant_lines"] > 0) & (s["gene_carrier_lines"] > 0) & ((s["tables"] > 0) | (s["original"] > 0)), say("extract_now", 0.88, "variants and counts"))
        .when((s["gene_variant_lines"] > 0) & ((s["tables"] > 0) | (s["carriers"] > 0)), say("extract_now", 0.74, "variants"))
        .otherwise(say("defer", 0.62, "ambiguous"))
    )


def select(candidates: DataFrame, decisions: DataFrame, key: str, include_defer: bool = False) -> DataFrame:
    allowed = decisions.where(F.col("decision").isin("extract_now", *(["defer"] if include_defer else [])))
    return candidates.join(allowed.select(key), key, "left_semi")


def check_tier(key: Column, facts: Column, quarantined: Column, quoted: Column, roles: Column, confidence: Column, audit_rate: float = 0.05) -> Column:
    """full, cheap or skip: risk first, then a stable audit sample."""
    risky = F.coalesce(quarantined, F.lit(False)) | (quoted < 0.5) | (roles > 2) | (confidence < 0.5)
    return F.when(facts == 0, "skip").when(F.coalesce(risky, F.lit(True)), "full").when(stable_sample(key, audit_rate), "full").otherwise("cheap")
