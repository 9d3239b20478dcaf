"""Matching of changes pair by pair and against a baseline, by kind of change and position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import gates, notation

#: Kinds of change with their own spelling, in the order they are tried.
KINDS = {"frameshift": notation.frameshift, "nonsense": notation.nonsense, "deletion": notation.deletion, "duplication": notation.duplication}


def described(variant: Column) -> Column:
    """What matching needs to know of a change: its normal form, kind, spelling of that kind, position, residues."""
    short = notation.short_protein(variant)
    normal = F.coalesce(short, notation.cdna(variant), F.upper(F.trim(variant)))
    own = {k: F.replace(spell(variant), F.lit("?"), F.lit("")).alias(k) for k, spell in KINDS.items()}
    at = F.coalesce(notation.position(short), F.regexp_extract(variant, r"\d+", 0).try_cast("int"))
    return F.struct(normal.alias("normal"), notation.variant_type(variant).alias("kind"), *own.values(), at.alias("at"), F.regexp_replace(F.when(short.rlike(r"^[A-Z]\d+[A-Z]$"), short), r"\d+", ">").alias("swap"))


def match_type(a: Column, b: Column, tolerance: int = 1) -> Column:
    """How two described changes match: exact_normalized, <kind>_normalized, position_fuzzy_<offset>; null if they do not."""
    out = F.when(a["normal"] == b["normal"], "exact_normalized")
    for kind in KINDS:
        out = out.when(((a["kind"] == kind) | (b["kind"] == kind)) & (a[kind] == b[kind]), f"{kind}_normalized")
    offset = a["at"] - b["at"]
    near = (a["kind"] == b["kind"]) & (a["kind"] != "unknown") & (F.abs(offset) <= tolerance) & F.when(a["kind"] == "missense", a["swap"] == b["swap"]).otherwise(True)
    return out.when(near, F.concat(F.lit("position_fuzzy_"), F.when(offset >= 0, "+").otherwise(""), offset.cast("string")))


def match_baseline(extracted: DataFrame, baseline: DataFrame, key: list[str], variant: str, gene: str, length: int | None, tolerance: int = 1) -> DataFrame:
    """Every extracted change of a key with its best baseline change and how they match; null where none does, and non_target where it is not of this gene.

    Candidates are joined on what they must share: the normal form, the spelling
    of a kind, or a position within the tolerance, so no pair is looked at that
    shares nothing. Several extracted changes may match one of the baseline.
    """
    say = lambda rows, name: rows.select(*key, F.col(variant).alias(name), described(F.col(variant)).alias(f"_{name}"))
    mine = say(extracted, "found").distinct()
    outside = gates.non_target_reason(F.col("_found.normal"), F.lit(gene), F.lit(length)).alias("non_target")
    mine = mine.select("*", outside)
    tags = lambda d: F.array_distinct(F.array_compact(F.array(F.concat(F.lit("="), d["normal"]), *[F.concat(F.lit(f"{k}:"), d[k]) for k in KINDS])))
    at = lambda d, k: F.concat(F.lit("@"), (d["at"] + k).cast("string"))
    left = mine.where("non_target is null").withColumn("_tag", F.explode(F.concat(tags(F.col("_found")), F.array_compact(F.array(*[at(F.col("_found"), k) for k in range(-tolerance, tolerance + 1)])))))
    right = say(baseline, "expected").distinct().withColumn("_tag", F.explode(F.concat(tags(F.col("_expected")), F.array_compact(F.array(at(F.col("_expected"), 0))))))
    pairs = left.join(right, [*key, "_tag"]).withColumn("how", match_type(F.col("_found"), F.col("_expected"), tolerance)).where("how is not null")
    steps = ["exact_normalized", *[f"{k}_normalized" for k in KINDS]]
    rank = F.coalesce(*[F.when(F.col("how") == s, i) for i, s in enumerate(steps)], F.abs(F.col("_found.at") - F.col("_expected.at")) + len(steps))
    best = pairs.groupBy(*key, "found").agg(F.min_by(F.struct("expected", "how"), F.struct(rank.alias("r"), "expected")).alias("_m"))
    return mine.join(best, [*key, "found"], "left").select(*key, "found", "non_target", F.col("_m.expected").alias("expected"), F.col("_m.how").alias("how"))


def set_match(extracted: DataFrame, expected: DataFrame, key: list[str], variant: str, order: str) -> DataFrame:
    """matched, missed and extra normal forms of a key; of several spellings of one form the last stands."""
    normal = F.coalesce(notation.short_protein(F.col(variant)), notation.cdna(F.col(variant)), F.upper(F.trim(variant))).alias("normal")
    side = lambda rows, name: rows.where(F.col(variant) != "").groupBy(*key, normal).agg(F.max_by(variant, order).alias(name))
    both = side(extracted, "extracted").join(side(expected, "expected"), [*key, "normal"], "full_outer")
    return both.withColumn("result", F.when(F.col("extracted").isNull(), "missed").when(F.col("expected").isNull(), "extra").otherwise("matched"))
