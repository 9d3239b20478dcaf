"""Trust tiers of count facts: reason codes, field masks, projections.

A fact row has paper and the counts carriers, affected, unaffected, uncertain
(null: not stated), optional provenance text columns (<f>_count_type,
<f>_column_label, <f>_source) and the paper's study design and ascertainment.
Raw counts are never changed; the trusted projection masks them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Thresholds and vocabularies of the rules.
CEILING = 100_000
STUDY_FLOOR = 50
OUTLIER_TIMES = 10
OUTLIER_FLOOR = 50
OUTLIER_LEAST = 3
DENOMINATORS = ("cohort_total", "screened_n", "study_total", "total")
MISMATCH_DESIGNS = ("review_meta", "functional_invitro", "gwas")
POPULATION_DESIGNS = ("cohort_population", "cohort_biobank", "gwas")
EXPECT_UNAFFECTED_DESIGNS = ("cohort_population", "cohort_biobank", "case_control", "family_segregation")
EXPECT_UNAFFECTED_ASCERTAINMENTS = ("population_screening", "biobank", "family_cascade")
POPULATION_LABEL = r"(?i)gnomad|exac|topmed|1000\s*genomes|allele\s*freq|allele\s*count|\bmaf\b|\ba[cn]\b|minor\s*allele|population\s*frequency"
RECOVERY_SOURCE = "count_recovery"
FIGURE_SOURCE = "figure_count_repair"
TRUST_FIELDS = ("total_carriers", "affected", "unaffected", "uncertain")
REASON_FIELDS = {
    "implied_unaffected_zero": ["unaffected"],
    "family_count_not_carrier": ["total_carriers"],
    "recovered_count_unverified": ["total_carriers", "affected", "unaffected"],
}
RULES = (
    "arith_inconsistent", "count_is_total", "family_count_not_carrier", "population_count", "paper_outlier",
    "study_type_mismatch", "negative_count", "implied_unaffected_zero", "recovered_count_unverified", "figure_count_unverified",
)
KEPT_PREFIX = "paper_final_check:"

_PARTS = {"carriers": "total_carriers", "affected": "affected", "unaffected": "unaffected"}


def rule_version() -> str:
    """A short hash of the rules and their constants, to pin what tiered a stored fact."""
    import hashlib
    import json

    rules = [RULES, CEILING, STUDY_FLOOR, OUTLIER_TIMES, OUTLIER_FLOOR, OUTLIER_LEAST, DENOMINATORS, MISMATCH_DESIGNS, POPULATION_DESIGNS, POPULATION_LABEL, REASON_FIELDS]
    return hashlib.sha256(json.dumps(rules, sort_keys=True).encode()).hexdigest()[:12]


def paper_stats(facts: DataFrame, paper: str) -> DataFrame:
    """Per paper the median and number of stated carrier counts."""
    return facts.groupBy(paper).agg(F.median("carriers").alias("carriers_median"), F.count("carriers").alias("carriers_n"))


def _word(frame: DataFrame, name: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))) if name in frame.columns else F.lit("")


def reasons(facts: DataFrame) -> Column:
    """Sorted reason codes of a fact row that also carries carriers_median and carriers_n; empty if it is clean."""
    col = lambda n: F.col(n) if n in facts.columns else F.lit(None).cast("int")
    carriers, affected, unaffected, uncertain = (col(n) for n in ("carriers", "affected", "unaffected", "uncertain"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    design, ascertainment, kind = _word(facts, "study_design"), _word(facts, "ascertainment"), _word(facts, "carriers_count_type")
    parts = zero(affected) + zero(unaffected) + zero(uncertain)
    negative = (zero(F.least(carriers, affected, unaffected, uncertain))) < 0
    whole = affected.isNotNull() & unaffected.isNotNull() & uncertain.isNotNull()
    broken = carriers.isNotNull() & (affected.isNotNull() | unaffected.isNotNull()) & ((parts > carriers) | (whole & (parts != carriers)))
    unsourced = (_word(facts, "unaffected_column_label") == "") & _word(facts, "unaffected_count_type").isin("", "unknown")
    expects = design.isin(*EXPECT_UNAFFECTED_DESIGNS) | ascertainment.isin(*EXPECT_UNAFFECTED_ASCERTAINMENTS)
    recovered = F.lit(False)
    for field in _PARTS:
        recovered = recovered | ((_word(facts, f"{field}_source") == RECOVERY_SOURCE) & (_word(facts, f"{field}_count_type") != f"per_variant_{field}"))
    population = _word(facts, "carriers_column_label").rlike(POPULATION_LABEL) | (carriers > CEILING) | (design.isin(*POPULATION_DESIGNS) & (carriers >= STUDY_FLOOR))
    outlier = (F.col("carriers_n") >= OUTLIER_LEAST) & (F.col("carriers_median") > 0) & (carriers > F.col("carriers_median") * OUTLIER_TIMES) & (carriers > OUTLIER_FLOOR)
    rules: list[tuple[str, Column]] = [
        ("negative_count", negative),
        ("arith_inconsistent", negative | broken),
        ("implied_unaffected_zero", (unaffected == 0) & (carriers > 0) & (affected == carriers) & unsourced & expects),
        ("count_is_total", kind.isin(*DENOMINATORS)),
        ("family_count_not_carrier", kind == "family_count"),
        ("recovered_count_unverified", recovered),
        ("population_count", population),
        ("study_type_mismatch", design.isin(*MISMATCH_DESIGNS) & (zero(F.greatest(carriers, affected, unaffected)) > 0)),
        ("paper_outlier", outlier),
        *((f"figure_count_unverified:{mask}", _word(facts, f"{field}_source") == FIGURE_SOURCE) for field, mask in _PARTS.items()),
    ]
    return F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules])))


def masked_fields(codes: Column) -> Column:
    """The fields that reason codes mask, sorted: all of them unless the code says which."""
    known = F.create_map(*[x for name, fields in REASON_FIELDS.items() for x in (F.lit(name), F.array(*map(F.lit, fields)))])
    every = F.array(*map(F.lit, TRUST_FIELDS))
    own = F.transform(codes, lambda r: F.when(r.startswith("figure_count_unverified:"), F.array(F.substring_index(r, ":", -1))).otherwise(F.coalesce(F.try_element_at(known, r), every)))
    return F.array_sort(F.array_distinct(F.flatten(own)))


def tier(facts: DataFrame, paper: str, keep: str | None = None) -> DataFrame:
    """Facts with trust_reasons, masked_fields, trust_tier. Reasons of a final check in column `keep` stay; all others are made anew."""
    both = facts.join(paper_stats(facts, paper), paper)
    codes = reasons(both)
    if keep:
        codes = F.array_sort(F.array_union(codes, F.filter(F.coalesce(F.col(keep), F.array().cast("array<string>")), lambda r: r.startswith(KEPT_PREFIX))))
    out = both.withColumn("trust_reasons", codes)
    return out.withColumn("masked_fields", masked_fields(F.col("trust_reasons"))).withColumn("trust_tier", F.when(F.size("trust_reasons") > 0, "quarantine").otherwise("trusted"))


def trusted(tiered: DataFrame) -> DataFrame:
    """The projection with masked counts null."""
    columns = {"carriers": "total_carriers", "affected": "affected", "unaffected": "unaffected", "uncertain": "uncertain"}
    return tiered.withColumns({c: F.when(~F.array_contains("masked_fields", mask), F.col(c)) for c, mask in columns.items() if c in tiered.columns})


def summary(tiered: DataFrame) -> DataFrame:
    """(kind, name, n): facts by tier and by each reason."""
    by_tier = tiered.groupBy(F.col("trust_tier").alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("tier").alias("kind"), "name", "n")
    by_reason = tiered.select(F.explode("trust_reasons").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n")).select(F.lit("reason").alias("kind"), "name", "n")
    return by_tier.unionByName(by_reason)


def carrier_guard(facts: DataFrame, threshold: int = CEILING, fields: tuple[str, ...] = ("carriers", "affected", "unaffected", "uncertain")) -> tuple[DataFrame, DataFrame]:
    """(facts with all counts null above the ceiling, the rows as they were)."""
    high = F.coalesce(F.col("carriers") > threshold, F.lit(False))
    return facts.withColumns({f: F.when(~high, F.col(f)) for f in fields if f in facts.columns}), facts.where(high)


def outlier_guard(facts: DataFrame, paper: str, policy: str = "flag", field: str = "carriers", least: int = 4, times: float = 10, floor: int = 50) -> DataFrame:
    """Inclusive rule: of 4 or more positive counts of a paper, one over 50 and 10 times the median or more is an outlier.

    Policies: off, flag (outlier column), clear (count null, raw_<field> kept).
    """
    if policy not in ("off", "flag", "clear"):
        raise ValueError(f"unknown policy: {policy}")
    positive = F.when(F.col(field) > 0, F.col(field))
    stats = facts.groupBy(paper).agg(F.median(positive).alias("_median"), F.count(positive).alias("_n"))
    hit = F.coalesce((F.col("_n") >= least) & (F.col(field) > floor) & (F.col(field) >= times * F.col("_median")), F.lit(False))
    out = facts.join(stats, paper).withColumn("outlier", hit if policy != "off" else F.lit(False)).drop("_median", "_n")
    if policy == "clear":
        out = out.withColumn(f"raw_{field}", F.when(F.col("outlier"), F.col(field))).withColumn(field, F.when(~F.col("outlier"), F.col(field)))
    return out


# Families of column labels that are no count of a variant's carriers.
SUSPICIOUS_LABELS = {
    "row identifier": r"(?i)\b(?:adult|child|patient|proband|subject|case|individual|participant|family|kindred|pedigree|sample)\s*(?:number|no\.?|id)\b",
    "population allele frequency/count": r"(?i)\b(?:maf|minor allele frequency|allele frequency|eaf|frequency|occurrences?|allele count|alleles|gnomad|exac)\b",
    "genotype observation count": r"(?i)^\s*(?:het|hom|homo)\s*$|\bgenotype\b",
    "cohort denominator": r"(?i)\b(?:total\s+cases?|total\s+controls?|sample size|screened|n\s+tested|cohort size)\b",
}
ACCEPTED_TYPE = "per_variant_carrier"


def suspicious_label(label: Column) -> Column:
    out = None
    for reason, pattern in SUSPICIOUS_LABELS.items():
        out = F.when(label.rlike(pattern), reason) if out is None else out.when(label.rlike(pattern), reason)
    return out


def misclassified(count: Column, declared: Column, label: Column) -> Column:
    """Why a stated count is no count of a variant's carriers; null if it may be one."""
    odd = suspicious_label(label)
    return F.when(count.isNull(), None).when(odd.isNotNull(), F.concat(F.lit("column label looks like "), odd)).when(declared != ACCEPTED_TYPE, F.concat(F.lit("declared count type "), declared))


def phenotype_clears(carriers: Column, affected: Column, unaffected: Column, figure: Column, affected_sourced: Column, unaffected_sourced: Column) -> Column:
    """Array of (field, reason) that look copied or derived; the first reason of a field stands."""
    copied = F.coalesce((carriers == affected) & (F.coalesce(unaffected, F.lit(0)) == 0), F.lit(False))
    no = lambda c: ~F.coalesce(c, F.lit(False))
    rules = [
        ("affected", "copied_carriers_onto_affected", copied & (carriers >= 2) & no(affected_sourced)),
        ("unaffected", "implied_unaffected_zero", copied & (carriers >= 2) & no(affected_sourced) & (unaffected == 0) & no(unaffected_sourced)),
        ("affected", "figure_copied_phenotype", copied & figure & no(affected_sourced)),
        ("unaffected", "figure_copied_phenotype", copied & figure & no(affected_sourced) & (unaffected == 0) & no(unaffected_sourced)),
        ("affected", "figure_incomplete_phenotype", figure & affected.isNotNull() & carriers.isNull() & (F.coalesce(unaffected, F.lit(0)) == 0) & no(affected_sourced)),
        ("affected", "partition_does_not_close", (affected + unaffected != carriers) & no(affected_sourced)),
        ("affected", "unsourced_zero_affected", (affected == 0) & no(affected_sourced)),
    ]
    out = []
    for field in ("affected", "unaffected"):
        first = F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(reason)) for f, reason, test in rules if f == field])
        out.append(F.when(first.isNotNull(), F.struct(F.lit(field).alias("field"), first.alias("reason"))))
    return F.array_compact(F.array(*out))


def suppress_repeats(facts: DataFrame, paper: str, fields: tuple[str, ...] = ("carriers", "affected", "unaffected"), least_rows: int = 3, least_total: int = 10) -> DataFrame:
    """Null a tuple of counts that three or more rows of a paper share, with a total of 10 or more and twice the rows or more.

    Groups are counted by partial aggregation and joined back null-safely, so no group is gathered in one task.
    """
    groups = facts.groupBy(paper, *fields).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") >= least_rows) & (F.col(fields[0]) >= least_total) & (F.col(fields[0]) >= 2 * F.col("_n")))
    g = groups.select(F.col(paper).alias("_paper"), *[F.col(f).alias(f"_{f}") for f in fields])
    same = facts[paper] == g["_paper"]
    for f in fields:
        same = same & facts[f].eqNullSafe(g[f"_{f}"])
    out = facts.join(g, same, "left").withColumn("suppressed", F.col("_paper").isNotNull())
    return out.withColumns({f: F.when(~F.col("suppressed"), F.col(f)) for f in fields}).drop("_paper", *[f"_{f}" for f in fields])


def record_checks(evaluation: Column, onset: Column, diagnosis: Column) -> Column:
    """Which age orders a person's record breaks."""
    rules = [("onset_after_evaluation", onset > evaluation), ("diagnosis_after_evaluation", diagnosis > evaluation), ("onset_after_diagnosis", onset > diagnosis)]
    return F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in rules]))


def fact_checks(total: Column, affected: Column, unaffected: Column, uncertain: Column, percentage: Column) -> Column:
    """Errors and warnings of a fact: parts over the total, parts under it, a percentage off by more than 5 points."""
    parts = F.coalesce(affected, F.lit(0)) + F.coalesce(unaffected, F.lit(0)) + F.coalesce(uncertain, F.lit(0))
    rules = [
        ("error:parts_exceed_total", parts > total),
        ("warning:parts_below_total", (parts > 0) & (parts < total)),
        ("warning:percentage_mismatch", (total > 0) & (F.abs(F.try_divide(affected.cast("double") * 100, F.nullif(total.cast("double"), F.lit(0.0))) - percentage) > 5)),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in rules]))


def rank_facts(facts: DataFrame, paper: str, priority: Column, tie: list[str], top: int) -> DataFrame:
    """The `top` facts of each paper by priority, highest first."""
    order = Window.partitionBy(paper).orderBy(priority.desc(), *tie)
    return facts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
