"""Cross-document grouping, provenance rows, evidence cards and repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.counts import content_key

FIELDS = ("carriers", "affected", "unaffected")


def group_facts(variants: DataFrame, key: str = "variant_key", paper: str = "pmid") -> DataFrame:
    """Per canonical key: number of papers, of rows, and the spellings met; counts are left to precedence_sums."""
    return variants.groupBy(key).agg(F.count_distinct(paper).alias("n_papers"), F.count(F.lit(1)).alias("n_rows"), F.array_sort(F.collect_set("raw")).alias("spellings"))


def precedence_sums(cohorts: DataFrame, people: DataFrame, key: list[str], paper: str) -> DataFrame:
    """Totals per key: a paper's cohort rows win; without any, its people are counted by status. The ratio is never derived."""
    c = cohorts.groupBy(*key, paper).agg(*[F.sum(f).alias(f"c_{f}") for f in FIELDS], F.lit(True).alias("has"))
    p = people.groupBy(*key, paper).agg(F.count(F.lit(1)).alias("p_carriers"), F.count_if(F.col("affected_status") == "affected").alias("p_affected"), F.count_if(F.col("affected_status") == "unaffected").alias("p_unaffected"))
    both = c.join(p, [*key, paper], "full_outer")
    pick = lambda f: F.when(F.col("has"), F.col(f"c_{f}")).otherwise(F.col(f"p_{f}"))
    return both.groupBy(*key).agg(*[F.sum(pick(f)).cast("long").alias(f) for f in FIELDS], F.count(F.lit(1)).alias("n_papers"), F.lit(None).cast("double").alias("ratio"))


def provenance_rows(variants: DataFrame, keys: list[str]) -> DataFrame:
    """One row per stated fact of a variant, with a key that makes repeated inserts harmless."""
    facts = [("variant_identity", F.col(c)) for c in ("protein_notation", "cdna_notation", "legacy_notation") if c in variants.columns]
    facts += [(f"count_{c}", F.col(c).cast("string")) for c in FIELDS if c in variants.columns]
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("fact_type"), v.alias("fact_value")) for t, v in facts])).alias("f")
    rows = variants.select(*keys, "source_location", each).select(*keys, "source_location", "f.*").where("fact_value is not null")
    return rows.withColumn("fact_hash", content_key(**{c: F.col(c) for c in (*keys, "source_location", "fact_type", "fact_value")}))


def insert_new(stored: DataFrame, rows: DataFrame, key: str = "fact_hash") -> DataFrame:
    """The rows whose key is not stored, each once."""
    return rows.dropDuplicates([key]).join(stored.select(key), key, "left_anti")


def provenance_payload(facts: DataFrame, sources: DataFrame, key: list[str], each: int = 4) -> DataFrame:
    """Facts with up to `each` of their own source rows (the same value), as an array."""
    order = Window.partitionBy(*key, "fact_value").orderBy("fact_hash")
    best = sources.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= each)
    packed = best.groupBy(*key, "fact_value").agg(F.array_sort(F.collect_list(F.struct("fact_hash", "source_location"))).alias("sources"))
    return facts.join(packed, [*key, "fact_value"], "left")


def evidence_cards(variants: DataFrame, keys: list[str], large: int = 50) -> DataFrame:
    """variant x field rows with what speaks against each count: large, unsourced, over the total."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value"), F.element_at(F.col("count_provenance"), F.lit(f"{f}_column_label")).alias("label")) for f in FIELDS])).alias("x")
    rows = variants.select(*keys, "carriers", each).select(*keys, F.col("carriers").alias("_total"), "x.*").where("value is not null")
    triggers = F.array_compact(F.array(F.when(F.col("value") > large, F.lit("large_value")), F.when(F.col("label").isNull(), F.lit("unsourced")), F.when(F.col("value") > F.col("_total"), F.lit("exceeds_total"))))
    verdict = F.when(F.array_contains("triggers", "exceeds_total"), "REJECT").when(F.size("triggers") > 0, "WITHHOLD").otherwise("NONE")
    return rows.withColumn("triggers", triggers).withColumn("verdict", verdict).drop("_total")


def fill_total(total: Column, affected: Column, patients: Column) -> Column:
    """The patient count as the total where neither total nor affected is stated; parts are never filled."""
    return F.when(total.isNull() & affected.isNull() & (patients > 0), patients).otherwise(total)


def verified(value: Column, status: Column, correction: Column) -> Column:
    """Supported with a correction: the correction; unsupported: null; else as it was."""
    return F.when((status == "supported") & correction.isNotNull(), correction).when(status == "unsupported", None).otherwise(value)


def recovered(rows: DataFrame, found: DataFrame, key: list[str], fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Null counts filled from a recovery, with the fields filled and the row quarantined; stated counts stay."""
    both = rows.join(found.select(*key, *[F.col(f).alias(f"_{f}") for f in fields]), key, "left")
    filled = F.array_compact(F.array(*[F.when(F.col(f).isNull() & F.col(f"_{f}").isNotNull(), F.lit(f)) for f in fields]))
    out = both.withColumn("filled", filled).withColumns({f: F.coalesce(f, f"_{f}") for f in fields})
    return out.withColumn("trust_tier", F.when(F.size("filled") > 0, "quarantine").otherwise("trusted")).drop(*[f"_{f}" for f in fields])


def validate(documents: DataFrame) -> DataFrame:
    """Errors and warnings of extraction documents; a row with errors is not to be stored."""
    pmid, gene, title = (F.trim(F.col(f"paper_metadata.{c}")) for c in ("pmid", "gene_symbol", "title"))
    blank = lambda c: F.coalesce(c == "", F.lit(True))
    errors = [("no_metadata", F.col("paper_metadata").isNull()), ("blank_pmid", blank(pmid)), ("invalid_pmid", ~blank(pmid) & ~pmid.rlike(r"^\d{1,8}$")), ("blank_gene", blank(gene))]
    warnings = [("no_title", blank(title)), ("no_variants", F.coalesce(F.size("variants") <= 0, F.lit(True))), ("file_mismatch", (F.col("file_id") != "") & (F.col("file_id") != pmid))]
    pack = lambda rules: F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in rules]))
    return documents.withColumn("errors", pack(errors)).withColumn("warnings", pack(warnings))


def backfill_pairs(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The missing one of a row's protein and coding notations, from unambiguous pairs."""
    one = lambda have, want: pairs.where(f"{have} is not null and {want} is not null").groupBy(have).agg(F.min(want).alias("_w"), F.count_distinct(want).alias("_n")).where("_n = 1").select(F.col(have).alias(f"_{have}"), F.col("_w").alias(f"_from_{have}"))
    p, c = one("protein", "coding"), one("coding", "protein")
    out = rows.join(p, rows.protein == p["_protein"], "left").join(c, rows.coding == c["_coding"], "left")
    return out.withColumn("coding", F.coalesce("coding", "_from_protein")).withColumn("protein", F.coalesce("protein", "_from_coding")).drop("_protein", "_coding", "_from_protein", "_from_coding")
