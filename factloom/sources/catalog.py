"""Facts from a set of tables whose layout is not known beforehand.

Only schemas are looked at to tell what columns mean and which tables to use;
the scan itself is one plan, so columns and filters are pruned as usual.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators import relational

# Parts of column names by what a column holds, and the tables that are known by name.
PAPER_NAMES = ("pmid", "pubmed", "paper_id", "article_id")
VARIANT_NAMES = ("protein_notation", "cdna_notation", "hgvs", "variant", "mutation", "genomic_position", "protein_change")
COUNT_NAMES = {
    "carriers_total": ("total_carriers", "carriers", "total_carriers_observed", "n_total"),
    "affected_count": ("affected_count", "affected", "n_affected", "cases"),
    "unaffected_count": ("unaffected_count", "unaffected", "n_unaffected", "controls"),
    "uncertain_count": ("uncertain_count", "uncertain", "n_uncertain"),
}
LINKED = ("variant_papers", "penetrance_data", "individual_records")
COUNTS = ("carriers_total", "affected_count", "unaffected_count")
PENETRANCE = {"carriers_total": "total_carriers_observed", "affected_count": "affected_count", "unaffected_count": "unaffected_count"}


@dataclass
class Layout:
    """What the columns of a table hold; of several columns that fit, the last one counts, for variants all."""

    paper: str | None = None
    variants: list[str] = field(default_factory=list)
    counts: dict[str, str] = field(default_factory=dict)


def layout(columns: list[str]) -> Layout:
    fits = lambda name, parts: any(p in name.lower() for p in parts)
    found = Layout(variants=[c for c in columns if fits(c, VARIANT_NAMES)])
    for c in columns:
        if fits(c, PAPER_NAMES):
            found.paper = c
        found.counts.update({kind: c for kind, parts in COUNT_NAMES.items() if fits(c, parts)})
    return found


def strategy(tables: dict[str, list[str]]) -> tuple[str, str]:
    """(strategy, main table) for tables given by their columns; ValueError if none of them holds facts."""
    if "variants" in tables and (known := [t for t in LINKED if t in tables]):
        return "union_all", known[0]
    layouts = {name: layout(columns) for name, columns in tables.items()}
    if "penetrance_data" in tables and layouts["penetrance_data"].paper and layouts["penetrance_data"].counts:
        return "penetrance_data", "penetrance_data"
    for name, found in layouts.items():
        if found.paper and found.variants and found.counts:
            return "combined", name
    if "individual_records" in tables and layouts["individual_records"].paper:
        return "individual_records", "individual_records"
    raise ValueError(f"no table of facts among {sorted(tables)}")


def _trusted(table: DataFrame, column: str, name: str, all_rows: bool) -> Column:
    """A count unless its field, or where no field is marked its row, is quarantined."""
    if column not in table.columns:
        return F.lit(None).cast("int").alias(name)
    if all_rows or "trust_tier" not in table.columns:
        return F.col(column).cast("int").alias(name)
    bad = F.coalesce(F.col("trust_tier") == "quarantine", F.lit(False))
    if "field_trust" in table.columns:
        marks = F.try_parse_json("field_trust")
        said = F.try_variant_get(marks, f"$.{name}", "string")
        bad = F.when(marks.isNotNull() & (F.col("field_trust") != ""), F.coalesce(said == "quarantine", F.lit(False))).otherwise(bad)
    return F.when(~bad, F.col(column)).cast("int").alias(name)


def _records(table: DataFrame, key: list[str]) -> DataFrame:
    """Counts of persons: all, affected, unaffected."""
    status = F.lower(F.trim("affected_status"))
    whole = lambda c: c.cast("int")
    return table.groupBy(*key).agg(whole(F.count(F.lit(1))).alias("carriers_total"), whole(F.count_if(status == "affected")).alias("affected_count"), whole(F.count_if(status == "unaffected")).alias("unaffected_count"))


def facts(tables: dict[str, DataFrame], trust_mode: str = "trusted") -> DataFrame:
    """One row per paper and variant: pmid, variant, carriers_total, affected_count, unaffected_count.

    With `variants` and any linked table, every link of any of them counts;
    counts are those of penetrance_data where it has the link, else of the
    persons recorded. "trusted" shows quarantined counts as not stated and keeps
    the row; "all" shows all.
    """
    if trust_mode not in ("trusted", "all"):
        raise ValueError("trust_mode is trusted or all")
    plan, main = strategy({name: t.columns for name, t in tables.items()})
    every = trust_mode == "all"
    if plan == "union_all":
        key = ["pmid", "variant_id"]
        linked = [tables[t].select(F.col("pmid").cast("string").alias("pmid"), "variant_id") for t in LINKED if t in tables]
        layers = []
        if "penetrance_data" in tables:
            p = tables["penetrance_data"]
            counted = p.select(F.col("pmid").cast("string").alias("pmid"), "variant_id", *[_trusted(p, PENETRANCE[c], c, every) for c in COUNTS])
            layers.append(counted.groupBy(*key).agg(*[F.sum(c).cast("int").alias(c) for c in COUNTS]))
        if "individual_records" in tables:
            layers.append(_records(tables["individual_records"].withColumn("pmid", F.col("pmid").cast("string")), key))
        out = relational.link_spine(linked, key)
        known = F.lit(False)
        values = {c: F.lit(None).cast("int") for c in COUNTS}
        for n, layer in enumerate(layers):
            out = out.join(layer.select(*key, F.lit(True).alias(f"_in{n}"), *[F.col(c).alias(f"_{c}{n}") for c in COUNTS]), key, "left")
        for n in reversed(range(len(layers))):  # a link that a layer has takes all its counts, null or not
            here = F.coalesce(F.col(f"_in{n}"), F.lit(False))
            values = {c: F.when(here, F.col(f"_{c}{n}")).otherwise(v) for c, v in values.items()}
            known = known | here
        names = tables["variants"]
        spelled = [F.col(c) for c in ("protein_notation", "cdna_notation", "genomic_position", "structural_description") if c in names.columns]
        named = names.select(F.col("variant_id"), F.coalesce(*spelled).alias("variant"))
        return out.join(named, "variant_id").select("pmid", "variant", *[v.alias(c) for c, v in values.items()])
    found = layout(tables[main].columns)
    rows = tables[main]
    paper = F.col(found.paper).cast("string").alias("pmid")
    variant = F.coalesce(*[F.col(c).cast("string") for c in found.variants]).alias("variant") if found.variants else F.lit(None).cast("string").alias("variant")
    if plan == "individual_records":
        return _records(rows.withColumn("variant", variant).withColumn("pmid", paper), ["pmid", "variant"])
    return rows.select(paper, variant, *[_trusted(rows, found.counts.get(c, ""), c, every) for c in COUNTS])


def add_columns(table: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """The table with the columns it lacks, as nulls of the type wanted; those it has stay as they are, so it may be done again."""
    return table.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in wanted.items() if name not in table.columns])
