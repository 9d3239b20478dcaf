"""Merges and repairs of extracted facts: policies, adoption, continuation, orphans, defaults, merges of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import counts, identity
from factloom.functions import notation as spelled

POLICIES = ("off", "flag", "clear")


def _blank(column: str) -> Column:
    return F.coalesce(F.trim(column), F.lit(""))


def apply_policy(facts: DataFrame, flags: dict[str, Column], policy: str = "flag", label: str | None = None) -> DataFrame:
    """Count fields that a guard objects to: noted with raw value and reason (`flag`), and also cleared (`clear`); `off` changes nothing.

    `flags` has for each field a Column with the reason, null where there is no objection.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    if policy == "off":
        return facts
    told = F.col(label) if label else F.lit(None).cast("string")
    noted = [F.when(reason.isNotNull() & F.col(f).isNotNull(), F.struct(F.lit(f).alias("field"), F.col(f).cast("long").alias("raw"), told.alias("label"), reason.alias("reason"))) for f, reason in flags.items()]
    out = facts.withColumn("flags", F.array_compact(F.array(*noted)))
    if policy == "clear":
        flagged = F.transform("flags", lambda x: x["field"])
        out = out.select(*[F.when(~F.array_contains(flagged, f), F.col(f)).alias(f) if f in flags else f for f in out.columns])
    return out


def adopt_figure_counts(facts: DataFrame, layers: str, notes: str, fields: list[str]) -> DataFrame:
    """Missing counts filled from the JSON notes of a fact, if a figure is among the layers it was seen in."""
    figure = F.array_contains(F.split(F.coalesce(layers, F.lit("")), r"\s*,\s*"), "figure")
    fill = lambda f: F.coalesce(f, F.when(figure, F.get_json_object(notes, f"$.{f}").try_cast("int")))
    return facts.select(*[fill(c).alias(c) if c in fields else c for c in facts.columns])


def apply_repairs(facts: DataFrame, repairs: DataFrame, key: list[str], fields: list[str], stamp: str) -> tuple[DataFrame, DataFrame]:
    """(facts, log): repaired values where a key has one fact; a fact is made where it has none; keys with several are left and logged as ambiguous.

    `repairs` has the key and the fields, null for "no change", one row per key.
    """
    new = repairs.select(*key, *[F.col(f).alias(f"_new_{f}") for f in fields], F.lit(True).alias("_asked"))
    number = facts.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    joined = facts.join(number, key).join(new, key, "left")
    ok = F.coalesce(F.col("_asked") & (F.col("_n") == 1), F.lit(False))
    changed = [F.when(ok, F.coalesce(f"_new_{f}", f)).otherwise(F.col(f)).alias(f) for f in fields]
    rest = [c for c in facts.columns if c not in fields and c not in key]
    kept = joined.select(*key, *changed, *rest, F.when(ok, F.lit(stamp)).alias("repaired_by"))
    missing = new.join(number, key, "left_anti").select(*key, *[F.col(f"_new_{f}").alias(f) for f in fields], F.lit(stamp).alias("repaired_by"))
    log = new.join(number, key, "left").withColumn("action", F.when(F.col("_n").isNull(), "created").when(F.col("_n") > 1, "ambiguous").otherwise("updated")).select(*key, "action")
    return kept.unionByName(missing, allowMissingColumns=True), log


def grounded(responses: DataFrame, asked: DataFrame, source: str, key: list[str], quote: str) -> DataFrame:
    """Responses to what was asked whose quote stands in the source text, white space and case aside."""
    from factloom.functions.links import verbatim

    return responses.join(asked.select(*key).distinct(), key, "left_semi").where(verbatim(F.col(quote), F.col(source)))


def guarded_percentage(facts: DataFrame, percentage: str, fact: str, quote: str, variant: str, source: str) -> DataFrame:
    """A percentage stays only with a fact of its own whose quote is verbatim, holds it and names the variant; removals are flagged."""
    from factloom.functions.links import percentage_quoted, verbatim

    fine = F.col(fact).isNotNull() & verbatim(F.col(quote), F.col(source)) & percentage_quoted(F.col(quote), F.col(percentage)) & F.contains(F.lower(quote), F.lower(variant))
    bad = F.col(percentage).isNotNull() & ~F.coalesce(fine, F.lit(False))
    return facts.withColumn("removed", bad).withColumn(percentage, F.when(~bad, F.col(percentage)))


def without_orphans(children: DataFrame, parents: DataFrame, key: list[str]) -> DataFrame:
    """Children whose parent exists; a null key has none."""
    return children.join(parents.select(*key).distinct(), key, "left_semi")


def repaired_papers(papers: DataFrame, file: str) -> DataFrame:
    """pmid, pmc_id, title and gene_symbol with defaults: an id from the file's name where it is no id (an archive id moves to pmc_id), a made-up title, the gene of the name; `repairs` counts what changed."""
    from_name = F.nullif(F.regexp_extract(F.col(file), r"(?i)PMID_(\d{1,8})", 1), F.lit(""))
    said = F.trim("pmid")
    valid = counts.valid_id(said)
    archive = F.upper(said).rlike(r"^PMC\d+$")
    pmid = F.when(valid, said).otherwise(F.coalesce(from_name, F.col("pmid")))
    moved = ~valid & from_name.isNotNull() & archive & (_blank("pmc_id") == "")
    title = F.when(_blank("title") == "", F.concat(F.lit("Paper "), F.coalesce(pmid, F.lit("Unknown")))).otherwise(F.col("title"))
    gene = F.when(_blank("gene_symbol") == "", identity.gene_of_file(F.col(file))).otherwise(F.col("gene_symbol"))
    new = {"pmid": pmid, "pmc_id": F.when(moved, F.upper(said)).otherwise(F.col("pmc_id")), "title": title, "gene_symbol": gene}
    changed = sum((F.when(c.eqNullSafe(F.col(n)), 0).otherwise(1) for n, c in new.items()), F.lit(0))
    return papers.select(*[c for c in papers.columns if c not in new], *[c.alias(n) for n, c in new.items()], changed.alias("repairs"))


def repaired_people(people: DataFrame, status: str = "affected_status") -> DataFrame:
    """Persons with a status of the three known; those without any are uncertain."""
    return people.withColumn(status, F.coalesce(counts.affected_status(F.col(status)), F.lit("uncertain")))


def continued(base: DataFrame, more: DataFrame, paper: str) -> DataFrame:
    """Base variants of a paper and those of a continuation whose notation the base does not have, each once.

    The structural description counts only where there is no other notation.
    """
    names = ("cdna_notation", "protein_notation", "legacy_notation")
    bare = F.concat(*[_blank(n) for n in names]) == ""
    key = F.struct(*[_blank(n).alias(n) for n in names], F.when(bare, F.coalesce(spelled.exon_event(F.col("structural_description")), F.lower(_blank("structural_description")))).otherwise("").alias("s"))
    new = more.withColumn("_key", key).join(base.select(paper, key.alias("_key")).distinct(), [paper, "_key"], "left_anti").dropDuplicates([paper, "_key"]).drop("_key")
    return base.unionByName(new)


def merge_tables(base: DataFrame, found: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Facts of a model and facts of its tables: of a fact that both have the table's counts stand where it states any, other columns are filled; facts of tables alone are added.

    `origin` is base, table or both. Both sides have one row per key.
    """
    a = base.select(*key, *[F.col(c).alias(f"_a_{c}") for c in base.columns if c not in key], F.lit(True).alias("_in_a"))
    b = found.select(*key, *[F.col(c).alias(f"_b_{c}") for c in found.columns if c not in key], F.lit(True).alias("_in_b"))
    columns = list(dict.fromkeys(c for c in (*base.columns, *found.columns) if c not in key))
    side = lambda s, c, frame: F.col(f"_{s}_{c}") if c in frame.columns else F.lit(None)
    first = lambda c: (side("b", c, found), side("a", c, base)) if c in fields else (side("a", c, base), side("b", c, found))
    origin = F.when(F.col("_in_a") & F.col("_in_b"), "both").when(F.col("_in_a"), "base").otherwise("table")
    return a.join(b, key, "full_outer").select(*key, *[F.coalesce(*first(c)).alias(c) for c in columns], origin.alias("origin"))


def missing_links(old: DataFrame, target: DataFrame, listed: DataFrame, paper: str, key: list[str]) -> DataFrame:
    """Links of an old table to add to a target: of listed papers of which the old one has more links, those whose null-safe identity the target lacks."""
    number = lambda t, name: t.groupBy(paper).agg(F.count(F.lit(1)).alias(name))
    more = number(old, "_o").join(listed.select(paper).distinct(), paper, "left_semi").join(number(target, "_t"), paper, "left").where(F.col("_o") > F.coalesce("_t", F.lit(0))).select(paper)
    same = [F.coalesce(F.col(k).cast("string"), F.lit("\0")).alias(f"_{k}") for k in key]
    have = target.select(paper, *same).distinct()
    return old.join(more, paper, "left_semi").select("*", *same).join(have, [paper, *[f"_{k}" for k in key]], "left_anti").drop(*[f"_{k}" for k in key])


def sync_reference(stored: DataFrame, incoming: DataFrame, key: list[str], fields: list[str], excluded: DataFrame, version: int) -> DataFrame:
    """The next version of a reference set: every key of either side with its change (added, updated, removed, same), the version it changed in, and whether its paper is excluded."""
    a = stored.select(*key, *[F.col(f).alias(f"_a_{f}") for f in fields], F.col("version").alias("_v"), F.lit(True).alias("_in_a"))
    b = incoming.select(*key, *fields, F.lit(True).alias("_in_b"))
    equal = F.lit(True)
    for f in fields:
        equal = equal & F.col(f).eqNullSafe(F.col(f"_a_{f}"))
    change = F.when(F.col("_in_a").isNull(), "added").when(F.col("_in_b").isNull(), "removed").when(equal, "same").otherwise("updated")
    out = a.join(b, key, "full_outer").withColumn("change", change)
    out = out.select(*key, *[F.when(F.col("change") == "removed", F.col(f"_a_{f}")).otherwise(F.col(f)).alias(f) for f in fields], "change", F.when(F.col("change") == "same", F.col("_v")).otherwise(version).alias("version"))
    marks = excluded.distinct().withColumn("_out", F.lit(True))
    return out.join(marks, excluded.columns, "left").withColumn("excluded", F.coalesce("_out", F.lit(False))).drop("_out")


def annotate_origin(variants: DataFrame, label: Column, policy: str = "flag") -> DataFrame:
    """somatic_germline label of every variant; drop_somatic leaves out those labelled somatic, never ambiguous or unknown ones."""
    if policy not in ("flag", "drop_somatic"):
        raise ValueError(f"unknown policy {policy!r}")
    out = variants.withColumn("origin_label", label)
    return out.where(F.coalesce(F.col("origin_label") != "somatic", F.lit(True))) if policy == "drop_somatic" else out


def origin_summary(annotated: DataFrame, key: list[str]) -> DataFrame:
    """Variants by label and the share that may be somatic."""
    n = lambda name: F.count_if(F.col("origin_label") == name).alias(name)
    out = annotated.groupBy(*key).agg(F.count(F.lit(1)).alias("total"), n("germline"), n("somatic"), n("ambiguous"), n("unknown"))
    return out.withColumn("somatic_fraction", counts.ratio(F.col("somatic") + F.col("ambiguous"), F.col("total")))
