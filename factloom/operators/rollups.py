"""Summaries, tallies and overlays of facts: per variant, paper, gene and review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import counts, notation
from factloom.operators import relational

# Words of a verdict, what a review verdict does, and what marks a text about a whole study.
TRUE_WORDS = ("real_tp", "tp", "real", "true_positive", "correct", "confirm")
FALSE_WORDS = ("false_positive", "fp", "wrong", "junk", "not_in_paper")
UNSURE_WORDS = ("unsure", "unknown", "?")
ACTIONS = {"confirm": "gold_confirmed", "correct_counts": "count_override", "wrong_variant": "false_positive", "wrong_paper": "excluded", "missing": "followup_missing", "other": "followup_other"}
STUDY_WIDE = r"(?i)\b(overall|cohort|study population|entire|all carriers|designated variant carriers|median|mean|average|percent)\b|%"


def variant_summary(facts: DataFrame, key: list[str], paper: str, carriers: str, affected: str, first: Column, carry: list[str]) -> DataFrame:
    """Per key: the `carry` columns of its first row (of several first ones the least values), total and affected carriers, share affected, papers in order."""
    one = F.min_by(F.struct(*carry), F.struct(first, *carry))
    out = facts.groupBy(*key).agg(
        one.alias("_first"), F.sum(carriers).alias("total"), F.sum(affected).alias("affected"), F.array_sort(F.collect_set(F.col(paper))).alias("papers")
    )
    return out.select(*key, *[F.col(f"_first.{c}").alias(c) for c in carry], "total", "affected", counts.ratio(F.col("affected") * 100, F.col("total")).alias("percentage"), "papers", F.size("papers").alias("n_papers"))


def summary_order() -> list[Column]:
    """Most carriers first, then the highest share; what is not stated counts as none."""
    return [F.coalesce("total", F.lit(0)).desc(), F.coalesce("percentage", F.lit(0.0)).desc()]


def nulls_last(column: str) -> list[Column]:
    """Highest first, what is not stated at the end."""
    return [F.col(column).desc_nulls_last()]


def tally_verdicts(sheet: DataFrame, verdict: str, key: list[str]) -> DataFrame:
    """True, false, unsure, blank and other verdicts, and the precision of those that decide, with its interval."""
    word = F.lower(F.trim(F.coalesce(verdict, F.lit(""))))
    of = lambda words: F.count_if(word.isin(*words))
    tp, fp, unsure = of(TRUE_WORDS), of(FALSE_WORDS), of(UNSURE_WORDS)
    out = sheet.groupBy(*key).agg(tp.alias("tp"), fp.alias("fp"), unsure.alias("unsure"), F.count_if(word == "").alias("blank"), F.count(F.lit(1)).alias("_n"))
    low, high = counts.wilson(F.col("tp"), F.col("tp") + F.col("fp"))
    return out.select(*key, "tp", "fp", "unsure", "blank", (F.col("_n") - F.col("tp") - F.col("fp") - F.col("unsure") - F.col("blank")).alias("unrecognised"), counts.ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), low.alias("low"), high.alias("high"))


def risk_views(papers: DataFrame, facts: DataFrame, runs: DataFrame, paper: str, values: list[str], tier: str, reasons: str, quotes: str, role: str, order: str, confidence: str) -> DataFrame:
    """Per paper, those without a fact too: facts with a count, any quarantine or reason, share with a quote, count roles, the last confidence."""
    stated = facts.where(F.coalesce(*values).isNotNull())
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")).isin("", "[]")
    per = stated.groupBy(paper).agg(
        F.count(F.lit(1)).alias("n_facts"),
        F.coalesce(F.bool_or(F.col(tier) == "quarantine"), F.lit(False)).alias("any_quarantine"),
        F.bool_or(~filled(F.col(reasons))).alias("any_reason"),
        F.count_if(~filled(F.col(quotes))).alias("_quoted"),
        F.count_distinct(role).alias("n_roles"),
    )
    last = runs.groupBy(paper).agg(F.max_by(confidence, order).alias("confidence"))
    out = papers.select(paper).join(per, paper, "left").join(last, paper, "left")
    n = F.coalesce("n_facts", F.lit(0))
    return out.select(
        paper, n.alias("n_facts"), F.coalesce("any_quarantine", F.lit(False)).alias("any_quarantine"), F.coalesce("any_reason", F.lit(False)).alias("any_reason"),
        F.coalesce(counts.ratio(F.col("_quoted"), n), F.lit(0.0)).alias("quoted"), F.coalesce("n_roles", F.lit(0)).alias("n_roles"), "confidence",
    )


def count_by(rows: DataFrame, column: str) -> DataFrame:
    """Rows of each value: failures by code, papers by class."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def gene_stats(corpus: DataFrame, gene: str, status: str, figures: str, supplements: str) -> DataFrame:
    """Per gene: papers, usable ones and stubs, papers with figures and with supplements."""
    usable = F.count_if(F.col(status) == "ok")
    return corpus.groupBy(gene).agg(
        F.count(F.lit(1)).alias("in_corpus"), usable.alias("usable"), (F.count(F.lit(1)) - usable).alias("stub"), F.count_if(F.col(figures) > 0).alias("with_figures"), F.count_if(F.col(supplements) > 0).alias("with_supplements")
    )


def class_stats(files: DataFrame, label: str, before: str, after: str) -> DataFrame:
    """Per class: files, share of all in whole percent, and the mean reduction of size in percent."""
    per = files.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col(before) > 0, 100 - 100 * F.col(after) / F.col(before)).otherwise(0.0)).alias("reduction"))
    every = F.sum("n").over(Window.partitionBy())  # over the few classes
    return per.select(label, "n", F.floor(F.col("n") * 100 / every).alias("percent"), "reduction")


def paper_disagreement(compared: DataFrame, papers: DataFrame, paper: str, in_gold: Column, in_found: Column) -> DataFrame:
    """Per paper with any: facts missed and facts too many, with the paper's own columns."""
    per = compared.groupBy(paper).agg(F.count_if(in_gold & ~in_found).alias("missed"), F.count_if(in_found & ~in_gold).alias("extra")).where("missed + extra > 0")
    return per.join(papers, paper, "left")


def suppress_repeated_text(facts: DataFrame, paper: str, column: str, exempt: Column, least_chars: int = 16, least_rows: int = 5) -> DataFrame:
    """Clears a text about the whole study that is copied over many facts of a paper; `cleared` says where.

    Copies are counted by partial sums of (paper, text), not in windows, so a text on very many rows is no load on one task.
    """
    folded = F.lower(F.trim(F.regexp_replace(column, r"\s+", " ")))
    wide = F.coalesce(~exempt & (F.length(folded) >= least_chars) & F.col(column).rlike(STUDY_WIDE), F.lit(False))
    rows = facts.withColumn("_folded", F.when(wide, folded))
    often = rows.where("_folded is not null").groupBy(paper, "_folded").agg(F.count(F.lit(1)).alias("_times")).where(F.col("_times") >= least_rows).select(paper, "_folded", F.lit(True).alias("_often"))
    out = rows.join(often, [paper, "_folded"], "left").withColumn("cleared", F.coalesce("_often", F.lit(False)))
    return out.withColumn(column, F.when(~F.col("cleared"), F.col(column))).select(*facts.columns, "cleared")


def previous_snapshot(lines: DataFrame, key: str, order: str, line: str) -> DataFrame:
    """Per key the last line that is a JSON object; broken lines and other values are passed over."""
    good = lines.where(F.try_parse_json(line).isNotNull() & F.ltrim(line).startswith("{"))
    return good.groupBy(key).agg(F.max_by(line, order).alias(line))


def paper_counts(rows: DataFrame, links: DataFrame, key: str, paper: str) -> DataFrame:
    """Each row with the number of distinct papers linked to its key; 0 where there are none."""
    per = links.groupBy(key).agg(F.count_distinct(paper).alias("n_papers"))
    return rows.join(per, key, "left").withColumn("n_papers", F.coalesce("n_papers", F.lit(0)))


def unmatched_class(protein: Column, coding: Column, legacy: Column, longest: Column, own: Column, others: Column) -> Column:
    """What a change that no warehouse row covers may be.

    `own` maps positions to the residues seen there in this gene, `others` those
    of other genes (maps position -> array of one-letter residues; null if not
    known). An exact residue in another gene counts for more than one in this
    gene a few places off.
    """
    bare = F.replace(F.trim(F.coalesce(protein, F.lit(""))), F.lit("p."), F.lit(""))
    number = F.regexp_extract(bare, r"\d+", 0).try_cast("int")
    residue = F.upper(F.regexp_extract(bare, r"^(?:\()?([A-Z])(\d+)", 1))
    at = F.regexp_extract(bare, r"^(?:\()?([A-Z])(\d+)", 2).try_cast("int")
    seen = F.try_element_at(own, at)
    strange = (residue != "") & (F.size(seen) > 0) & ~F.array_contains(seen, residue)
    near = F.exists(F.array(*[F.lit(k) for k in (-3, -2, -1, 1, 2, 3)]), lambda k: F.coalesce(F.array_contains(F.try_element_at(own, at + k), residue), F.lit(False)))
    elsewhere = F.coalesce(F.array_contains(F.try_element_at(others, at), residue), F.lit(False))
    return (
        F.when((bare == "") & notation.legacy(legacy).isNotNull(), "legacy_source_notation")
        .when((bare == "") & F.contains(coding, F.lit("c.")), "cdna_only_unmatched")
        .when((bare == "") | number.isNull(), "no_notation_suspect")
        .when((longest > 0) & (number > longest), "misparse_out_of_range")
        .when(strange & elsewhere, "wrong_gene_residue_mismatch")
        .when(strange & near, "residue_offset_suspect")
        .when(strange, "residue_unverified")
        .otherwise("novel_in_range")
    )


def review_overlay(reviews: DataFrame, extracted: DataFrame, known_genes: DataFrame) -> DataFrame:
    """Reviews (gene, pmid, source_notation, verdict) with their action, whether a fact of that key was extracted, and its counts.

    `extracted` has gene, pmid, key, carriers, affected, unaffected; keys are match_key() of a notation.
    """
    verdict = F.lower(F.trim(F.coalesce("verdict", F.lit(""))))
    action = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair]), verdict), F.lit("followup_other"))
    rows = reviews.withColumn("gene", F.upper(F.trim("gene"))).withColumn("pmid", counts.normal_id(F.col("pmid"))).withColumn("action", action).withColumn("verdict", verdict)
    rows = rows.withColumn("key", F.when(F.trim("source_notation") != "", notation.match_key(F.col("source_notation"))))
    rows = rows.join(extracted.withColumn("_found", F.lit(True)), ["gene", "pmid", "key"], "left").join(known_genes.select("gene", F.lit(True).alias("_known")).distinct(), "gene", "left")
    status = F.when(F.col("_known").isNull(), "no_db").when(F.col("_found"), "matched").otherwise("unmatched")
    return rows.withColumn("match_status", status).drop("_found", "_known", "key")


def distinct_links(links: DataFrame, paper: str, url: str, href: str, order: str) -> DataFrame:
    """The first link of each resolved address of a paper; one that could not be resolved goes by what it says."""
    keyed = links.withColumn("_address", F.coalesce(url, F.concat(F.lit("unresolved:"), F.col(href))))
    return relational.first_seen(keyed, [paper, "_address"], [order]).drop("_address")


def queue_export(queue: DataFrame, status: str, wanted: str, priority: str, added: str) -> DataFrame:
    """The rows of one status by priority and age, as they are written to a worksheet."""
    return queue.where(F.col(status) == wanted).orderBy(priority, added)


def ranked(rows: DataFrame, key: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Rows with their place among those of their key."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
