"""Answers of a table router, bindings of quotes, policies on genes, risk of an extraction, XML captions, bodies by selector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import counts, identity
from factloom.functions import notation as spelled
from factloom.operators.scouting import MENTION, current_study

# Fields that a router may map to columns, and what a mapping must have.
FIELDS = ("gene", "cdna", "protein", "patient_count", "affected", "unaffected", "uncertain", "phenotype", "clinical_significance")
NOTATIONS, COUNTS = ("cdna", "protein"), ("patient_count", "affected", "unaffected")


def router_tables(answers: DataFrame, key: str, answer: str) -> DataFrame:
    """Tables of a router's answer: key, table_id, mapping (field -> column), confidence.

    Fences and words about the JSON are passed over; unknown fields and columns
    that are no numbers from 0 are dropped; a table without a notation and a
    count column is none.
    """
    form = "struct<variant_tables:array<struct<table_id:string,column_mapping:map<string,string>,confidence:string>>>"
    read = answers.select(key, F.from_json(identity.answer_object(F.col(answer)), form).alias("_a")).select(key, F.explode("_a.variant_tables").alias("t"))
    clean = F.transform_values(F.map_filter("t.column_mapping", lambda k, v: k.isin(*FIELDS) & F.coalesce(v.try_cast("int") >= 0, F.lit(False))), lambda k, v: v.try_cast("int"))
    out = read.select(key, F.col("t.table_id").alias("table_id"), clean.alias("mapping"), F.col("t.confidence").alias("confidence"))
    has = lambda names: F.arrays_overlap(F.map_keys("mapping"), F.array(*map(F.lit, names)))
    return out.where((F.coalesce("table_id", F.lit("")) != "") & has(NOTATIONS) & has(COUNTS))


def mapped_facts(tables: DataFrame, routed: DataFrame, key: list[str], gene: str) -> DataFrame:
    """Rows of routed tables read by their mapping: key, table_no, variant, carriers, affected, unaffected; rows of other genes are left out."""
    rows = tables.join(routed.select(*key, F.col("table_id").cast("int").alias("table_no"), "mapping"), [*key, "table_no"]).select(*key, "table_no", "mapping", F.explode("rows").alias("_r"))
    cell = lambda name: F.nullif(F.trim(F.try_element_at("_r", F.try_element_at("mapping", F.lit(name)) + 1)), F.lit(""))
    named = F.coalesce(spelled.short_protein(cell("protein")), spelled.cdna(cell("cdna")))
    facts = rows.select(*key, "table_no", cell("gene").alias("_g"), named.alias("variant"), *[counts.first_int(cell(c)).alias(n) for c, n in (("patient_count", "carriers"), ("affected", "affected"), ("unaffected", "unaffected"))])
    good = facts.where(F.col("variant").isNotNull() & (F.col("_g").isNull() | F.contains(F.upper("_g"), F.lit(gene.upper()))))
    return good.groupBy(*key, "table_no", "variant").agg(*[F.sum(c).cast("long").alias(c) for c in ("carriers", "affected", "unaffected")])


def quote_binds(quote: Column, variant: Column, gene: str, others: tuple[str, ...], value: Column) -> Column:
    """Whether a quote is about the variant: every change it names is the variant, or it names the variant and all its changes stand at its position, or it says "none of these variants" of a zero; never if it names another gene alone."""
    said = F.array_distinct(F.transform(F.regexp_extract_all(quote, F.lit(MENTION), F.lit(0)), lambda m: spelled.match_key(m)))
    key = spelled.match_key(variant)
    exact = F.contains(F.lower(quote), F.lower(variant))
    elsewhere = quote.rlike(r"\b(" + "|".join(others) + r")\b") & ~F.contains(F.upper(quote), F.lit(gene.upper())) if others else F.lit(False)
    number = lambda c: F.regexp_extract(c, r"\d+", 0)
    same_place = F.forall(said, lambda m: number(m) == number(key))
    none_of = (value == 0) & quote.rlike(r"(?i)\b(none|no)\b.*\b(these|the)\s+variants?\b|\b(these|the)\s+variants?\b.*\b(none|no)\b")
    bound = F.when(F.size(said) <= 0, exact).otherwise(F.forall(said, lambda m: m == key) | (exact & same_place) | (none_of & F.array_contains(said, key)))
    return F.coalesce(bound & ~elsewhere, F.lit(False))


def gene_policy(rows: DataFrame, support: Column, policy: str = "flag") -> DataFrame:
    """Rows with how well they belong to the target gene; clear leaves out those off target, off changes nothing."""
    if policy not in ("off", "flag", "clear"):
        raise ValueError(f"unknown policy {policy!r}")
    if policy == "off":
        return rows
    out = rows.withColumn("specificity", support)
    return out.where(F.coalesce(F.col("specificity") != "off_target", F.lit(True))) if policy == "clear" else out


def quarantine_classes(facts: DataFrame, label: Column, classes: tuple[str, ...] = ("misparse_out_of_range",)) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined) facts by their class; only the classes given are taken out."""
    marked = facts.withColumn("class", label)
    bad = F.coalesce(F.col("class").isin(*classes), F.lit(False))
    return marked.where(~bad), marked.where(bad)


def merge_candidates(candidates: DataFrame, paper: str, gene: str, genes: tuple[str, ...], order: str, cap: int) -> tuple[DataFrame, DataFrame]:
    """(candidates to merge, counts per paper): those of the current study, each change once, the first `cap` of a paper; counts say how many there were, were eligible and were left over."""
    judged = current_study(candidates, gene, genes, "caption", "source", "gene")
    once = judged.where("skipped is null").groupBy(paper, "variant").agg(F.min(order).alias("_o"))
    from pyspark.sql import Window

    ranked = once.withColumn("_r", F.row_number().over(Window.partitionBy(paper).orderBy("_o", "variant")))
    selected = candidates.join(ranked.where(F.col("_r") <= cap).select(paper, "variant", F.col("_o").alias(order)), [paper, "variant", order], "left_semi")
    n = judged.groupBy(paper).agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("skipped").isNull()).alias("eligible"))
    left = ranked.groupBy(paper).agg(F.count_if(F.col("_r") > cap).alias("overflow"))
    return selected, n.join(left, paper, "left").withColumn("overflow", F.coalesce("overflow", F.lit(0)))


def extraction_risk(found: Column, estimated: Column, scanned: Column, text: Column) -> Column:
    """(points, reasons): few variants against a table's size or a scan, and tables named that the text does not have."""
    few = lambda expected, share: found < F.greatest(F.lit(2), F.floor(expected / share))
    rules = [("low_yield_vs_tables", (estimated >= 8) & few(estimated, 4), 2), ("low_yield_vs_scan", (scanned >= 5) & few(scanned, 2), 1), ("tables_without_bodies", text.rlike(r"(?i)\btable\s+\d") & ~F.contains(text, F.lit("|")), 1)]
    hit = [F.coalesce(test, F.lit(False)) for _, test, _ in rules]
    points = sum((F.when(h, n).otherwise(0) for h, (_, _, n) in zip(hit, rules, strict=True)), F.lit(0))
    return F.struct(points.alias("points"), F.array_compact(F.array(*[F.when(h, name) for h, (name, _, _) in zip(hit, rules, strict=True)])).alias("reasons"))


def xml_captions(articles: DataFrame, id_col: str, xml_col: str) -> DataFrame:
    """Figures, tables and supplements of article XML with label and caption, in order."""
    whole = F.regexp_extract_all(xml_col, F.lit(r"(?s)<(?:fig|table-wrap|supplementary-material)\b.*?</(?:fig|table-wrap|supplementary-material)>"), F.lit(0))
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))
    kind = F.regexp_extract("_x", r"^<([a-z-]+)", 1)
    said = articles.select(id_col, F.posexplode(whole).alias("place", "_x"))
    return said.select(id_col, "place", F.when(kind == "fig", "figure").when(kind == "table-wrap", "table").otherwise("supplement").alias("kind"), plain(F.regexp_extract("_x", r"(?s)<label>(.*?)</label>", 1)).alias("label"), plain(F.regexp_extract("_x", r"(?s)<caption\b[^>]*>(.*?)</caption>", 1)).alias("caption"), F.nullif(F.regexp_extract("_x", r'href="([^"]*)"', 1), F.lit("")).alias("href"))


def report_text(zones: DataFrame, id_col: str, place: str, score: str, text: str) -> DataFrame:
    """The zones of a document as one text, in order, each under its number and score."""
    line = F.concat(F.lit("## Zone "), F.col(place).cast("string"), F.lit(" (score "), F.format_number(F.col(score), 2), F.lit(")\n\n"), F.col(text))
    return zones.groupBy(id_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), line.alias("t")))), lambda x: x["t"]), "\n\n").alias("report"))
