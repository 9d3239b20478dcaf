"""Registered queries of the evidence operators on the driver tables, each with the SQL that gives the same rows.

Stand-ins: paper = order or supplier, variant = part, fact = line item. The
tables hold no nulls and no large counts, so counts are derived with both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import counts, links, text
from factloom.operators import relational, scoring, shared, trust
from factloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# Expressions that both engines read alike.
FACTS = {
    "paper": "l_orderkey",
    "variant": "l_partkey",
    "supplier": "l_suppkey",
    "line": "l_linenumber",
    "carriers": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(floor(l_extendedprice / 200) AS INT) END",
    "affected": "CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE CAST(floor(l_quantity) AS INT) END",
    "unaffected": "CASE WHEN l_linenumber % 5 = 0 THEN 0 WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(floor(l_tax * 100) AS INT) END",
    "uncertain": "CASE WHEN l_linenumber % 2 = 1 THEN CAST(floor(l_discount * 100) AS INT) END",
    "layer": "CASE l_returnflag WHEN 'A' THEN 'llm_table' WHEN 'N' THEN 'llm_text' ELSE 'figure' END",
    "study_design": "CASE l_suppkey % 7 WHEN 0 THEN 'gwas' WHEN 1 THEN 'case_control' WHEN 2 THEN 'review_meta' WHEN 3 THEN 'cohort_biobank' ELSE 'case_series' END",
    "carriers_count_type": "CASE l_partkey % 9 WHEN 0 THEN 'cohort_total' WHEN 1 THEN 'family_count' ELSE 'per_variant_carrier' END",
    "carriers_column_label": "CASE l_partkey % 11 WHEN 0 THEN 'gnomAD allele count' WHEN 1 THEN 'Patient No.' ELSE 'carriers' END",
}
FACTS_SQL = "SELECT " + ", ".join(f"{e} AS {a}" for a, e in FACTS.items()) + " FROM lineitem"

#: Reference set and extraction: lines of the first five and the last four numbers, keyed by supplier and part.
_SIDE = "SELECT supplier, variant, CAST(sum(carriers) AS BIGINT) AS carriers, CAST(sum(affected) AS BIGINT) AS affected, CAST(sum(unaffected) AS BIGINT) AS unaffected, CASE WHEN count(DISTINCT layer) > 1 THEN 'mixed' ELSE min(layer) END AS layer FROM facts WHERE {} GROUP BY 1, 2"
COMPARED_SQL = f"""facts AS ({FACTS_SQL}),
gold AS ({_SIDE.format("line <= 4 AND supplier % 3 <> 0")}),
found AS ({_SIDE.format("line >= 3")}),
compared AS (
  SELECT supplier, variant, g.carriers AS gold_carriers, g.affected AS gold_affected, g.unaffected AS gold_unaffected,
    d.carriers AS found_carriers, d.affected AS found_affected, d.unaffected AS found_unaffected, d.layer,
    g.g IS NOT NULL AS in_gold, d.d IS NOT NULL AS in_found, g.g IS NOT NULL AND d.d IS NOT NULL AS match
  FROM (SELECT *, 1 AS g FROM gold) g FULL OUTER JOIN (SELECT *, 1 AS d FROM found) d USING (supplier, variant))"""


def facts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {a}" for a, e in FACTS.items()])


def compared(spark: SparkSession, sf: str) -> DataFrame:
    rows = shared.dealt(facts(spark, sf), "supplier", "variant")
    gold = scoring.aggregate_counts(rows.where("line <= 4 AND supplier % 3 <> 0"), ["supplier", "variant"], layer="layer")
    found = scoring.aggregate_counts(rows.where("line >= 3"), ["supplier", "variant"], layer="layer")
    return scoring.compare(gold.drop("layer"), found, ["supplier", "variant"])


_TRUST_SQL = f"""facts AS ({FACTS_SQL}),
stats AS (SELECT paper, median(carriers) AS m, count(carriers) AS n FROM facts GROUP BY 1),
coded AS (
  SELECT f.*, list_sort(list_filter([
    CASE WHEN (carriers IS NOT NULL AND (affected IS NOT NULL OR unaffected IS NOT NULL) AND (coalesce(affected,0)+coalesce(unaffected,0)+coalesce(uncertain,0) > carriers
      OR (affected IS NOT NULL AND unaffected IS NOT NULL AND uncertain IS NOT NULL AND affected+unaffected+uncertain <> carriers))) THEN 'arith_inconsistent' END,
    CASE WHEN unaffected = 0 AND carriers > 0 AND affected = carriers AND study_design IN ('cohort_population','cohort_biobank','case_control','family_segregation') THEN 'implied_unaffected_zero' END,
    CASE WHEN carriers_count_type = 'cohort_total' THEN 'count_is_total' END,
    CASE WHEN carriers_count_type = 'family_count' THEN 'family_count_not_carrier' END,
    CASE WHEN carriers_column_label LIKE 'gnomAD%' OR carriers > 100000 OR (study_design IN ('cohort_population','cohort_biobank','gwas') AND carriers >= 50) THEN 'population_count' END,
    CASE WHEN study_design IN ('review_meta','functional_invitro','gwas') AND coalesce(greatest(carriers, affected, unaffected), 0) > 0 THEN 'study_type_mismatch' END,
    CASE WHEN n >= 3 AND m > 0 AND carriers > m * 10 AND carriers > 50 THEN 'paper_outlier' END
  ], lambda x: x IS NOT NULL)) AS reasons FROM facts f JOIN stats USING (paper))"""


@query(f"WITH {_TRUST_SQL} SELECT study_design, CASE WHEN len(reasons) > 0 THEN 'quarantine' ELSE 'trusted' END AS trust_tier, array_to_string(reasons, ',') AS reasons, count(*) AS n, CAST(sum(carriers) AS BIGINT) AS carriers FROM coded GROUP BY ALL")
def trust_tier_facts(spark, sf):
    tiered = trust.tier(facts(spark, sf), "paper")
    return tiered.groupBy("study_design", "trust_tier", F.array_join("trust_reasons", ",").alias("reasons")).agg(F.count(F.lit(1)).alias("n"), F.sum("carriers").cast("long").alias("carriers"))


@query(f"WITH {_TRUST_SQL} SELECT 'tier' AS kind, CASE WHEN len(reasons) > 0 THEN 'quarantine' ELSE 'trusted' END AS name, count(*) AS n FROM coded GROUP BY 2 UNION ALL SELECT 'reason', r, count(*) FROM (SELECT unnest(reasons) AS r FROM coded) GROUP BY 2")
def trust_summary(spark, sf):
    return trust.summary(trust.tier(facts(spark, sf), "paper"))


@query(f"""WITH {_TRUST_SQL}, masked AS (SELECT *, list_has_any(reasons, ['arith_inconsistent','count_is_total','population_count','study_type_mismatch','paper_outlier']) AS every FROM coded)
SELECT supplier, CAST(sum(CASE WHEN NOT every AND NOT list_contains(reasons, 'family_count_not_carrier') THEN carriers END) AS BIGINT) AS carriers,
  CAST(sum(CASE WHEN NOT every THEN affected END) AS BIGINT) AS affected,
  CAST(sum(CASE WHEN NOT every AND NOT list_contains(reasons, 'implied_unaffected_zero') THEN unaffected END) AS BIGINT) AS unaffected
FROM masked GROUP BY supplier""")
def trusted_projection(spark, sf):
    seen = trust.trusted(trust.tier(facts(spark, sf), "paper"))
    return seen.groupBy("supplier").agg(*[F.sum(c).cast("long").alias(c) for c in ("carriers", "affected", "unaffected")])


_RECALL = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, CAST({a} AS BIGINT) AS matched, CAST({b} AS BIGINT) AS gold FROM compared"
    for m, a, b in (
        ("papers", "count(DISTINCT CASE WHEN match THEN supplier END)", "count(DISTINCT CASE WHEN in_gold THEN supplier END)"),
        ("rows", "count(*) FILTER (match)", "count(*) FILTER (in_gold)"),
        ("unique_variants", "count(DISTINCT CASE WHEN match THEN variant END)", "count(DISTINCT CASE WHEN in_gold THEN variant END)"),
        *((f, f"sum(CASE WHEN match AND gold_{f} IS NOT NULL AND found_{f} IS NOT NULL THEN least(gold_{f}, found_{f}) WHEN match THEN coalesce(gold_{f}, found_{f}) END)", f"sum(CASE WHEN in_gold THEN gold_{f} END)") for f in scoring.FIELDS),
    )
)


@query(f"WITH {COMPARED_SQL} SELECT *, matched / nullif(CAST(gold AS DOUBLE), 0) AS recall FROM ({_RECALL})")
def recall_summary(spark, sf):
    return scoring.recall_summary(compared(spark, sf), "supplier", "variant")


_LONG = " UNION ALL ".join(f"SELECT '{f}' AS field, supplier, variant, in_gold, match, gold_{f} AS gold, found_{f} AS found FROM compared" for f in scoring.FIELDS)


@query(f"WITH {COMPARED_SQL} SELECT field, count(*) AS n, avg(abs(found - gold)) AS mae, sqrt(avg((found - gold) * (found - gold))) AS rmse FROM ({_LONG}) WHERE match AND gold IS NOT NULL AND found IS NOT NULL GROUP BY 1")
def matched_row_error(spark, sf):
    return scoring.matched_error(compared(spark, sf))


@query(f"""WITH {COMPARED_SQL}, d AS (SELECT field, found, abs(coalesce(found, 0) - gold) AS d FROM ({_LONG}) WHERE in_gold AND gold IS NOT NULL)
SELECT field, count(*) AS n, count(*) FILTER (found IS NULL) AS n_missed, avg(d) AS mae, sqrt(avg(d * d)) AS rmse, quantile_cont(d, 0.5) AS median, quantile_cont(d, 0.95) AS p95, max(d) AS max_error FROM d GROUP BY 1""")
def end_to_end_error(spark, sf):
    return scoring.end_to_end_error(compared(spark, sf))


@query(f"""WITH {COMPARED_SQL}, own AS (SELECT *, coalesce(found_carriers, found_affected, found_unaffected) IS NOT NULL AS counted FROM compared WHERE in_found AND supplier IN (SELECT supplier FROM compared WHERE in_gold)),
sums AS (SELECT CASE WHEN grouping(layer) = 1 THEN 'ALL' ELSE layer END AS layer, count(*) FILTER (match) AS matched, count(*) FILTER (NOT match) AS extras, count(*) FILTER (NOT match AND counted) AS counted_extras FROM own GROUP BY ROLLUP (layer))
SELECT *, matched / nullif(CAST(matched + extras AS DOUBLE), 0) AS precision, matched / nullif(CAST(matched + counted_extras AS DOUBLE), 0) AS counted_precision FROM sums""")
def precision_by_layer_rollup(spark, sf):
    return scoring.precision_by_layer(compared(spark, sf), "supplier")


@query(f"WITH {COMPARED_SQL}, c AS MATERIALIZED (SELECT * FROM compared), s AS MATERIALIZED (SELECT DISTINCT supplier FROM c WHERE in_gold) SELECT supplier, variant, layer FROM c SEMI JOIN s USING (supplier) WHERE in_found AND NOT in_gold AND coalesce(found_carriers, found_affected, found_unaffected) IS NOT NULL")
def counted_extras(spark, sf):
    return scoring.counted_extras(compared(spark, sf), "supplier").select("supplier", "variant", "layer")


@query(f"""WITH {COMPARED_SQL}, parts AS (SELECT supplier % 5 AS run, supplier, count(*) FILTER (match) AS matched, count(*) FILTER (in_gold) AS gold FROM compared GROUP BY 1, 2)
SELECT run, CAST(sum(matched) AS BIGINT) AS matched, CAST(sum(gold) AS BIGINT) AS gold, sum(matched) / nullif(CAST(sum(gold) AS DOUBLE), 0) AS recall,
  CAST(CASE WHEN sum(gold) > 0 THEN greatest(ceil(sum(gold) * 0.9) - sum(matched), 0) END AS BIGINT) AS gap FROM parts GROUP BY 1""")
def micro_average_recall(spark, sf):
    parts = compared(spark, sf).groupBy((F.col("supplier") % 5).alias("run"), "supplier").agg(F.count_if("match").alias("matched"), F.count_if("in_gold").alias("gold"))
    return scoring.pooled_recall(parts, ["run"]).withColumn("gap", counts.target_gap(F.col("matched"), F.col("gold"), 0.9).cast("long"))


@query(f"""WITH {COMPARED_SQL}, parts AS (SELECT field, supplier, count(*) AS n, avg(abs(found - gold)) AS mae, sqrt(avg((found - gold) * (found - gold))) AS rmse, max(abs(found - gold)) AS max_error
  FROM ({_LONG}) WHERE match AND gold IS NOT NULL AND found IS NOT NULL GROUP BY 1, 2)
SELECT field, CAST(sum(n) AS BIGINT) AS n, sum(coalesce(mae, 0) * n) / nullif(sum(n), 0) AS mae, sqrt(sum(coalesce(rmse * rmse, 0) * n) / nullif(sum(n), 0)) AS rmse, max(max_error) AS max_error, CAST(NULL AS DOUBLE) AS median FROM parts GROUP BY 1""")
def weighted_mae_rmse(spark, sf):
    rows = scoring._errors(compared(spark, sf).where("match"), scoring.FIELDS, ["supplier"]).where("gold is not null and found is not null").withColumn("d", F.abs(F.col("found") - F.col("gold")))
    parts = rows.groupBy("field", "supplier").agg(F.count(F.lit(1)).alias("n"), F.avg("d").alias("mae"), F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rmse"), F.max("d").alias("max_error"))
    return scoring.pooled_error(parts, ["field"])


@query(f"WITH {COMPARED_SQL} SELECT s.stratum, count(*) FILTER (in_gold) AS gold, count(*) FILTER (match) AS matched FROM compared, (SELECT unnest(['ALL', 'complete', 'incomplete']) AS stratum) s WHERE s.stratum = 'ALL' OR s.stratum = CASE WHEN supplier % 4 = 0 THEN 'incomplete' ELSE 'complete' END GROUP BY 1")
def stratified_recall(spark, sf):
    rows = compared(spark, sf).withColumn("completeness", F.when(F.col("supplier") % 4 == 0, "incomplete").otherwise("complete"))
    return scoring.stratified(rows, "completeness").groupBy("stratum").agg(F.count_if("in_gold").alias("gold"), F.count_if("match").alias("matched"))


@query("""WITH s AS (SELECT l.quality, count(*) AS n, count(*) FILTER (l.toxic = 1) AS k FROM labels l GROUP BY 1), p AS (SELECT *, k / CAST(n AS DOUBLE) AS p FROM s)
SELECT quality, n, k, greatest((p + 3.8416 / (2 * n)) / (1 + 3.8416 / n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4.0 * n * n)) / (1 + 3.8416 / n), 0) AS low,
  least((p + 3.8416 / (2 * n)) / (1 + 3.8416 / n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4.0 * n * n)) / (1 + 3.8416 / n), 1) AS high,
  CASE WHEN 4 * p + 0.5 = 0 THEN NULL ELSE 5 * p * 0.5 / (4 * p + 0.5) END AS f2 FROM p""")
def wilson_and_fbeta(spark, sf):
    s = table(spark, sf, "labels").groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") == 1).alias("k"))
    low, high = counts.wilson(F.col("k"), F.col("n"))
    return s.select("quality", "n", "k", low.alias("low"), high.alias("high"), counts.f_beta(counts.ratio(F.col("k"), F.col("n")), F.lit(0.5)).alias("f2"))


@query(f"""WITH facts AS ({FACTS_SQL}), s AS (SELECT paper, median(CASE WHEN carriers > 0 THEN carriers END) AS m, count(CASE WHEN carriers > 0 THEN 1 END) AS n FROM facts GROUP BY 1)
SELECT f.layer, count(*) FILTER (n >= 4 AND carriers > 50 AND carriers >= 10 * m) AS outliers, CAST(sum(CASE WHEN n >= 4 AND carriers > 50 AND carriers >= 10 * m THEN NULL ELSE carriers END) AS BIGINT) AS carriers FROM facts f JOIN s USING (paper) GROUP BY 1""")
def outlier_guard(spark, sf):
    kept = trust.outlier_guard(facts(spark, sf), "paper", policy="clear")
    return kept.groupBy("layer").agg(F.count_if("outlier").alias("outliers"), F.sum("carriers").cast("long").alias("carriers"))


@query(f"""WITH facts AS ({FACTS_SQL}), g AS (SELECT supplier, affected, unaffected, count(*) AS n FROM facts GROUP BY 1, 2, 3)
SELECT supplier, CAST(sum(n) AS BIGINT) AS n, CAST(sum(CASE WHEN n >= 3 AND affected >= 10 AND affected >= 2 * n THEN n ELSE 0 END) AS BIGINT) AS suppressed FROM g GROUP BY 1""")
def repeated_value_suppression(spark, sf):
    out = trust.suppress_repeats(facts(spark, sf), "supplier", ("affected", "unaffected"))
    return out.groupBy("supplier").agg(F.count(F.lit(1)).alias("n"), F.count_if("suppressed").alias("suppressed"))


@query(f"WITH facts AS ({FACTS_SQL}) SELECT layer, count(*) FILTER (carriers > 400) AS held, CAST(sum(CASE WHEN carriers > 400 THEN NULL ELSE carriers END) AS BIGINT) AS carriers, CAST(sum(CASE WHEN carriers > 400 THEN NULL ELSE affected END) AS BIGINT) AS affected FROM facts GROUP BY 1")
def carrier_guard(spark, sf):
    kept, held = trust.carrier_guard(facts(spark, sf), 400)
    sums = kept.groupBy("layer").agg(F.sum("carriers").cast("long").alias("carriers"), F.sum("affected").cast("long").alias("affected"))
    return sums.join(held.groupBy("layer").agg(F.count(F.lit(1)).alias("held")), "layer", "left").select("layer", F.coalesce("held", F.lit(0)).cast("long").alias("held"), "carriers", "affected")


@query(f"""WITH facts AS ({FACTS_SQL}), r AS (SELECT layer, CASE WHEN carriers IS NULL THEN NULL WHEN carriers_column_label = 'Patient No.' THEN 'column label looks like row identifier'
  WHEN carriers_column_label LIKE 'gnomAD%' THEN 'column label looks like population allele frequency/count' WHEN carriers_count_type <> 'per_variant_carrier' THEN 'declared count type ' || carriers_count_type END AS reason FROM facts)
SELECT layer, reason, count(*) AS n FROM r GROUP BY 1, 2""")
def count_classifier(spark, sf):
    reason = trust.misclassified(F.col("carriers"), F.col("carriers_count_type"), F.col("carriers_column_label"))
    return facts(spark, sf).groupBy("layer", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH facts AS ({FACTS_SQL}), c AS (SELECT *, affected IS NOT NULL AND carriers IS NOT NULL AND affected = carriers AND coalesce(unaffected, 0) = 0 AS copied, layer = 'figure' AS fig FROM facts),
a AS (SELECT layer, CASE WHEN copied AND carriers >= 2 THEN 'copied_carriers_onto_affected' WHEN copied AND fig THEN 'figure_copied_phenotype'
  WHEN fig AND affected IS NOT NULL AND carriers IS NULL AND coalesce(unaffected, 0) = 0 THEN 'figure_incomplete_phenotype' WHEN affected + unaffected <> carriers THEN 'partition_does_not_close' WHEN affected = 0 THEN 'unsourced_zero_affected' END AS reason FROM c)
SELECT layer, reason, count(*) AS n FROM a WHERE reason IS NOT NULL GROUP BY 1, 2""")
def phenotype_guard(spark, sf):
    no = F.lit(False)
    clears = trust.phenotype_clears(F.col("carriers"), F.col("affected"), F.col("unaffected"), F.col("layer") == "figure", no, no)
    return facts(spark, sf).select("layer", F.explode(clears).alias("c")).where("c.field = 'affected'").groupBy("layer", F.col("c.reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linenumber = 1 UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'),
a AS (SELECT l_orderkey AS k, CAST(sum(CASE WHEN l_quantity > 25 THEN l_quantity END) AS BIGINT) AS c FROM lineitem WHERE l_linenumber = 1 GROUP BY 1), b AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS c FROM orders WHERE o_orderstatus = 'F')
SELECT s.k AS paper, coalesce(a.c, b.c) AS carriers FROM s LEFT JOIN a USING (k) LEFT JOIN b USING (k)""")
def link_union_precedence(spark, sf):
    line = table(spark, sf, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("paper")).agg(F.sum(F.when(F.col("l_quantity") > 25, F.col("l_quantity"))).cast("long").alias("carriers"))
    order = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("paper"), F.floor("o_totalprice").alias("carriers"))
    return relational.with_precedence(relational.link_spine([line, order], ["paper"]), [line, order], ["paper"], ["carriers"])


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def latest_row_per_key(spark, sf):
    return relational.latest(table(spark, sf, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], "event_id")


@query("SELECT event_type, user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS r FROM events) WHERE r = 1")
def first_seen_dedup(spark, sf):
    return relational.first_seen(table(spark, sf, "events").select("event_type", "user_id", "event_id", "value"), ["event_type", "user_id"], ["event_id"])


@query(f"WITH facts AS ({FACTS_SQL}), g AS (SELECT paper, variant, count(carriers) AS c, count(affected) AS a FROM facts GROUP BY 1, 2) SELECT paper, variant, CASE WHEN c = 0 AND a = 0 THEN 'carriers,affected' WHEN c = 0 THEN 'carriers' ELSE 'affected' END AS missing FROM g WHERE c = 0 OR a = 0")
def count_gaps(spark, sf):
    return relational.count_gaps(facts(spark, sf), ["paper", "variant"], ["carriers", "affected"]).select("paper", "variant", F.array_join("missing", ",").alias("missing"))


@query("""SELECT 'both' AS part, count(*) AS n FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)
UNION ALL SELECT 'unlabelled', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
UNION ALL SELECT 'labelled_good', count(*) FROM (SELECT doc_id FROM labels WHERE quality = 1 INTERSECT SELECT doc_id FROM documents)""")
def funnel_set_ops(spark, sf):
    d, lab = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels")
    sizes = [("both", d.intersect(lab.select("doc_id"))), ("unlabelled", d.subtract(lab.select("doc_id"))), ("labelled_good", lab.where("quality = 1").select("doc_id").intersect(d))]
    out = None
    for name, rows in sizes:
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY ALL HAVING true")
def exact_duplicate_collapse(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_linenumber")
    return relational.collapse_duplicates(rows, ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity"], "l_linenumber")[0]


_SCORE = "least(length(text) // 100, 40) + CASE WHEN text LIKE '%token%' THEN 10 ELSE 0 END + least(length(text) - length(replace(text, '|', '')), 20)"


@query(f"SELECT doc_id, score, r AS rank, r BETWEEN 6 AND 25 AS selected FROM (SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, n_chars DESC, doc_id) AS r FROM (SELECT doc_id, n_chars, {_SCORE} AS score FROM documents))")
def rank_candidates(spark, sf):
    d = table(spark, sf, "documents")
    score = F.least(F.floor(F.length("text") / 100), F.lit(40)) + F.when(F.contains("text", F.lit("token")), 10).otherwise(0) + F.least(F.regexp_count("text", F.lit(r"\|")), F.lit(20))
    out = relational.prioritise(d.select("doc_id", "n_chars", score.cast("long").alias("score")), "score", [F.col("n_chars").desc(), F.col("doc_id")], 20, 5)
    return out.select("doc_id", "score", "rank", "selected")


@query("SELECT doc_id, CASE WHEN length(text) < 200 THEN 'empty' WHEN length(text) < 3000 THEN 'abstract_only' WHEN len(regexp_extract_all(text, '<[^>]+>')) / greatest(length(trim(regexp_replace(text, '<[^>]+>', '', 'g'))), 1) > 0.1 THEN 'garbled_xml' WHEN len(regexp_extract_all(text, '(?i)(introduction|methods|results|discussion|conclusion|background|patients)')) >= 3 THEN 'full_text' WHEN length(text) > 10000 THEN 'content_no_sections' ELSE 'partial' END AS class FROM documents")
def text_class(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.text_class(F.col("text")).alias("class"))


_WORDS = ("pathetic", "license", "token", "disgusting", "version", "licensed")


@query(f"""WITH h AS (SELECT doc_id, len(list_distinct(regexp_extract_all(lower(text), '\\b({"|".join(_WORDS)})\\b', 1))) AS hits FROM documents)
SELECT doc_id, CASE WHEN hits >= 2 THEN 'PASS' ELSE 'FAIL' END AS decision, hits, least(hits / 10.0, 1.0) AS confidence FROM h""")
def keyword_filter(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.keyword_filter(F.col("text"), _WORDS).alias("f")).select("doc_id", "f.*")


@query("""WITH l AS (SELECT doc_id, trim(x, ' ') AS s FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents)),
u AS (SELECT doc_id, s, count(*) AS n FROM l WHERE length(s) >= 20 AND NOT regexp_full_match(s, '[\\s|:\\-]+') AND (NOT starts_with(s, '|') OR len(list_filter(string_split(trim(s, '|'), '|'), lambda c: trim(c) NOT IN ('', '---', '-'))) >= 2) GROUP BY 1, 2)
SELECT d.doc_id, CAST(coalesce(max(n), 0) AS INT) AS repeats FROM documents d LEFT JOIN u USING (doc_id) GROUP BY 1""")
def repeated_line_padding(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.worst_repeat(F.col("text")).alias("repeats"))


@query("""WITH e AS (SELECT user_id, event_id AS s, event_id + CAST(round(value) AS BIGINT) AS e FROM events),
m AS (SELECT *, CASE WHEN max(e) OVER w IS NULL OR s > max(e) OVER w + 100 THEN 1 ELSE 0 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT user_id, CAST(island AS BIGINT) AS island, min(s) AS s, max(e) AS e, count(*) AS n FROM g GROUP BY 1, 2""")
def interval_coalesce(spark, sf):
    rows = table(spark, sf, "events").selectExpr("user_id", "event_id AS s", "event_id + CAST(round(value) AS BIGINT) AS e")
    return relational.coalesce_intervals(rows, ["user_id"], "s", "e", 100)


@query("SELECT conv_id, turn, string_agg(text, chr(10) ORDER BY turn) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS context FROM conversations")
def context_window(spark, sf):
    return relational.context_window(table(spark, sf, "conversations"), ["conv_id"], "turn", "text").select("conv_id", "turn", "context")


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM conversations")
def nearest_header(spark, sf):
    return relational.nearest_before(table(spark, sf, "conversations"), ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("turn"))).select("conv_id", "turn", "section")


@query("SELECT user_id, count(*) AS n, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 END) AS BIGINT) AS purchases, CAST(sum(CASE WHEN event_type = 'error' THEN 1 END) AS BIGINT) AS errors FROM events GROUP BY 1")
def conditional_counts(spark, sf):
    some = lambda t: F.sum(F.when(F.col("event_type") == t, 1))
    return table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), some("purchase").alias("purchases"), some("error").alias("errors"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM events GROUP BY 1")
def distinct_concat(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"))


@query("SELECT doc_id FROM documents WHERE CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 1000")
def stable_hash_sample(spark, sf):
    return table(spark, sf, "documents").where(counts.stable_sample(F.col("doc_id"), 0.1)).select("doc_id")


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 5 AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_field_trust(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", (F.get_json_object("props", "$.k").cast("long") % 5).alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, link FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*\"([^\"]*)\"', 1)) AS link FROM pages)")
def html_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.explode(links.hrefs(F.col("html"))).alias("link"))


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_anti_join(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new, event_id FROM events),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM e) SELECT user_id, min(ts) AS start_ts, count(*) AS n FROM g GROUP BY user_id, s""")
def session_activity(spark, sf):
    w = F.session_window("ts", "6 hours").alias("w")
    return table(spark, sf, "events").groupBy("user_id", w).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start_ts"), "n")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start_ts, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_rate(spark, sf):
    return table(spark, sf, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start_ts"), "event_type", "n")


_STORED = "SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS brand, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END AS size FROM part WHERE p_partkey % 2 = 0"
_INCOMING = "SELECT p_partkey AS k, p_brand AS brand, p_size AS size FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 2 = 1"


@query(f"WITH s AS ({_STORED}), i AS ({_INCOMING}) SELECT coalesce(s.k, i.k) AS k, coalesce(s.brand, i.brand) AS brand, coalesce(s.size, i.size) AS size, CASE WHEN s.k IS NULL THEN 'added' WHEN i.k IS NULL THEN 'kept' ELSE 'updated' END AS action FROM s FULL OUTER JOIN i ON s.k = i.k")
def upsert_identity(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    stored = p.where("k % 2 = 0").withColumn("brand", F.when(F.col("k") % 4 != 0, F.col("brand"))).withColumn("size", F.when(F.col("k") % 3 != 0, F.col("size")))
    return relational.upsert(stored, p.where("k % 3 = 0 OR k % 2 = 1"), ["k"], ["brand", "size"])


@query("SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS flag, CASE WHEN grouping(l_linestatus) = 1 THEN 'ALL' ELSE l_linestatus END AS status, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def stratified_cube(spark, sf):
    name = lambda c: F.when(F.grouping(c) == 1, "ALL").otherwise(F.col(c))
    sums = table(spark, sf, "lineitem").cube("l_returnflag", "l_linestatus").agg(name("l_returnflag").alias("flag"), name("l_linestatus").alias("status"), F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))
    return sums.select("flag", "status", "n", "quantity")


@query("""WITH b AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 <> 0), a AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 5 = 0)
SELECT coalesce(b.k, a.k) AS k, CASE WHEN b.k IS NULL THEN 'added' WHEN a.k IS NULL THEN 'removed' WHEN a.s = b.s THEN 'same' ELSE 'updated' END AS change FROM b FULL OUTER JOIN a ON a.k = b.k""")
def scd_diff(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    after = o.where("k % 3 <> 0 OR k % 5 = 0").withColumn("s", F.when(F.col("k") % 7 == 0, "X").otherwise(F.col("s")))
    return relational.snapshot_diff(o.where("k % 5 <> 0"), after, ["k"], ["s"])


@query("""WITH g AS (SELECT l_orderkey AS k, count(DISTINCT l_returnflag) AS a, count(DISTINCT l_linestatus) AS b FROM lineitem GROUP BY 1)
SELECT k, max(l_returnflag) AS flag, max(l_linestatus) AS status FROM g JOIN lineitem ON l_orderkey = k WHERE a <= 1 AND b <= 1 GROUP BY 1 UNION ALL SELECT k, l_returnflag, l_linestatus FROM g JOIN lineitem ON l_orderkey = k WHERE a > 1 OR b > 1""")
def complementary_merge(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
    return relational.complementary_merge(rows, ["k"], ["flag", "status"])


@query("SELECT p_brand AS brand, avg(l_quantity) AS mean, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 HAVING count(*) >= 5 ORDER BY total DESC, brand LIMIT 10")
def having_topk(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_quantity").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand")), "l_partkey")
    sums = rows.groupBy("brand").agg(F.avg("l_quantity").alias("mean"), F.sum("l_quantity").cast("long").alias("total"), F.count(F.lit(1)).alias("n"))
    return sums.where("n >= 5").orderBy(F.desc("total"), "brand").limit(10).drop("n")


@query("SELECT l_returnflag AS layer, 'quantity' AS metric, sum(l_quantity) AS value FROM lineitem GROUP BY 1 UNION ALL SELECT l_returnflag, 'lines', count(*) FROM lineitem GROUP BY 1 UNION ALL SELECT l_returnflag, 'papers', count(DISTINCT l_orderkey) FROM lineitem GROUP BY 1")
def tidy_metrics_unpivot(spark, sf):
    wide = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("layer")).agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).cast("double").alias("lines"), F.count_distinct("l_orderkey").cast("double").alias("papers"))
    return wide.unpivot(["layer"], ["quantity", "lines", "papers"], "metric", "value")


@query("SELECT l_orderkey AS paper, l_partkey AS variant, l_linenumber AS line, l_suppkey AS supplier, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey, l_linenumber, l_suppkey, l_extendedprice) AS r FROM lineitem) WHERE r <= 2")
def top_facts_per_paper(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey AS paper", "l_partkey AS variant", "l_linenumber AS line", "l_suppkey AS supplier", "l_quantity", "l_extendedprice")
    return trust.rank_facts(rows, "paper", F.col("l_quantity"), ["variant", "line", "supplier", "l_extendedprice"], 2).drop("l_quantity", "l_extendedprice")


@query("""WITH t AS (SELECT o_orderpriority AS priority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1)
SELECT priority, CASE WHEN greatest(f / n, p / n) >= 0.35 THEN 'needs attention' WHEN greatest(f / n, p / n) >= 0.15 THEN 'watch' ELSE 'healthy' END AS band FROM t""")
def health_bands(spark, sf):
    t = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") == "P").alias("p"))
    return t.select("priority", scoring.health_band(counts.ratio(F.col("f"), F.col("n")), counts.ratio(F.col("p"), F.col("n"))).alias("band"))
