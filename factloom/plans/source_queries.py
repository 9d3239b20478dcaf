"""Registered queries of scans, sinks and gates that read what Spark has written from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from factloom.functions import text
from factloom.operators import guards
from factloom.operators.shared import folder_of
from factloom.plans.queries import query
from factloom.session import table
from factloom.sources import reports, tables
from factloom.streaming import incremental


def _scratch(spark) -> str:
    return f"{folder_of(spark)}/made-{uuid.uuid4().hex}"


@query("SELECT DISTINCT CAST(k AS VARCHAR) AS pmid FROM (SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey * 3 FROM supplier UNION ALL SELECT o_custkey + 5 FROM orders)")
def merged_ids(spark, sf):
    sources = [("customer", "c_custkey"), ("supplier", "s_suppkey * 3"), ("orders", "o_custkey + 5")]
    return tables.merge_ids([table(spark, sf, t).selectExpr(f"{e} AS pmid") for t, e in sources], "pmid")


@query("""SELECT CAST(10000000 + p_partkey AS VARCHAR) AS pmid, 'A' || p_partkey || 'V' AS variant, CASE WHEN p_size % 3 > 0 THEN p_size END AS carriers, CASE WHEN p_size % 5 > 0 THEN p_size % 5 END AS affected, p_size % 2 AS unaffected FROM part""")
def curated_table(spark, sf):
    """A CSV whose columns have other names: ids that came as 1.0, counts that are blank."""
    place = _scratch(spark)
    rows = table(spark, sf, "part").selectExpr(
        "concat(10000000 + p_partkey, '.0') AS `PubMed ID`", "concat(' A', p_partkey, 'V ') AS `Protein_Change`", "CASE WHEN p_size % 3 > 0 THEN p_size END AS `Total carriers`", "CASE WHEN p_size % 5 > 0 THEN p_size % 5 END AS `Symptomatic`", "p_size % 2 AS `Un-affected`"
    )
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(place)
    return tables.reference_table(spark, place).select("pmid", "variant", "carriers", "affected", "unaffected")


_PAPER = "CASE WHEN l_orderkey % 3 = 0 THEN 'about ' || CAST(l_quantity AS INT) ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END"


@query(f"SELECT CAST(l_orderkey AS VARCHAR) AS pmid, l_linenumber AS line, 'A' || l_partkey || 'V' AS protein_notation, CAST(l_quantity AS INT) AS carriers, CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END AS affected FROM lineitem")
def flattened_extractions(spark, sf):
    """The variants of extraction documents, one for each order; counts are told in words in some."""
    lines = table(spark, sf, "lineitem")
    variant = F.struct(
        F.lit("GENE1").alias("gene_symbol"), F.concat(F.lit(" A"), "l_partkey", F.lit("V")).alias("protein_notation"), F.concat(F.lit("line "), "l_linenumber").alias("source_location"),
        F.struct(F.expr(_PAPER.replace("VARCHAR", "STRING")).alias("total_carriers_observed"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber").cast("string")).alias("affected_count")).alias("penetrance_data"),
    )
    written = lines.groupBy("l_orderkey").agg(F.to_json(F.struct(F.struct(F.col("l_orderkey").cast("string").alias("pmid")).alias("paper_metadata"), F.collect_list(variant).alias("variants"))).alias("json"))
    form = " ".join(tables.EXTRACTION.split())
    documents = written.select(F.lit("0").alias("file_id"), F.from_json("json", form, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("d")).select("file_id", "d.*")
    found = tables.flatten(documents)["variants"]
    return found.select("pmid", F.regexp_extract("source_location", r"\d+", 0).cast("int").alias("line"), "protein_notation", "carriers", "affected")


@query("SELECT event_type AS stage, count(*) FILTER (event_id % 7 > 1) AS decisions, count(*) FILTER (event_id % 7 > 1 AND event_id % 2 = 0) AS passed FROM events GROUP BY 1 UNION ALL SELECT 'malformed', count(*), 0 FROM events WHERE event_id % 7 = 0")
def progress_log(spark, sf):
    """A log of JSON lines, some of them broken, some blank."""
    place = _scratch(spark)
    good = F.to_json(F.struct(F.col("event_id").cast("string").alias("pmid"), F.when(F.col("event_id") % 2 == 0, "PASS").otherwise("FAIL").alias("final_decision"), F.col("event_type").alias("stage")))
    line = F.when(F.col("event_id") % 7 == 0, F.concat(good, F.lit(" {"))).when(F.col("event_id") % 7 == 1, "  ").otherwise(good)
    broken = F.when(F.col("event_id") % 7 == 0, F.expr("'{\"pmid\": '")).otherwise(line)
    table(spark, sf, "events").select(broken.alias("value")).write.text(place)
    decisions, malformed = tables.progress(spark, place)
    counted = decisions.groupBy("stage").agg(F.count(F.lit(1)).alias("decisions"), F.count_if(F.col("final_decision") == "PASS").alias("passed"))
    seen = table(spark, sf, "events").select(F.col("event_type").alias("stage")).distinct().join(counted, "stage", "left").na.fill(0)
    return seen.unionByName(malformed.agg(F.count(F.lit(1)).alias("decisions")).select(F.lit("malformed").alias("stage"), "decisions", F.lit(0).cast("long").alias("passed")))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS pmid, CASE WHEN n_nationkey % 2 = 0 THEN 'second' ELSE 'first' END AS load, CAST(count(*) AS BIGINT) AS n FROM nation, region GROUP BY 1, 2")
def replaced_papers(spark, sf):
    """Partitions of papers that come again are replaced, the others stay; the second load comes twice."""
    place = _scratch(spark)
    rows = table(spark, sf, "nation").selectExpr("CAST(n_nationkey AS STRING) AS pmid", "explode(sequence(1, 5)) AS k")
    tables.overwrite_papers(rows.withColumn("load", F.lit("first")), place)
    for _ in range(2):
        tables.overwrite_papers(rows.where("pmid % 2 = 0").withColumn("load", F.lit("second")), place)
    return spark.read.parquet(place).groupBy(F.col("pmid").cast("string").alias("pmid"), "load").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT problem, count(*) AS n FROM (SELECT CASE n_nationkey % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'new' WHEN 2 THEN 'changed' END AS problem FROM nation) WHERE problem IS NOT NULL GROUP BY 1""")
def manifest_problems(spark, sf):
    """Files before and after: a file for each nation, some gone, some new, some changed."""
    place = _scratch(spark)
    rows = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("value"), (F.col("n_nationkey") % 4).alias("r"))
    rows.where("r <> 1").select("n_nationkey", "value").write.partitionBy("n_nationkey").text(f"{place}/before")
    rows.where("r <> 0").select("n_nationkey", F.when(F.col("r") == 2, F.concat("value", F.lit("!"))).otherwise(F.col("value")).alias("value")).write.partitionBy("n_nationkey").text(f"{place}/now")
    named = lambda which: tables.hash_manifest(spark, f"{place}/{which}").where("path LIKE '%.txt'").withColumn("path", F.regexp_extract("path", r"n_nationkey=(\d+)", 1))
    return tables.check_manifest(named("before"), named("now")).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_brand AS stratum, count(*) AS n_rows, count(*) FILTER (p_size % 3 = 0) AS n_differ FROM part GROUP BY 1")
def score_files(spark, sf):
    """What a comparison leaves as files, read back."""
    place = _scratch(spark)
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("stratum"), "p_size")
    reports.write_scores(rows, rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), place, F.col("p_size") % 3 == 0)
    back = lambda name: spark.read.option("header", True).csv(f"{place}/{name}.csv")
    every, differ = back("all_rows").groupBy("stratum").agg(F.count(F.lit(1)).alias("n_rows")), back("discrepancies").groupBy("stratum").agg(F.count(F.lit(1)).alias("n_differ"))
    return every.join(differ, "stratum", "left").na.fill(0, ["n_differ"])


@query("SELECT id, tier, reasons FROM (SELECT p_partkey AS id, CASE WHEN p_size % 4 = 0 AND p_size % 3 > 0 THEN 'paper_final_check:c' || p_size % 2 || CASE WHEN p_size % 5 = 0 THEN ',rule' ELSE '' END WHEN p_size % 5 = 0 THEN 'rule' ELSE '' END AS reasons, CASE WHEN (p_size % 4 = 0 AND p_size % 3 > 0) OR p_size % 5 = 0 THEN 'quarantine' ELSE 'trusted' END AS tier FROM part)")
def final_checks(spark, sf):
    """Findings that are severe, grounded and of the current source count; an older one of that kind goes."""
    p = table(spark, sf, "part")
    tiered = p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 5 == 0, F.array(F.lit("rule"), F.lit("paper_final_check:old"))).otherwise(F.array(F.lit("paper_final_check:old"))).alias("trust_reasons"))
    findings = p.select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 4 == 0, "HIGH").otherwise("medium").alias("severity"), (F.col("p_size") % 3 > 0).alias("grounded"), F.concat(F.lit("c"), F.col("p_size") % 2).alias("code"), F.lit("h").alias("source_hash"), F.lit("h").alias("current_hash"),
    )
    stale = findings.withColumn("severity", F.lit("critical")).withColumn("grounded", F.lit(True)).withColumn("current_hash", F.lit("other"))
    found = guards.compose_final_check(tiered, findings.unionByName(stale), ["id"])
    return found.select("id", F.col("trust_tier").alias("tier"), F.array_join("trust_reasons", ",").alias("reasons"))


@query("SELECT p_partkey AS id, CASE p_size % 3 WHEN 0 THEN 'match' WHEN 1 THEN CASE WHEN p_size % 2 = 0 THEN 'unknown' ELSE 'mismatch' END ELSE 'out_of_range' END AS ref_verdict FROM part WHERE NOT (p_size % 3 = 2 OR (p_size % 3 = 1 AND p_size % 2 = 1 AND p_size + 30 > 50))")
def gated_references(spark, sf):
    """Under drop, substitutions beyond the guard that disagree with the sequence go; without a sequence nothing is known."""
    at = F.col("p_size") + 30
    residue = F.when(F.col("p_size") % 3 == 0, "A").otherwise("W")
    notation = F.when(F.col("p_size") % 3 == 2, F.concat(F.lit("A"), at + 900, F.lit("V"))).otherwise(F.concat(residue, at, F.lit("V")))
    gene = F.when((F.col("p_size") % 3 == 1) & (F.col("p_size") % 2 == 0), "NONE").otherwise("GENE1")
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), gene.alias("gene_symbol"), notation.alias("protein_notation"))
    sequences = spark.createDataFrame([("GENE1", "A" * 200)], "gene string, sequence string")
    return guards.reference_gate(rows, sequences, "drop").select("id", "ref_verdict")


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 OR length(html) * 2 < 0.8 * (length(html) * CASE WHEN page_id % 2 = 0 THEN 3 ELSE 1 END) THEN 'other' ELSE 'first' END AS taken, page_id % 5 = 0 AS challenge FROM pages")
def chosen_texts(spark, sf):
    """The longer text where the first is missing or much shorter; pages that only ask for patience."""
    pages = table(spark, sf, "pages")
    first, other = F.when(F.col("page_id") % 3 > 0, F.repeat("html", F.lit(2))), F.repeat("html", F.when(F.col("page_id") % 2 == 0, 3).otherwise(1))
    taken = F.when(F.coalesce(text.better_text(first, other) == other, F.lit(False)) & F.coalesce(first != other, F.lit(True)), "other").otherwise("first")
    asking = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("<p>Checking your BROWSER"), F.col("page_id"))).otherwise(F.translate("html", "jJ", ""))
    return pages.select("page_id", taken.alias("taken"), text.challenge_page(asking).alias("challenge"))


@query("SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 3 > 0 ORDER BY o_orderpriority, o_orderkey LIMIT 50")
def pending_after_resume(spark, sf):
    """What a resumed run takes next: not done yet, waiting, by priority and age (the limit is the queue's)."""
    orders = table(spark, sf, "orders").selectExpr("o_orderkey AS k", "o_custkey AS c", "o_orderpriority AS priority", "o_orderkey AS added", "CASE o_orderstatus WHEN 'O' THEN 'pending' ELSE 'other' END AS status")
    return incremental.pending(incremental.unprocessed(orders, orders.where("c % 3 = 0"), "k"), 50).select("k")
