"""Registered queries of the gates, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import text
from factloom.operators import guards, relational, scoring
from factloom.plans.queries import FACTS_SQL, facts, query
from factloom.session import table

_PLACE = "CASE o_orderkey % 9 WHEN 0 THEN 'ClinVar record' WHEN 1 THEN 'PubTator' WHEN 2 THEN 'Figure 1' WHEN 3 THEN 'router table' WHEN 4 THEN 'text scan' WHEN 5 THEN 'Table 2' ELSE o_orderpriority END"


@query(f"""WITH p AS (SELECT o_orderstatus AS status, lower({_PLACE}) AS s FROM orders)
SELECT status, CASE WHEN s LIKE '%clinvar%' THEN 'clinvar' WHEN s LIKE '%pubtator%' THEN 'pubtator' WHEN s LIKE '%figure%' THEN 'figure' WHEN s LIKE '%router%' THEN 'regex_table' WHEN s LIKE '%text scan%' THEN 'regex_text' WHEN s LIKE '%table%' THEN 'llm_table' ELSE 'llm_text' END AS layer, count(*) AS n FROM p GROUP BY 1, 2""")
def layer_inference(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderstatus AS status", f"{_PLACE} AS place")
    return o.groupBy("status", guards.infer_layer(F.lit(None).cast("string"), F.col("place")).alias("layer")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH facts AS ({FACTS_SQL}), g AS (SELECT *, greatest(carriers, affected, unaffected, uncertain) AS m FROM facts)
SELECT layer, CAST(sum(CASE WHEN m IS NULL THEN 0 ELSE 2 + CASE layer WHEN 'figure' THEN 5 WHEN 'llm_table' THEN 2 ELSE 0 END + CASE WHEN m >= 100 THEN 4 WHEN m >= 50 THEN 3 WHEN m >= 10 THEN 1 ELSE 0 END
  + CASE WHEN affected + unaffected + coalesce(uncertain, 0) <> carriers THEN 6 ELSE 0 END + CASE WHEN carriers_count_type <> 'per_variant_carrier' THEN 6 ELSE 0 END END) AS BIGINT) AS points FROM g GROUP BY 1""")
def claim_priority(spark, sf):
    c = F.col
    points = guards.claim_score(c("layer"), c("carriers"), c("affected"), c("unaffected"), c("uncertain"), F.lit(False), c("carriers_count_type"), F.lit(None).cast("string"))
    return facts(spark, sf).groupBy("layer").agg(F.sum(points).cast("long").alias("points"))


@query("""SELECT doc_id, CASE WHEN text = '' THEN 'empty' WHEN length(text) < 500 THEN 'short' WHEN length(regexp_replace(text, '[^\\p{L}\\p{N}\\s]', '', 'g')) / length(text) < 0.5 THEN 'few letters'
WHEN regexp_matches(text, '(?i)c\\.\\d+|p\\.[A-Z]|[A-Z]\\d+[A-Z]|mutation|variant|carrier') THEN 'ok' WHEN contains(upper(text), 'THE') THEN 'ok' ELSE 'off topic' END AS reason FROM documents""")
def extraction_input_gate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", guards.input_reason(F.col("text"), "the").alias("reason"))


@query("SELECT doc_id, CASE WHEN contains(lower(text), 'token') AND contains(lower(text), 'license') THEN 'ambiguous' WHEN contains(lower(text), 'token') THEN 'somatic' WHEN contains(lower(text), 'license') THEN 'germline' ELSE 'unknown' END AS label FROM documents")
def marker_class(spark, sf):
    low = F.lower("text")
    s, g = text.markers(low, ("token",)) > 0, text.markers(low, ("license",)) > 0
    return table(spark, sf, "documents").select("doc_id", F.when(s & g, "ambiguous").when(s, "somatic").when(g, "germline").otherwise("unknown").alias("label"))


@query(f"""WITH facts AS ({FACTS_SQL}), t AS (SELECT supplier, count(*) FILTER (carriers IS NULL) AS nulls, count(*) AS n FROM facts GROUP BY 1)
SELECT a.supplier, (a.n - b.n) AS d_n, (a.nulls - b.nulls) AS d_nulls FROM t a FULL OUTER JOIN (SELECT supplier - 1 AS supplier, n, nulls FROM t) b USING (supplier) WHERE a.supplier IS NOT NULL""")
def run_over_run_delta(spark, sf):
    t = facts(spark, sf).groupBy("supplier").agg(F.count_if(F.col("carriers").isNull()).alias("nulls"), F.count(F.lit(1)).alias("n"))
    before = t.select((F.col("supplier") - 1).alias("supplier"), "nulls", "n")
    known = t.select("supplier")
    return scoring.run_delta(before, t, "supplier", ["n", "nulls"]).join(known, "supplier", "left_semi")


@query("SELECT l_suppkey AS id, min(l_partkey) AS l_partkey, min(l_partkey) AS position FROM lineitem GROUP BY 1")
def richest_row(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("id"), "l_partkey")
    return relational.richest(rows, ["id"], F.lit(True), "l_partkey")


@query("SELECT o_orderkey AS id, substr(o_comment, 1, 10) || chr(10) || right(o_comment, 5) AS t FROM (SELECT o_orderkey, o_orderpriority || o_orderstatus || o_orderpriority || o_orderpriority AS o_comment FROM orders) WHERE length(o_comment) > 15 UNION ALL SELECT o_orderkey, o_comment FROM (SELECT o_orderkey, o_orderpriority || o_orderstatus || o_orderpriority || o_orderpriority AS o_comment FROM orders) WHERE length(o_comment) <= 15")
def head_and_tail(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.concat("o_orderpriority", "o_orderstatus", "o_orderpriority", "o_orderpriority").alias("c"))
    return o.select("id", text.head_and_tail(F.col("c"), 15).alias("t"))
