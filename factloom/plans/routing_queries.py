"""Registered queries of routing, bindings, policies and risk, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.operators import layouts, routing
from factloom.plans.queries import query
from factloom.plans.rollup_queries import _cases
from factloom.plans.table_queries import PARTS_SQL, _written, parts
from factloom.session import table

_ANSWERS = [
    '```json\n{"variant_tables": [{"table_id": 1, "column_mapping": {"gene": 0, "protein": 1, "patient_count": 2, "affected": "3", "odd": 4, "cdna": "x"}, "confidence": 0.9}]}\n```',
    'I think {"variant_tables": [{"table_id": "1", "column_mapping": {"gene": "0", "protein": "1", "patient_count": "2", "affected": "3"}}]}',
    '{"variant_tables": [{"table_id": "1", "column_mapping": {"protein": "1"}}, {"table_id": "", "column_mapping": {"protein": "1", "affected": "3"}}]}',
    "no tables at all",
]


@query(f"WITH p AS ({PARTS_SQL}), d AS (SELECT doc, min(id) % 4 AS k FROM p GROUP BY 1) SELECT doc, short AS variant, CAST(sum(carriers) AS BIGINT) AS carriers, CAST(sum(affected) AS BIGINT) AS affected FROM p JOIN d USING (doc) WHERE gene = 'GENE1' AND k < 2 GROUP BY 1, 2")
def router_answers(spark, sf):
    """Tables read by the mapping that a router's answer gives; answers without a usable table give no facts."""
    line = F.concat(F.lit("| "), F.col("gene"), F.lit(" | "), F.col("change"), F.lit(" | "), F.col("carriers").cast("string"), F.lit(" | "), F.col("affected").cast("string"), F.lit(" |"))
    docs = _written(parts(spark, sf), line, "| g | v | n | a |\n|---|---|---|---|\n")
    answers = parts(spark, sf).groupBy("doc").agg((F.min("id") % 4).alias("k")).selectExpr("doc", "CASE k " + " ".join("WHEN {} THEN '{}'".format(i, a.replace("'", "''").replace("\n", "\\n")) for i, a in enumerate(_ANSWERS)) + " END AS answer")
    routed = routing.router_tables(answers, "doc", "answer")
    return routing.mapped_facts(layouts.read_tables(docs, layouts.pipe_tables, "doc"), routed, ["doc"], "GENE1").select("doc", "variant", "carriers", "affected")


_BINDS = [("3 carriers of A12V", "p.Ala12Val", True), ("A12V and R30W in 3", "A12V", False), ("A12V and A12G in 3", "A12V", True), ("none of these variants, A12V or R30W", "A12V", True), ("3 carriers", "A12V", False), ("GENE2 A12V in 3", "A12V", False), ("GENE2 and GENE1 A12V", "A12V", True), (None, "A12V", False)]


@query(f"SELECT p_partkey AS id, CAST({_cases('p_partkey', [str(b[2]) for b in _BINDS])} AS BOOLEAN) AS bound FROM part")
def quote_bindings(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", f"{_cases('p_partkey', [b[0] for b in _BINDS])} AS q", f"{_cases('p_partkey', [b[1] for b in _BINDS])} AS v")
    return p.select("id", routing.quote_binds(F.col("q"), F.col("v"), "GENE1", ("GENE2", "GENE3"), F.lit(0)).alias("bound"))


@query("SELECT p_partkey AS id, CASE WHEN p_size % 3 = 1 THEN 'weak' ELSE 'supported' END AS specificity FROM part WHERE p_size % 3 > 0")
def gene_policy(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", "p_size")
    support = F.when(F.col("p_size") % 3 == 0, "off_target").when(F.col("p_size") % 3 == 1, "weak").otherwise("supported")
    return routing.gene_policy(p, support, "clear").select("id", "specificity")


@query("SELECT p_partkey AS id, 'misparse_out_of_range' AS class FROM part WHERE p_size > 40")
def class_quarantine(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", "p_size")
    return routing.quarantine_classes(p, F.when(F.col("p_size") > 40, "misparse_out_of_range").when(F.col("p_size") > 20, "residue_unverified"))[1].select("id", "class")


_CANDIDATES = "SELECT l_suppkey AS paper, 'V' || l_partkey % 60 AS variant, l_orderkey * 10 + l_linenumber AS o, CASE WHEN l_linenumber = 2 THEN 'Table 1 previously reported' ELSE 'Table 1' END AS caption, CASE WHEN l_linenumber = 3 THEN 'GENE2' ELSE 'GENE1' END AS gene FROM lineitem"


@query(f"""WITH c AS ({_CANDIDATES}), e AS (SELECT paper, variant, min(o) AS o FROM c WHERE caption = 'Table 1' AND gene = 'GENE1' GROUP BY 1, 2)
SELECT c.paper, count(*) AS candidates, count(*) FILTER (caption = 'Table 1' AND gene = 'GENE1') AS eligible, greatest((SELECT count(*) FROM e WHERE e.paper = c.paper) - 20, 0) AS overflow FROM c GROUP BY 1""")
def merge_overflow(spark, sf):
    c = table(spark, sf, "lineitem").selectExpr(*[x.strip() for x in ("l_suppkey AS paper", "concat('V', l_partkey % 60) AS variant", "l_orderkey * 10 + l_linenumber AS o", "CASE WHEN l_linenumber = 2 THEN 'Table 1 previously reported' ELSE 'Table 1' END AS caption", "'' AS source", "CASE WHEN l_linenumber = 3 THEN 'GENE2' ELSE 'gene1' END AS gene")])
    return routing.merge_candidates(c, "paper", "GENE1", ("GENE1", "GENE2"), "o", 20)[1]


@query("""SELECT p_partkey AS id, CASE WHEN p_size >= 8 AND 3 < greatest(2, p_size // 4) THEN 2 ELSE 0 END + CASE WHEN p_size % 10 >= 5 AND 3 < greatest(2, p_size % 10 // 2) THEN 1 ELSE 0 END + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS points FROM part""")
def extraction_risk(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", "CAST(p_size AS INT) AS s", "CASE WHEN p_partkey % 2 = 0 THEN 'see Table 2' ELSE 'see Table 2 | x |' END AS t")
    return p.select("id", routing.extraction_risk(F.lit(3), F.col("s"), F.col("s") % 10, F.col("t"))["points"].alias("points"))


@query("SELECT p_partkey AS id, unnest([0, 1, 2]) AS place, unnest(['figure', 'table', 'supplement']) AS kind, unnest(['Figure 1', 'Table 1', '']) AS label, unnest(['One ' || p_size || ' & more', 'T', 'Data']) AS caption, unnest([NULL, NULL, 's' || p_size || '.xlsx']) AS href FROM part")
def xml_captions(spark, sf):
    x = F.concat(F.lit("<a><fig id='f'><label>Figure 1</label><caption><title>One <b>"), F.col("p_size").cast("string"), F.lit("</b> &amp;\n more</title></caption></fig><p>no</p><table-wrap><label>Table 1</label><caption>T</caption><table/></table-wrap><supplementary-material xlink:href=\"s"), F.col("p_size").cast("string"), F.lit(".xlsx\"><caption><p>Data</p></caption></supplementary-material></a>"))
    return routing.xml_captions(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.replace(x, F.lit("&amp;"), F.lit("&")).alias("x")), "id", "x")


@query("SELECT l_orderkey AS doc, string_agg('## Zone ' || k || ' (score ' || CAST(CAST(k AS DECIMAL(9, 2)) AS VARCHAR) || ')' || chr(10) || chr(10) || 'Z' || k, chr(10) || chr(10) ORDER BY k) AS report FROM (SELECT DISTINCT l_orderkey, l_linenumber AS k FROM lineitem) GROUP BY 1")
def zone_report(spark, sf):
    z = table(spark, sf, "lineitem").selectExpr("l_orderkey AS doc", "l_linenumber AS k").distinct().selectExpr("doc", "k", "CAST(k AS DOUBLE) AS score", "concat('Z', k) AS t")
    return routing.report_text(z, "doc", "k", "score", "t")
