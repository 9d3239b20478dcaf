"""Registered queries of reference tables, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from factloom.operators.shared import folder_of
from factloom.plans.queries import query
from factloom.session import table
from factloom.sources import clustered, warehouse

_join = lambda c: F.array_join(c, ",").alias(c)


@query("""WITH w AS (SELECT l_suppkey AS gene, l_partkey % 40 AS position, l_orderkey * 10 + l_linenumber AS row, CASE WHEN l_linenumber % 4 > 0 THEN l_returnflag END AS ref, l_linestatus AS alt, 'NP_1:p.X' || l_partkey % 40 || l_linestatus AS p FROM lineitem),
q AS (SELECT s_suppkey AS gene, s_suppkey % 40 AS position, 'p.X' || s_suppkey % 40 || CASE WHEN s_suppkey % 2 = 0 THEN 'O' ELSE 'Q' END AS protein FROM supplier),
r AS (SELECT gene, position, ref, min(row) AS o FROM w WHERE ref IS NOT NULL GROUP BY 1, 2, 3), a AS (SELECT gene, position, alt, min(row) AS o FROM w GROUP BY 1, 2, 3)
SELECT q.gene AS gene, q.position, (SELECT coalesce(string_agg(ref, ',' ORDER BY o), '') FROM r WHERE r.gene = q.gene AND r.position = q.position) AS refs, (SELECT string_agg(alt, ',' ORDER BY o) FROM a WHERE a.gene = q.gene AND a.position = q.position) AS alts,
  EXISTS (SELECT 1 FROM w WHERE w.gene = q.gene AND w.position = q.position AND ends_with(w.p, q.protein)) AS matched_p, false AS matched_c FROM q WHERE EXISTS (SELECT 1 FROM w WHERE w.gene = q.gene AND w.position = q.position)""")
def residue_lookup(spark, sf):
    w = table(spark, sf, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS row", "concat('g', l_suppkey) AS gene", "l_partkey % 40 AS position", "'T1' AS transcript", "concat('NP_1:p.X', l_partkey % 40, l_linestatus) AS hgvs_p", "'c.1A>G' AS hgvs_c", "CASE WHEN l_linenumber % 4 > 0 THEN lower(l_returnflag) ELSE ' ' END AS ref", "l_linestatus AS alt")
    q = table(spark, sf, "supplier").selectExpr("concat('G', s_suppkey) AS gene", "s_suppkey % 40 AS position", "concat('P.x', s_suppkey % 40, CASE WHEN s_suppkey % 2 = 0 THEN 'o' ELSE 'q' END) AS protein", "'' AS coding")
    out = warehouse.residues(w, q)
    return out.select(F.substring("gene", 2, 9).cast("long").alias("gene"), "position", F.array_join("references", ",").alias("refs"), F.array_join("alternates", ",").alias("alts"), "matched_p", "matched_c")


@query("""SELECT n_name AS gene, CASE WHEN n_nationkey % 3 = 0 THEN 'a,b,n' || n_nationkey WHEN n_nationkey % 3 = 1 THEN 'a,b' ELSE 'b,n' || n_nationkey END AS aliases, CASE n_nationkey % 3 WHEN 2 THEN 90 ELSE 100 END AS length FROM nation""")
def merged_genes(spark, sf):
    n = table(spark, sf, "nation")
    b = n.where("n_nationkey % 3 < 2").selectExpr("n_name AS gene", "array('a', 'b') AS aliases", "array('s') AS sources", "100 AS length")
    f = n.where("n_nationkey % 3 <> 1").selectExpr("n_name AS gene", "array('b', concat('n', n_nationkey)) AS aliases", "array('t') AS sources", "90 AS length")
    return warehouse.merged_genes(b, f).select("gene", _join("aliases"), "length")


@query("SELECT 'G' || o_custkey % 7 AS gene, CAST(o_custkey AS VARCHAR) AS pmid, arg_max(o_orderstatus, o_orderkey) AS status, max(o_orderkey) AS line FROM orders GROUP BY 1, 2")
def corpus_index(spark, sf):
    o = table(spark, sf, "orders").selectExpr("concat(' g', o_custkey % 7) AS gene", "concat(o_custkey, '.0') AS pmid", "o_orderstatus AS status", "o_orderkey AS line")
    return warehouse.corpus_index(o, "line")


@query("""SELECT l_partkey AS variant_id, l_orderkey AS pmid, CAST(l_quantity AS INT) AS carriers, p_brand AS name, CASE WHEN l_orderkey % 2 = 0 THEN 'Table 1' END AS source_location, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS title FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey""")
def pipeline_rows(spark, sf):
    f = table(spark, sf, "lineitem").selectExpr("l_partkey AS variant_id", "l_orderkey AS pmid", "CAST(l_quantity AS INT) AS carriers")
    links = f.where("pmid % 2 = 0").select("variant_id", "pmid").distinct().selectExpr("*", "'Table 1' AS source_location", "'' AS additional_notes")
    papers = table(spark, sf, "orders").where("o_orderstatus = 'F'").selectExpr("o_orderkey AS pmid", "o_orderpriority AS title")
    return warehouse.pipeline_rows(f, table(spark, sf, "part").selectExpr("p_partkey AS variant_id", "p_brand AS name"), links, papers).drop("additional_notes")


@query("""SELECT o_orderkey AS pmid, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_variants, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS n_people, 0 AS n_tables, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber > 2) AS n_facts, (SELECT CAST(sum(l_quantity) AS BIGINT) FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber > 2) AS carriers FROM orders""")
def paper_surfaces(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey AS pmid", "l_returnflag AS f", "l_linenumber AS n", "l_quantity AS carriers")
    return warehouse.paper_surfaces(table(spark, sf, "orders").selectExpr("o_orderkey AS pmid"), rows, rows.where("f = 'R'"), rows.where("n > 2"), rows.limit(0)).withColumn("n_tables", F.col("n_tables").cast("int"))


@query("SELECT p_partkey AS id, CASE WHEN p_size % 3 < 2 THEN 'c.' || p_size || 'C>T' END AS coding, CASE WHEN p_size % 3 = 0 THEN 'p.Ala' || p_size || 'Val' END AS protein FROM part WHERE p_size % 3 < 2")
def variation_titles(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", "CASE p_size % 3 WHEN 0 THEN concat('NM_1.4(GENE1):c.', p_size, 'C>T (p.Ala', p_size, 'Val)') WHEN 1 THEN concat('NM_1.4(GENE1):c.', p_size, 'C>T') ELSE 'GENE1 deletion' END AS title")
    return warehouse.named_changes(p, "title").select("id", "coding", "protein")


# ---- the clustered table

_CLUSTERED = "SELECT l_orderkey * 10 + l_linenumber AS row, concat('g', l_suppkey) AS gene, CAST(l_partkey % 40 AS INT) AS position FROM lineitem"


def _clustered(spark, sf) -> clustered.Clustered:
    made = clustered.Clustered(spark, f"{folder_of(spark)}/clustered-{uuid.uuid4().hex}")
    made.write(spark.sql(_CLUSTERED.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf, "lineitem")))
    return made


@query(f"WITH w AS ({_CLUSTERED}) SELECT gene, position, count(*) AS n, CAST(sum(row) AS BIGINT) AS rows FROM w WHERE EXISTS (SELECT 1 FROM supplier WHERE gene = concat('g', s_suppkey) AND position IN (s_suppkey % 40, s_suppkey % 7)) GROUP BY 1, 2")
def clustered_lookup(spark, sf):
    """Two positions of each supplier's gene, from the files that hold them."""
    s = table(spark, sf, "supplier")
    wanted = s.selectExpr("concat('g', s_suppkey) AS gene", "CAST(s_suppkey % 40 AS INT) AS position").union(s.selectExpr("concat('g', s_suppkey)", "CAST(s_suppkey % 7 AS INT)"))
    return _clustered(spark, sf).lookup(wanted).groupBy("gene", "position").agg(F.count(F.lit(1)).alias("n"), F.sum("row").cast("long").alias("rows"))


@query(f"WITH w AS ({_CLUSTERED}) SELECT gene, (SELECT count(*) FROM w AS x WHERE x.gene = 'g1') AS of_first FROM w GROUP BY 1")
def clustered_genes(spark, sf):
    """The distinct genes, and the size of the slice of one of them."""
    made = _clustered(spark, sf)
    return made.leading().withColumn("of_first", F.lit(made.slice("g1").count()))
