"""Registered queries of repairs, merges, pairwise matching and job state, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import text
from factloom.operators import pairwise, repairs
from factloom.plans.queries import FACTS_SQL, facts, query
from factloom.plans.rollup_queries import _cases
from factloom.session import table
from factloom.streaming import jobs


@query(f"""WITH facts AS ({FACTS_SQL}) SELECT paper, line, CASE WHEN carriers > 100 THEN NULL ELSE carriers END AS carriers, CASE WHEN affected > 40 THEN NULL ELSE affected END AS affected, CASE WHEN carriers > 100 THEN 'carriers=' || carriers || ' large' END AS f1, CASE WHEN affected > 40 THEN 'affected=' || affected || ' large' END AS f2 FROM facts""")
def count_policy(spark, sf):
    rows = facts(spark, sf).select("paper", "line", "carriers", "affected")
    flags = {"carriers": F.when(F.col("carriers") > 100, "large"), "affected": F.when(F.col("affected") > 40, "large")}
    out = repairs.apply_policy(rows, flags, "clear")
    said = lambda f: F.get(F.transform(F.filter("flags", lambda x: x["field"] == f), lambda x: F.concat(x["field"], F.lit("="), x["raw"].cast("string"), F.lit(" "), x["reason"])), F.lit(0))
    return out.select("paper", "line", "carriers", "affected", said("carriers").alias("f1"), said("affected").alias("f2"))


@query(f"WITH facts AS ({FACTS_SQL}) SELECT paper, line, CASE WHEN carriers IS NULL AND line % 2 = 1 THEN CAST(line * 3 AS INT) ELSE carriers END AS carriers FROM facts")
def figure_adoption(spark, sf):
    rows = facts(spark, sf).selectExpr("paper", "line", "carriers", "CASE WHEN line % 2 = 1 THEN 'llm_text, figure' ELSE 'llm_text,figures' END AS layers", "concat('{\"carriers\": ', line * 3, '}') AS notes")
    return repairs.adopt_figure_counts(rows, "layers", "notes", ["carriers"]).select("paper", "line", "carriers")


_REPAIRS_SQL = "SELECT p_partkey AS variant, p_partkey % 10 + 1 AS supplier, CAST(p_size AS INT) AS new FROM part"


@query(f"""WITH f AS (SELECT l_partkey AS variant, l_suppkey AS supplier, CAST(l_quantity AS INT) AS carriers FROM lineitem), r AS ({_REPAIRS_SQL}), n AS (SELECT variant, supplier, count(*) AS n FROM f GROUP BY 1, 2)
SELECT f.variant, f.supplier, CASE WHEN n = 1 AND r.new IS NOT NULL THEN r.new ELSE carriers END AS carriers, CASE WHEN n = 1 AND r.new IS NOT NULL THEN 'run 1' END AS repaired_by FROM f JOIN n USING (variant, supplier) LEFT JOIN r USING (variant, supplier)
UNION ALL SELECT variant, supplier, new, 'run 1' FROM r ANTI JOIN n USING (variant, supplier)""")
def repair_apply(spark, sf):
    f = table(spark, sf, "lineitem").selectExpr("l_partkey AS variant", "l_suppkey AS supplier", "CAST(l_quantity AS INT) AS carriers")
    r = table(spark, sf, "part").selectExpr("p_partkey AS variant", "p_partkey % 10 + 1 AS supplier", "CAST(p_size AS INT) AS carriers")
    return repairs.apply_repairs(f, r, ["variant", "supplier"], ["carriers"], "run 1")[0]


@query(f"""WITH r AS ({_REPAIRS_SQL}), n AS (SELECT l_partkey AS variant, l_suppkey AS supplier, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT variant, supplier, CASE WHEN n IS NULL THEN 'created' WHEN n > 1 THEN 'ambiguous' ELSE 'updated' END AS action FROM r LEFT JOIN n USING (variant, supplier)""")
def repair_log(spark, sf):
    f = table(spark, sf, "lineitem").selectExpr("l_partkey AS variant", "l_suppkey AS supplier", "CAST(l_quantity AS INT) AS carriers")
    r = table(spark, sf, "part").selectExpr("p_partkey AS variant", "p_partkey % 10 + 1 AS supplier", "CAST(p_size AS INT) AS carriers")
    return repairs.apply_repairs(f, r, ["variant", "supplier"], ["carriers"], "run 1")[1]


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 IN (0, 3) THEN 12.5 END AS percentage, o_orderkey % 4 IN (1, 2) AS removed FROM orders")
def percentage_guard(spark, sf):
    source = "'We   saw A1V with 12.5% penetrance in ' || o_orderpriority"
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS id", "CAST(12.5 AS DOUBLE) AS percentage", "1 AS fact", "CASE o_orderkey % 4 WHEN 0 THEN 'saw a1v with 12.5% penetrance' WHEN 1 THEN 'A1V with 13% penetrance' WHEN 2 THEN '12.5% penetrance' ELSE 'We saw A1V with 12.5%' END AS quote", "'A1V' AS variant", f"{source} AS source")
    return repairs.guarded_percentage(o, "percentage", "fact", "quote", "variant", "source").select("id", "percentage", "removed")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 2 = 0")
def grounded_responses(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS id", "CASE WHEN o_custkey % 2 = 0 THEN 'this  Quote' ELSE 'other quote' END AS quote", "'here this quote stands' AS source")
    return repairs.grounded(o, o.where("id % 3 = 0"), "source", ["id"], "quote").select("id")


@query("SELECT l_orderkey AS id, l_linenumber AS line FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def orphan_delete(spark, sf):
    children = table(spark, sf, "lineitem").selectExpr("l_orderkey AS id", "l_linenumber AS line")
    return repairs.without_orphans(children, table(spark, sf, "orders").where("o_orderstatus = 'F'").selectExpr("o_orderkey AS id"), ["id"])


_PAPERS = [("KCNH2_PMID_12.json", " 34 ", None, "T", "G"), ("brca1_PMID_77.json", "pmc55", None, "", None), ("x.json", "PMC9", None, None, ""), ("A_PMID_5.json", "PMC1", "PMC2", "T", "G"), ("A_PMID_5.json", None, None, None, None), ("n.json", "7", None, "T", "G")]
_FIXED = [("34", None, "T", "G", 1), ("77", "PMC55", "Paper 77", "BRCA1", 4), ("PMC9", None, "Paper PMC9", None, 2), ("5", "PMC2", "T", "G", 1), ("5", None, "Paper 5", "A", 3), ("7", None, "T", "G", 0)]


def _said(rows: list[tuple], k: int, column: str = "o_orderkey") -> str:
    return _cases(column, [None if r[k] is None else str(r[k]) for r in rows])


@query(f"SELECT o_orderkey AS id, {_said(_FIXED, 0)} AS pmid, {_said(_FIXED, 1)} AS pmc_id, {_said(_FIXED, 2)} AS title, {_said(_FIXED, 3)} AS gene_symbol, CAST({_said(_FIXED, 4)} AS INT) AS repairs FROM orders")
def repaired_papers(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS id", *[f"{_said(_PAPERS, k)} AS {n}" for k, n in enumerate(("file", "pmid", "pmc_id", "title", "gene_symbol"))])
    return repairs.repaired_papers(o, "file").drop("file")


@query("SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 'affected' WHEN 1 THEN 'unaffected' ELSE 'uncertain' END AS affected_status FROM customer")
def repaired_people(spark, sf):
    return repairs.repaired_people(table(spark, sf, "customer").selectExpr("c_custkey AS id", f"{_cases('c_custkey', ['Case', ' healthy', 'maybe', None, ''])} AS affected_status"))


@query("""WITH b AS (SELECT DISTINCT l_suppkey AS paper, l_partkey % 50 AS v FROM lineitem WHERE l_linenumber <= 2), m AS (SELECT DISTINCT l_suppkey AS paper, l_partkey % 50 AS v FROM lineitem WHERE l_linenumber > 2)
SELECT paper, CASE WHEN v % 3 = 0 THEN NULL ELSE 'A' || v || 'V' END AS protein_notation, CASE WHEN v % 3 = 0 THEN 'deletion of exon ' || v END AS structural_description FROM (SELECT * FROM b UNION SELECT * FROM m)""")
def continuation_merge(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_suppkey AS paper", "l_linenumber AS line", "l_partkey % 50 AS v")
    made = lambda d: d.selectExpr("paper", "CAST(NULL AS STRING) AS cdna_notation", "CASE WHEN v % 3 > 0 THEN concat('A', v, 'V') END AS protein_notation", "'' AS legacy_notation", "CASE WHEN v % 3 = 0 THEN concat('deletion of exon ', v) END AS structural_description")
    out = repairs.continued(made(rows.where("line <= 2").select("paper", "v").distinct()), made(rows.where("line > 2")), "paper")
    return out.select("paper", "protein_notation", "structural_description")


@query("""WITH b AS (SELECT o_orderkey AS k, CAST(o_custkey AS INT) AS carriers, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS note FROM orders WHERE o_orderstatus <> 'O'),
t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 100 AS INT) END AS carriers, 'table' AS note FROM orders WHERE o_orderkey % 2 = 0 OR o_orderstatus = 'O')
SELECT coalesce(b.k, t.k) AS k, coalesce(t.carriers, b.carriers) AS carriers, coalesce(b.note, t.note) AS note, CASE WHEN b.k IS NULL THEN 'table' WHEN t.k IS NULL THEN 'base' ELSE 'both' END AS origin FROM b FULL OUTER JOIN t ON b.k = t.k""")
def table_merge(spark, sf):
    o = table(spark, sf, "orders")
    b = o.where("o_orderstatus <> 'O'").selectExpr("o_orderkey AS k", "CAST(o_custkey AS INT) AS carriers", "CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS note")
    t = o.where("o_orderkey % 2 = 0 OR o_orderstatus = 'O'").selectExpr("o_orderkey AS k", "CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 100 AS INT) END AS carriers", "'table' AS note")
    return repairs.merge_tables(b, t, ["k"], ["carriers"])


@query("""WITH o AS (SELECT DISTINCT l_suppkey AS paper, l_partkey AS v, CASE WHEN l_partkey % 2 = 0 THEN l_returnflag END AS c FROM lineitem WHERE l_linenumber <> 2), t AS (SELECT DISTINCT l_suppkey AS paper, l_partkey AS v, CASE WHEN l_partkey % 2 = 0 THEN l_returnflag END AS c FROM lineitem WHERE l_linenumber IN (2, 4) OR l_suppkey % 4 = 0),
m AS (SELECT paper FROM (SELECT paper, count(*) AS n FROM o GROUP BY 1) JOIN (SELECT paper, count(*) AS k FROM t GROUP BY 1) USING (paper) WHERE n > k AND paper % 3 > 0)
SELECT * FROM o WHERE paper IN (SELECT paper FROM m) AND NOT EXISTS (SELECT 1 FROM t WHERE t.paper = o.paper AND t.v = o.v AND t.c IS NOT DISTINCT FROM o.c)""")
def table_links_to_add(spark, sf):
    made = lambda where: table(spark, sf, "lineitem").where(where).selectExpr("l_suppkey AS paper", "l_partkey AS v", "CASE WHEN l_partkey % 2 = 0 THEN l_returnflag END AS c").distinct()
    listed = table(spark, sf, "supplier").where("s_suppkey % 3 > 0").selectExpr("s_suppkey AS paper")
    return repairs.missing_links(made("l_linenumber <> 2"), made("l_linenumber IN (2, 4) OR l_suppkey % 4 = 0"), listed, "paper", ["v", "c"])


@query("""WITH s AS (SELECT o_orderkey AS k, o_custkey % 20 AS paper, o_orderstatus AS v FROM orders WHERE o_orderkey % 4 > 0), i AS (SELECT o_orderkey AS k, o_custkey % 20 AS paper, CASE WHEN o_orderkey % 7 = 0 THEN 'Z' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 5 > 0 OR o_orderkey % 4 = 0)
SELECT coalesce(s.k, i.k) AS k, coalesce(s.paper, i.paper) AS paper, CASE WHEN i.k IS NULL THEN s.v ELSE i.v END AS v, CASE WHEN s.k IS NULL THEN 'added' WHEN i.k IS NULL THEN 'removed' WHEN s.v = i.v THEN 'same' ELSE 'updated' END AS change,
  CASE WHEN s.k IS NOT NULL AND i.k IS NOT NULL AND s.v = i.v THEN 3 ELSE 4 END AS version, coalesce(s.paper, i.paper) < 5 AS excluded FROM s FULL OUTER JOIN i ON s.k = i.k""")
def reference_sync(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS k", "o_custkey % 20 AS paper", "o_orderstatus AS v")
    excluded = o.select("paper").where("paper < 5")
    return repairs.sync_reference(o.where("k % 4 > 0").withColumn("version", F.lit(3)), o.where("k % 5 > 0 OR k % 4 = 0").withColumn("v", F.when(F.col("k") % 7 == 0, "Z").otherwise(F.col("v"))), ["k", "paper"], ["v"], excluded, 4)


@query("""WITH d AS (SELECT lang, contains(lower(text), 'token') AS s, contains(lower(text), 'license') AS g FROM documents)
SELECT lang, count(*) FILTER (NOT (s AND NOT g)) AS total, count(*) FILTER (g AND NOT s) AS germline, 0 AS somatic, count(*) FILTER (s AND g) AS ambiguous, count(*) FILTER (NOT s AND NOT g) AS unknown, count(*) FILTER (s AND g) / CAST(nullif(count(*) FILTER (NOT (s AND NOT g)), 0) AS DOUBLE) AS somatic_fraction FROM d GROUP BY 1""")
def origin_policy(spark, sf):
    low = F.lower(F.coalesce("text", F.lit("")))
    s, g = text.markers(low, ("token",)) > 0, text.markers(low, ("license",)) > 0
    label = F.when(s & g, "ambiguous").when(s, "somatic").when(g, "germline").otherwise("unknown")
    return repairs.origin_summary(repairs.annotate_origin(table(spark, sf, "documents"), label, "drop_somatic"), ["lang"])


#: Extracted and baseline spellings, and how they match, said by hand.
_PAIRS = [
    ("p.Ala561Val", "A561V", "exact_normalized"), ("L987fsX10", "p.Leu987Profs*12", "exact_normalized"), ("987fs", "fs987", "frameshift_normalized"), ("R864stop", "p.Arg864*", "exact_normalized"), ("L552del", "Leu552del", "deletion_normalized"),
    ("A562V", "A561V", "position_fuzzy_+1"), ("A560V", "A561V", "position_fuzzy_-1"), ("A562G", "A561V", None), ("L553del", "L552del", "position_fuzzy_+1"), ("c.12A>G", "12A>G", "exact_normalized"), ("dup552", "552dup", "position_fuzzy_+0"), ("", "A1V", None),
]


@query(f"SELECT p_partkey AS id, {_said(_PAIRS, 2, 'p_partkey')} AS how FROM part")
def pairwise_match(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", f"nullif({_said(_PAIRS, 0, 'p_partkey')}, '') AS a", f"{_said(_PAIRS, 1, 'p_partkey')} AS b")
    d = p.select("id", pairwise.described(F.col("a")).alias("a"), pairwise.described(F.col("b")).alias("b"))
    return d.select("id", pairwise.match_type(F.col("a"), F.col("b")).alias("how"))


@query("""WITH f AS (SELECT DISTINCT p_brand AS doc, p_partkey % 300 + 10 AS n FROM part), e AS (SELECT DISTINCT doc, n FROM f WHERE n % 3 > 0),
m AS (SELECT f.doc, f.n, e.n AS en, row_number() OVER (PARTITION BY f.doc, f.n ORDER BY abs(f.n - e.n), 'A' || e.n || 'V') AS r FROM f JOIN e ON e.doc = f.doc AND abs(f.n - e.n) <= CASE WHEN f.n % 2 = 0 THEN 0 ELSE 1 END WHERE f.n <= 250)
SELECT f.doc, CASE WHEN f.n % 2 = 0 THEN 'p.Ala' || f.n || 'Val' ELSE 'A' || f.n || 'V' END AS found, CASE WHEN f.n > 250 THEN 'beyond' END AS non_target, 'A' || en || 'V' AS expected, CASE WHEN en = f.n THEN 'exact_normalized' WHEN en < f.n THEN 'position_fuzzy_+1' WHEN en > f.n THEN 'position_fuzzy_-1' END AS how
FROM f LEFT JOIN (SELECT * FROM m WHERE r = 1) m USING (doc, n)""")
def baseline_match(spark, sf):
    """Only spellings of a kind that is told from them match at a position near by."""
    rows = table(spark, sf, "part").selectExpr("p_brand AS doc", "p_partkey % 300 + 10 AS n").distinct()
    found, expected = rows.selectExpr("doc", "CASE WHEN n % 2 = 0 THEN concat('p.Ala', n, 'Val') ELSE concat('A', n, 'V') END AS v"), rows.where("n % 3 > 0").selectExpr("doc", "concat('A', n, 'V') AS v")
    return pairwise.match_baseline(found, expected, ["doc"], "v", "GENE1", 250)


@query("""WITH f AS (SELECT p_brand AS doc, p_partkey % 40 AS n, max(p_partkey) AS k FROM part WHERE p_size % 2 = 0 GROUP BY 1, 2), e AS (SELECT p_brand AS doc, p_partkey % 40 AS n FROM part WHERE p_size % 3 = 0 OR p_size % 2 > 0 GROUP BY 1, 2)
SELECT doc, 'A' || n || 'V' AS normal, CASE WHEN k % 3 = 0 THEN 'A' || n || 'V' ELSE CASE WHEN k IS NOT NULL THEN 'p.Ala' || n || 'Val' END END AS extracted, CASE WHEN k IS NULL THEN 'missed' WHEN en IS NULL THEN 'extra' ELSE 'matched' END AS result
FROM f FULL OUTER JOIN (SELECT doc, n, n AS en FROM e) e USING (doc, n)""")
def set_match(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_brand AS doc", "p_partkey AS k", "p_size AS s", "CASE WHEN p_partkey % 3 = 0 THEN concat('A', p_partkey % 40, 'V') ELSE concat('p.Ala', p_partkey % 40, 'Val') END AS v")
    return pairwise.set_match(p.where("s % 2 = 0"), p.where("s % 3 = 0 OR s % 2 > 0"), ["doc"], "v", "k").select("doc", "normal", "extracted", "result")


# ---- jobs


@query("""WITH e AS (SELECT o_custkey AS job, o_orderkey AS t, CASE o_orderkey % 5 WHEN 0 THEN 'fetch' WHEN 1 THEN 'extract' WHEN 2 THEN 'failed' WHEN 3 THEN 'completed' ELSE 'extract' END AS step, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS p FROM orders),
s AS (SELECT job, max(t) AS updated_at, arg_max(step, t) AS current_step FROM e GROUP BY 1) SELECT s.*, (SELECT max(p) FROM e WHERE e.job = s.job AND step = 'extract') AS extracted FROM s""")
def job_state(spark, sf):
    e = table(spark, sf, "orders").selectExpr("o_custkey AS job", "o_orderkey AS at", "CASE o_orderkey % 5 WHEN 0 THEN 'fetch' WHEN 1 THEN 'extract' WHEN 2 THEN 'failed' WHEN 3 THEN 'completed' ELSE 'extract' END AS step", "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS p")
    return jobs.job_state(e, "job", "at", "step", "p").select("job", "updated_at", "current_step", F.try_element_at("step_progress", F.lit("extract")).alias("extracted"))


@query("SELECT o_orderkey AS job FROM orders WHERE o_orderstatus IN ('F', 'O') AND CAST(o_orderdate AS TIMESTAMP) < TIMESTAMP '1998-01-01' - INTERVAL 30 DAY")
def expired_jobs(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS job", "CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'completed' ELSE 'extract' END AS current_step", "CAST(o_orderdate AS TIMESTAMP) AS updated_at")
    return jobs.expired(o, F.to_timestamp(F.lit("1998-01-01"))).select("job")


@query("""WITH a AS (SELECT l_orderkey AS call, l_linenumber AS n, CASE WHEN l_linenumber % 4 <> 3 THEN 't' || l_linenumber END AS trace, CASE l_partkey % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN 'parse_failed' WHEN 2 THEN 'error' WHEN 3 THEN 'pending' END AS o FROM lineitem)
SELECT call, coalesce(string_agg(trace, ',' ORDER BY n) FILTER (o = 'accepted'), '') AS accepted, coalesce(string_agg(trace, ',' ORDER BY n) FILTER (o IN ('parse_failed', 'error')), '') AS failed, coalesce(string_agg(trace, ',' ORDER BY n) FILTER (o IS NULL OR o = 'pending'), '') AS discarded,
  count(*) AS attempts, count(*) FILTER (o = 'parse_failed') AS parse_failures, arg_max(trace, n) FILTER (o = 'accepted' AND trace IS NOT NULL) AS accepted_last FROM a GROUP BY 1""")
def attempt_ledger(spark, sf):
    a = table(spark, sf, "lineitem").selectExpr("l_orderkey AS call", "l_linenumber AS n", "CASE WHEN l_linenumber % 4 <> 3 THEN concat('t', l_linenumber) END AS trace", "CASE l_partkey % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN 'parse_failed' WHEN 2 THEN 'error' WHEN 3 THEN 'pending' END AS o")
    out = jobs.attempt_summary(a, "call", "n", "trace", "o")
    return out.select("call", *[F.array_join(c, ",").alias(c) for c in ("accepted", "failed", "discarded")], "attempts", "parse_failures", "accepted_last")


@query("SELECT o_custkey AS run, min(o_orderkey) AS started, max(o_orderkey) AS ended, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'O') AS failed, count(*) FILTER (o_orderstatus = 'F') / CAST(nullif(count(*) FILTER (o_orderstatus IN ('F', 'O')), 0) AS DOUBLE) AS success FROM orders GROUP BY 1")
def run_statistics(spark, sf):
    e = table(spark, sf, "orders").selectExpr("o_custkey AS run", "o_orderkey AS at", "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' END AS status")
    return jobs.run_statistics(e, "run", "at", "status")


_ENTRY = "CASE o_orderkey % 4 WHEN 0 THEN '{\"path\": \"p' || o_custkey || '\", \"n\": ' || o_orderkey || '}' WHEN 1 THEN '{\"path\": ' WHEN 2 THEN '{\"n\": 1}' ELSE '{\"path\": \"p' || o_custkey || '\", \"n\": ' || o_orderkey || '}' END"


@query(f"SELECT 'p' || o_custkey AS path, arg_max({_ENTRY}, o_orderkey) AS line FROM orders WHERE o_orderkey % 4 IN (0, 3) GROUP BY 1")
def trace_index(spark, sf):
    return jobs.last_entries(table(spark, sf, "orders").selectExpr(f"{_ENTRY} AS line", "o_orderkey AS at"), "line", "at")


@query("SELECT p_partkey AS id FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45) AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 40)")
def scope_exclusion_rows(spark, sf):
    """As scope_exclusion, on a condition that leaves rows."""
    from factloom.operators import relational

    line = table(spark, sf, "lineitem").selectExpr("l_partkey AS id", "l_quantity AS q", "l_returnflag AS f")
    parts = table(spark, sf, "part").selectExpr("p_partkey AS id").join(line.where("q > 45").select("id"), "id", "left_semi")
    return relational.quarantine(parts, line.where("f = 'R' AND q > 40").select("id"), "id")[0]
