"""Registered queries of aliases, names and rollups, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import identity
from factloom.operators import rollups
from factloom.plans.queries import FACTS_SQL, facts, query
from factloom.session import table

COUNTRIES = {"usa": "United States", "uk": "United Kingdom", "united kingdom": "United Kingdom", "holland": "Netherlands", "china": "China", "south korea": "South Korea", "japan": "Japan"}


def _cases(column: str, values: list[str | None]) -> str:
    """A column that goes through the values by the remainder of an id."""
    say = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return f"CASE {column} % {len(values)} " + " ".join(f"WHEN {i} THEN {say(v)}" for i, v in enumerate(values)) + " END"


#: What goes in, and what must come out, both said by hand.
ALIASES = [
    ("V340G", "p.Val340Glyfs*6", True, "p.Val340Glyfs*6"), ("p.Val340Glyfs*6", "V340G", True, "p.Val340Glyfs*6"), ("V340G", "p.Val340fs", False, "V340G"), ("V340G", "p.Val341Glyfs*6", False, "V340G"),
    (None, "A1B", False, "A1B"), ("p.(Val340Gly)", "V340GfsX12", True, "V340GfsX12"), ("", None, False, None), ("v340g", "Val340GlyfsTer6", True, "Val340GlyfsTer6"), ("X1Y", "p.Xaa1Tyrfs*2", False, "X1Y"),
]
STRUCTURES = [
    ("c.1682C>T", "c.1682C>T", None, None, None), ("1682C>T", "c.1682C>T", None, None, None), (" odd ", "odd", None, None, None), ("ΔKPQ1505", "ΔKPQ1505", "KPQ", None, None),
    ("delta-LysProGln", "delta-LysProGln", "KPQ", None, None), ("p.Lys1505_Gln1507del", "p.Lys1505_Gln1507del", None, "1505-1507", None), ("Q1507 - K1505del", "Q1507 - K1505del", None, "1505-1507", None),
    ("ins TTC 1505 here", "ins TTC 1505 here", None, None, 1505), ("delta-Foo", "delta-Foo", None, None, None), (None, "", None, None, None),
]
NAMES = [
    ("x/KCNH2_PMID_31361068.json", "KCNH2", "https://a.org/doi/suppl/10.1056/NEJMoa042786/suppl_file/x.pdf", "10.1056/NEJMoa042786", "https://s.com/science/article/pii/S0140673605/full", "S0140673605", "Per-Variant carrier", "per_variant_carrier", "2019 Mar", 2019),
    ("brca1_pmid_1.json", "BRCA1", "/x/10.1038/ng.1.", "10.1038/ng.1", "/PII/s12", "s12", "screened n", "screened_N", "c. 98", 0),
    ("PMID_1.json", None, "10.99/x", None, "none", None, "  ", None, None, 0),
    ("a/b/c.json", None, None, None, None, None, "odd type-x", "odd_type_x", "in 199 and 2001", 2001),
]
PLACES = [
    (None, None, "Ashkenazi jewish family", "Dept of X, Leiden, Holland.", "Ashkenazi jewish", "Netherlands (inferred from author affiliation)"),
    (None, "Japan", "han chinese and white", "Y, UK", "han chinese", "Japan"),
    ("Finnish", None, "from South Korea", "Z, USA", "Finnish", "South Korea"),
    (None, None, "whitewater rafting", None, None, None),
]


def _pick(name: str, rows: list[tuple], column: int) -> str:
    return _cases(name, [None if r[column] is None else str(r[column]) for r in rows])


@query(f"SELECT p_partkey AS id, CAST({_pick('p_partkey', ALIASES, 2)} AS BOOLEAN) AS alias, {_pick('p_partkey', ALIASES, 3)} AS preferred FROM part")
def frameshift_aliases(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", f"{_pick('p_partkey', ALIASES, 0)} AS a", f"{_pick('p_partkey', ALIASES, 1)} AS b")
    return p.select("id", identity.frameshift_alias(F.col("a"), F.col("b")).alias("alias"), identity.preferred_alias(F.col("a"), F.col("b")).alias("preferred"))


@query(f"SELECT p_partkey AS id, {_pick('p_partkey', STRUCTURES, 1)} AS coding, {_pick('p_partkey', STRUCTURES, 2)} AS peptide, {_pick('p_partkey', STRUCTURES, 3)} AS deleted, CAST({_pick('p_partkey', STRUCTURES, 4)} AS INT) AS inserted FROM part")
def structural_notations(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", f"{_pick('p_partkey', STRUCTURES, 0)} AS v")
    v = F.col("v")
    span = identity.range_deletion(v)
    return p.select("id", identity.short_cdna(v).alias("coding"), identity.delta_peptide(v).alias("peptide"), F.concat(span["first"], F.lit("-"), span["last"]).alias("deleted"), identity.insertion_position(v).alias("inserted"))


@query(f"SELECT p_partkey AS id, {_pick('p_partkey', NAMES, 1)} AS gene, {_pick('p_partkey', NAMES, 3)} AS doi, {_pick('p_partkey', NAMES, 5)} AS item, {_pick('p_partkey', NAMES, 7)} AS kind, CAST({_pick('p_partkey', NAMES, 9)} AS INT) AS year FROM part")
def names_and_years(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", *[f"{_pick('p_partkey', NAMES, k)} AS c{k}" for k in (0, 2, 4, 6, 8)])
    c = F.col
    return p.select("id", identity.gene_of_file(c("c0")).alias("gene"), identity.doi_of_link(c("c2")).alias("doi"), identity.publisher_item(c("c4")).alias("item"), identity.count_type(c("c6")).alias("kind"), identity.year(c("c8")).alias("year"))


@query(f"SELECT c_custkey AS id, {_pick('c_custkey', PLACES, 4)} AS ancestry, {_pick('c_custkey', PLACES, 5)} AS origin FROM customer")
def ancestry_and_origin(spark, sf):
    from factloom.functions.links import country

    p = table(spark, sf, "customer").selectExpr("c_custkey AS id", *[f"{_pick('c_custkey', PLACES, k)} AS c{k}" for k in range(4)])
    c = F.col
    near = F.element_at(F.create_map(*[F.lit(x) for pair in COUNTRIES.items() for x in pair]), country(c("c3"), tuple(COUNTRIES)))
    origin = identity.origin_precedence(c("c1"), identity.origin(COUNTRIES, c("c2")), near)
    return p.select("id", F.coalesce("c0", identity.ancestry(c("c2"))).alias("ancestry"), origin.alias("origin"))


_JSON = "'{\"rows\": [{\"PMID\": ' || o_orderkey || ', \"x\": {\"pubmed_id\": \"' || o_custkey || '\"}}, {\"pubmedId\": \"none\", \"pmids\": 7}], \"pmid\": \"123456789\"}'"


@query("SELECT o_orderkey AS id, CASE WHEN CAST(o_orderkey AS VARCHAR) = CAST(o_custkey AS VARCHAR) THEN CAST(o_orderkey AS VARCHAR) ELSE least(CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR)) || ',' || greatest(CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR)) END AS ids, '{\"k\": ' || o_custkey || '}' AS answer, CASE WHEN o_orderkey % 2 = 0 THEN 'llm_table,figure,llm_text' ELSE 'llm_table' END AS observed FROM orders")
def json_ids_and_answers(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS id", f"{_JSON} AS j", "CASE o_orderkey % 3 WHEN 0 THEN '```json\n{\"k\": ' || o_custkey || '}\n```' WHEN 1 THEN 'Here it is: {\"k\": ' || o_custkey || '} as asked' ELSE '{\"k\": ' || o_custkey || '}' END AS a", "CASE WHEN o_orderkey % 2 = 0 THEN 'figure, llm_text' END AS seen")
    witness = identity.layer_witness(F.lit("llm_table"), F.col("seen"), F.lit("llm_table"))
    return o.select("id", F.array_join(identity.ids_in_json(F.col("j")), ",").alias("ids"), identity.answer_object(F.col("a")).alias("answer"), witness["observed"].alias("observed"))


@query(f"""WITH facts AS ({FACTS_SQL}), s AS (SELECT variant, first(layer ORDER BY paper, line, layer) AS layer, CAST(sum(carriers) AS BIGINT) AS total, CAST(sum(affected) AS BIGINT) AS affected, count(DISTINCT paper) AS n_papers FROM facts GROUP BY 1)
SELECT *, affected * 100 / CAST(nullif(total, 0) AS DOUBLE) AS percentage, row_number() OVER (PARTITION BY variant % 50 ORDER BY coalesce(total, 0) DESC, coalesce(affected * 100 / CAST(nullif(total, 0) AS DOUBLE), 0) DESC, variant) AS place FROM s""")
def variant_summary(spark, sf):
    s = rollups.variant_summary(facts(spark, sf), ["variant"], "paper", "carriers", "affected", F.struct("paper", "line"), ["layer"]).drop("papers")
    s = s.withColumn("n_papers", F.col("n_papers").cast("long")).withColumn("_gene", F.col("variant") % 50)
    return rollups.ranked(s, ["_gene"], [*rollups.summary_order(), F.col("variant").asc()], "place").drop("_gene")


_VERDICTS = ["TP", " real ", "fp", "junk", "?", "", None, "maybe", "confirm"]


@query(f"""WITH s AS (SELECT l_suppkey AS who, lower(trim(coalesce({_cases("(l_orderkey + l_linenumber)", _VERDICTS)}, ''))) AS v FROM lineitem), t AS (
SELECT who, count(*) FILTER (v IN ('tp', 'real', 'confirm')) AS tp, count(*) FILTER (v IN ('fp', 'junk')) AS fp, count(*) FILTER (v = '?') AS unsure, count(*) FILTER (v = '') AS blank, count(*) FILTER (v = 'maybe') AS unrecognised FROM s GROUP BY 1),
p AS (SELECT *, tp / CAST(nullif(tp + fp, 0) AS DOUBLE) AS precision, CAST(nullif(tp + fp, 0) AS DOUBLE) AS n FROM t)
SELECT who, tp, fp, unsure, blank, unrecognised, precision, greatest(0.0, (precision + 3.8416 / (2 * n) - 1.96 * sqrt(precision * (1 - precision) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)) AS low,
  least(1.0, (precision + 3.8416 / (2 * n) + 1.96 * sqrt(precision * (1 - precision) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)) AS high FROM p""")
def verdict_tally(spark, sf):
    s = table(spark, sf, "lineitem").selectExpr("l_suppkey AS who", f"{_cases('(l_orderkey + l_linenumber)', _VERDICTS)} AS verdict")
    return rollups.tally_verdicts(s, "verdict", ["who"])


_RISK = "CASE line % 4 WHEN 0 THEN 'quarantine' ELSE 'trusted' END AS tier, CASE line % 3 WHEN 0 THEN '[]' WHEN 1 THEN '[\"x\"]' END AS reasons, CASE line % 2 WHEN 0 THEN ' ' ELSE '\"said so\"' END AS quotes"


@query(f"""WITH facts AS ({FACTS_SQL}), r AS (SELECT *, {_RISK} FROM facts WHERE carriers IS NOT NULL OR affected IS NOT NULL),
g AS (SELECT paper, count(*) AS n, bool_or(tier = 'quarantine') AS q, bool_or(coalesce(reasons, '') NOT IN ('', '[]')) AS any_r, count(*) FILTER (trim(quotes) <> '') AS s, count(DISTINCT carriers_count_type) AS roles FROM r GROUP BY 1)
SELECT o_orderkey AS paper, coalesce(n, 0) AS n_facts, coalesce(q, false) AS any_quarantine, coalesce(any_r, false) AS any_reason, coalesce(s / n, 0.0) AS quoted, coalesce(roles, 0) AS n_roles, o_orderpriority AS confidence FROM orders LEFT JOIN g ON paper = o_orderkey""")
def risk_views(spark, sf):
    rows = facts(spark, sf).selectExpr("*", *_RISK.split(", CASE")[:1], *["CASE" + x for x in _RISK.split(", CASE")[1:]])
    o = table(spark, sf, "orders")
    runs = o.selectExpr("o_orderkey AS paper", "1 AS run", "'old' AS confidence").unionByName(o.selectExpr("o_orderkey AS paper", "2 AS run", "o_orderpriority AS confidence"))
    return rollups.risk_views(o.selectExpr("o_orderkey AS paper"), rows, runs, "paper", ["carriers", "affected"], "tier", "reasons", "quotes", "carriers_count_type", "run", "confidence")


@query("""SELECT n_name AS gene, count(*) AS in_corpus, count(*) FILTER (c_mktsegment = 'BUILDING') AS usable, count(*) FILTER (c_mktsegment <> 'BUILDING') AS stub, count(*) FILTER (c_custkey % 3 > 0) AS with_figures, count(*) FILTER (c_custkey % 5 > 2) AS with_supplements
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def gene_stats(spark, sf):
    n = table(spark, sf, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS gene")
    c = table(spark, sf, "customer").selectExpr("c_nationkey", "CASE WHEN c_mktsegment = 'BUILDING' THEN 'ok' ELSE 'stub' END AS status", "c_custkey % 3 AS figures", "CASE WHEN c_custkey % 5 > 2 THEN 1 ELSE 0 END AS supplements")
    return rollups.gene_stats(c.join(n, "c_nationkey"), "gene", "status", "figures", "supplements")


@query("""WITH s AS (SELECT lang, length(text) AS a, length(trim(left(text, 500))) AS b FROM documents WHERE text IS NOT NULL), g AS (SELECT lang, count(*) AS n, avg(CASE WHEN a > 0 THEN 100 - 100 * b / a ELSE 0.0 END) AS reduction FROM s GROUP BY 1)
SELECT lang, n, CAST(floor(n * 100 / (SELECT sum(n) FROM g)) AS BIGINT) AS percent, reduction FROM g""")
def class_stats(spark, sf):
    d = table(spark, sf, "documents").where("text IS NOT NULL").select("lang", F.length("text").alias("a"), F.length(F.trim(F.left("text", F.lit(500)))).alias("b"))
    return rollups.class_stats(d, "lang", "a", "b")


_WIDE = ["Overall  cohort of patients", "median age of the group", "a single proband here", "short 5%", None, "average in all carriers"]


@query(f"""WITH r AS (SELECT l_suppkey AS paper, l_orderkey AS o, l_linenumber AS line, {_cases("l_partkey", _WIDE)} AS t, l_returnflag = 'R' AS exempt FROM lineitem),
f AS (SELECT *, CASE WHEN NOT exempt AND length(trim(regexp_replace(t, '\\s+', ' ', 'g'))) >= 16 AND regexp_matches(t, '(?i)\\b(overall|cohort|study population|entire|all carriers|median|mean|average|percent)\\b|%') THEN lower(trim(regexp_replace(t, '\\s+', ' ', 'g'))) END AS k FROM r),
n AS (SELECT *, k IS NOT NULL AND count(*) OVER (PARTITION BY paper, k) >= 5 AS cleared FROM f) SELECT paper, o, line, CASE WHEN NOT cleared THEN t END AS t, cleared FROM n""")
def repeated_text_suppression(spark, sf):
    r = table(spark, sf, "lineitem").selectExpr("l_suppkey AS paper", "l_orderkey AS o", "l_linenumber AS line", f"{_cases('l_partkey', _WIDE)} AS t", "l_returnflag = 'R' AS exempt")
    return rollups.suppress_repeated_text(r, "paper", "t", F.col("exempt")).drop("exempt")


_LINE = "CASE o_orderkey % 4 WHEN 0 THEN '{\"n\": ' || o_orderkey || '}' WHEN 1 THEN '[]' WHEN 2 THEN '{\"n\": ' ELSE ' {\"n\": ' || o_custkey || '}' END"


@query(f"SELECT o_custkey AS gene, arg_max(line, o_orderkey) AS line FROM (SELECT *, {_LINE} AS line FROM orders WHERE o_orderkey % 4 IN (0, 3)) GROUP BY 1")
def previous_snapshot(spark, sf):
    return rollups.previous_snapshot(table(spark, sf, "orders").selectExpr("o_custkey AS gene", "o_orderkey AS at", f"{_LINE} AS line"), "gene", "at", "line")


@query("SELECT p_partkey AS variant, (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_partkey = p_partkey) AS n_papers FROM part")
def papers_per_variant(spark, sf):
    links = table(spark, sf, "lineitem").selectExpr("l_partkey AS variant", "l_suppkey AS paper")
    return rollups.paper_counts(table(spark, sf, "part").selectExpr("p_partkey AS variant"), links, "variant", "paper")


@query("SELECT o_orderkey AS id, o_totalprice AS price FROM orders ORDER BY CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END IS NULL, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END DESC, o_orderkey LIMIT 50")
def top_nulls_last(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_totalprice AS price", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS k")
    return o.orderBy(*rollups.nulls_last("k"), "id").limit(50).select("id", "price")


_UNMATCHED = [
    ("p.A10V", "c.1A>G", None, "novel_in_range"), ("p.V10A", "", None, "wrong_gene_residue_mismatch"), ("p.L10A", "", None, "residue_offset_suspect"), ("W10*", "", None, "residue_unverified"), ("p.A900V", "", None, "misparse_out_of_range"),
    ("", "c.5del", "185delAG", "legacy_source_notation"), (None, "c.5del", "", "cdna_only_unmatched"), ("", "", None, "no_notation_suspect"), ("p.odd", "", None, "no_notation_suspect"), ("A77V", "", None, "novel_in_range"),
]


@query(f"SELECT p_partkey AS id, {_pick('p_partkey', _UNMATCHED, 3)} AS class FROM part")
def unmatched_classes(spark, sf):
    own, others = (F.create_map(*[F.lit(x) if isinstance(x, int) else F.array(*map(F.lit, x)) for pair in m.items() for x in pair]) for m in ({10: ["A", "G"], 12: ["L"]}, {10: ["V"]}))
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", *[f"{_pick('p_partkey', _UNMATCHED, k)} AS c{k}" for k in range(3)])
    return p.select("id", rollups.unmatched_class(F.col("c0"), F.col("c1"), F.col("c2"), F.lit(500), own, others).alias("class"))


@query("""WITH r AS (SELECT c_custkey AS id, CASE c_nationkey % 3 WHEN 0 THEN 'G1' WHEN 1 THEN 'G2' ELSE 'G3' END AS gene, c_custkey % 40 AS paper, 'A' || (c_custkey % 90 + 1) || 'V' AS v, CASE c_custkey % 5 WHEN 0 THEN 'confirm' WHEN 1 THEN 'correct_counts' WHEN 2 THEN 'wrong_paper' WHEN 3 THEN 'hm' END AS verdict FROM customer),
x AS (SELECT CASE s_nationkey % 2 WHEN 0 THEN 'G1' ELSE 'G2' END AS gene, s_suppkey % 40 AS paper, 'A' || (s_suppkey % 90 + 1) || 'V' AS v, CAST(sum(s_suppkey) AS BIGINT) AS carriers FROM supplier GROUP BY 1, 2, 3)
SELECT id, gene, CASE verdict WHEN 'confirm' THEN 'gold_confirmed' WHEN 'correct_counts' THEN 'count_override' WHEN 'wrong_paper' THEN 'excluded' ELSE 'followup_other' END AS action, CASE WHEN gene = 'G3' THEN 'no_db' WHEN carriers IS NULL THEN 'unmatched' ELSE 'matched' END AS match_status, carriers
FROM r LEFT JOIN x USING (gene, paper, v)""")
def review_overlay(spark, sf):
    from factloom.functions.notation import match_key

    reviews = table(spark, sf, "customer").selectExpr("c_custkey AS id", "CASE c_nationkey % 3 WHEN 0 THEN ' g1' WHEN 1 THEN 'G2' ELSE 'g3 ' END AS gene", "concat(c_custkey % 40, '.0') AS pmid", "concat('p.Ala', c_custkey % 90 + 1, 'Val') AS source_notation", "CASE c_custkey % 5 WHEN 0 THEN 'Confirm' WHEN 1 THEN ' correct_counts' WHEN 2 THEN 'wrong_paper' WHEN 3 THEN 'hm' END AS verdict")
    x = table(spark, sf, "supplier").selectExpr("CASE s_nationkey % 2 WHEN 0 THEN 'G1' ELSE 'G2' END AS gene", "CAST(s_suppkey % 40 AS STRING) AS pmid", "concat('A', s_suppkey % 90 + 1, 'V') AS v", "s_suppkey")
    x = x.groupBy("gene", "pmid", match_key(F.col("v")).alias("key")).agg(F.sum("s_suppkey").cast("long").alias("carriers"))
    known = spark.createDataFrame([("G1",), ("G2",)], "gene string")
    return rollups.review_overlay(reviews, x, known).select("id", "gene", "action", "match_status", "carriers")


@query("SELECT l_suppkey AS paper, min(l_orderkey * 10 + l_linenumber) AS at, CASE WHEN l_partkey % 4 > 0 THEN 'http://x/' || l_partkey % 20 END AS url, CASE WHEN l_partkey % 4 = 0 THEN 'h' || l_partkey % 7 END AS own FROM lineitem GROUP BY 1, 3, 4")
def distinct_links(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_suppkey AS paper", "l_orderkey * 10 + l_linenumber AS at", "CASE WHEN l_partkey % 4 > 0 THEN concat('http://x/', l_partkey % 20) END AS url", "concat('h', l_partkey % 7) AS href")
    out = rollups.distinct_links(rows, "paper", "url", "href", "at")
    return out.select("paper", "at", "url", F.when(F.col("url").isNull(), F.col("href")).alias("own"))


@query(f"""WITH facts AS ({FACTS_SQL}), g AS (SELECT supplier, count(*) FILTER (line <= 3 AND line < 2) AS missed, count(*) FILTER (line > 3) AS extra FROM facts GROUP BY 1) SELECT supplier, missed, extra, s_name AS name FROM g JOIN supplier ON s_suppkey = supplier WHERE missed + extra > 0""")
def paper_disagreement(spark, sf):
    names = table(spark, sf, "supplier").selectExpr("s_suppkey AS supplier", "s_name AS name")
    return rollups.paper_disagreement(facts(spark, sf), names, "supplier", F.col("line") <= 3, F.col("line") >= 2)


@query("SELECT o_orderstatus AS code, count(*) AS n FROM orders GROUP BY 1")
def failure_counts(spark, sf):
    return rollups.count_by(table(spark, sf, "orders").selectExpr("o_orderstatus AS code"), "code")


@query("SELECT o_orderkey AS id, o_orderpriority AS priority FROM orders WHERE o_orderstatus = 'P'")
def priority_export(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_orderpriority AS priority", "o_orderdate AS added", "o_orderstatus AS status")
    return rollups.queue_export(o, "status", "P", "priority", "added").select("id", "priority")
