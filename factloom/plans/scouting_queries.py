"""Registered queries of texts prepared for reading and of what is found in them, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.operators import documents, layouts, scouting
from factloom.plans.queries import query
from factloom.plans.rollup_queries import _cases
from factloom.plans.table_queries import PARTS_SQL, parts
from factloom.session import table


@query("""WITH d AS (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN replace(left(text, 150), ' ', chr(10)) WHEN doc_id % 3 = 1 THEN ' another abstract ' END AS a FROM documents)
SELECT doc_id, sha256(CASE WHEN trim(a) <> '' AND NOT contains(replace(replace(lower(left(text, 10000)), chr(10), ' '), '  ', ' '), replace(replace(lower(left(trim(a), 200)), chr(10), ' '), '  ', ' '))
THEN '## PUBMED ABSTRACT (Authoritative Source)' || chr(10) || chr(10) || trim(a) || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '## FULL TEXT CONTENT' || chr(10) || chr(10) || text ELSE text END) AS h FROM d""")
def abstract_injection(spark, sf):
    d = table(spark, sf, "documents")
    abstracts = d.selectExpr("doc_id", "CASE WHEN doc_id % 3 = 0 THEN replace(left(text, 150), ' ', chr(10)) WHEN doc_id % 3 = 1 THEN ' another abstract ' END AS abstract")
    return scouting.inject_abstract(d.select("doc_id", "text"), abstracts, "doc_id").select("doc_id", F.sha2("text", 256).alias("h"))


@query("SELECT doc_id, length(CASE WHEN length(text) <= 1000 OR doc_id % 2 = 0 THEN text ELSE left(text, 7) END) AS n FROM documents")
def scout_source_choice(spark, sf):
    d = table(spark, sf, "documents")
    cleaned = F.when(F.col("doc_id") % 2 == 0, "  ").otherwise(F.left("text", F.lit(7)))
    return d.select("doc_id", F.length(scouting.scout_source(F.col("text"), cleaned, 1000)).alias("n"))


_TEXT = "repeat('x', CAST(p_size AS INT) * 20) || CASE WHEN p_partkey % 3 = 0 THEN ' Table 1 ' WHEN p_partkey % 3 = 1 THEN ' Table 2 then a SUPPLEMENT ' ELSE ' none ' END || repeat('y', 400)"
_PART = (600 - 2 * len(scouting.MARK) - len(scouting.MIDDLE) - len(scouting.TRAILING)) // 3
_TAIL = 600 - 2 * len(scouting.MARK) - len(scouting.MIDDLE) - len(scouting.TRAILING) - 2 * _PART
_NL = lambda s: "'" + s.replace("\n", "' || chr(10) || '") + "'"


@query(f"""WITH p AS (SELECT p_partkey AS id, {_TEXT} AS t, CAST(p_size AS INT) * 20 AS n FROM part), a AS (SELECT *, CASE id % 3 WHEN 0 THEN n + 1 WHEN 1 THEN n + 16 ELSE length(t) // 2 END AS pos FROM p)
SELECT id, CASE WHEN length(t) <= 600 THEN t ELSE left(left(t, {_PART}) || {_NL(scouting.MARK + scouting.MIDDLE)} || substr(t, CAST(greatest(pos - {_PART // 2}, 0) AS INT) + 1, {_PART}) || {_NL(scouting.MARK + scouting.TRAILING)} || right(t, {_TAIL}), 600) END AS t FROM a""")
def three_part_truncation(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", f"{_TEXT} AS t")
    return p.select("id", scouting.three_parts(F.col("t"), 600).alias("t"))


@query("""WITH p AS (SELECT p_partkey AS id, CAST(p_size AS INT) AS s FROM part) SELECT id, CASE WHEN s <= 20 THEN 1 ELSE 2 END AS windows,
CASE WHEN s <= 20 THEN repeat('a', 10) || 'GENE1' || repeat('b', s) || 'gene1' || repeat('c', 10) ELSE repeat('a', 10) || 'GENE1' || repeat('b', 10) || chr(10) || '[...]' || chr(10) || repeat('b', 10) || 'gene1' || repeat('c', 10) END AS focused FROM p WHERE id % 4 > 0""")
def gene_windows(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS doc_id", "CASE WHEN p_partkey % 4 > 0 THEN repeat('a', 30) || 'GENE1' || repeat('b', CAST(p_size AS INT)) || 'gene1' || repeat('c', 30) ELSE 'nothing here' END AS text")
    return scouting.gene_windows(p, "Gene1", 10, 500).withColumnRenamed("doc_id", "id")


def _lines(spark, sf, line):
    """One text per brand with a line for every part."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", line.alias("line")))), lambda x: x["line"]), "\n")
    return parts(spark, sf).groupBy("doc").agg(body.alias("text"))


@query(f"WITH p AS ({PARTS_SQL}), d AS (SELECT DISTINCT doc, short FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY CASE WHEN short LIKE 'R%' THEN 1 ELSE 0 END, short) AS k FROM d) SELECT doc, string_agg(short || CASE WHEN short LIKE 'R%' THEN ' [one_letter] (MED)' ELSE ' [hgvs_protein] (HIGH)' END, chr(10) ORDER BY k) AS hints FROM r WHERE k <= 4 GROUP BY 1")
def scan_hints(spark, sf):
    found = documents.mentions(_lines(spark, sf, F.concat(F.lit("We saw "), F.col("change"), F.lit("."))), "doc")
    return scouting.hints(found, "doc", 4)


@query(f"WITH p AS ({PARTS_SQL}) SELECT DISTINCT doc, short AS variant FROM p WHERE id % 3 <> 1 AND id % 5 = 0 AND short NOT LIKE 'G%'")
def scan_additions(spark, sf):
    """Lines of prose with a positive statement count; negative ones, citations, tables and other genes do not."""
    i, change = F.col("id") % 5, F.col("change")
    line = F.when(i == 0, F.concat(F.lit("A carrier of "), change, F.lit(" was identified."))).when(i == 1, F.concat(change, F.lit(" was not found in any patient."))).when(i == 2, F.concat(F.lit("| patient | "), change, F.lit(" |"))).when(i == 3, F.concat(change, F.lit(" found by others [12]"))).otherwise(F.concat(F.lit("GENE2 "), change, F.lit(" was found.")))
    docs = _lines(spark, sf, line).withColumn("text", F.concat(F.lit("On GENE1.\n"), "text"))
    known = parts(spark, sf).where("short LIKE 'G%'").selectExpr("doc", "short AS variant")
    return scouting.scan_additions(docs, known, "GENE1", ("GENE2", "GENE3"), 0.7, "doc").select("doc", "variant")


@query(f"WITH p AS ({PARTS_SQL}) SELECT doc, short AS variant, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes FROM p GROUP BY 1, 2")
def gene_attribution(spark, sf):
    rows = parts(spark, sf).withColumn("line", F.concat(F.lit("| "), F.col("gene"), F.lit(" | "), F.col("change"), F.lit(" |")))
    return scouting.gene_attribution(rows, ("GENE1", "GENE2"), "doc", "line").select("doc", "variant", F.array_join("genes", ",").alias("genes"))


@query(f"WITH p AS ({PARTS_SQL}) SELECT doc, CAST(count(*) AS INT) AS rows, CAST(count(DISTINCT change) AS INT) AS variants, max(carriers) AS carriers, CAST(count(*) AS INT) AS estimate FROM p GROUP BY 1")
def paper_census(spark, sf):
    return scouting.census(_lines(spark, sf, F.concat(F.col("change"), F.lit(" in "), F.col("carriers").cast("string"), F.lit(" patients"))), "doc")


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_size % 4 < 2 OR p_size % 10 < 10 ELSE p_size % 10 < 10 END AS gap, CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 0 END AS expected, 20 AS mentioned FROM part")
def supplement_gap(spark, sf):
    t = "CASE WHEN p_partkey % 2 = 0 THEN 'See Supplementary Table 1, Table S2 and supplementary table 1. ' ELSE '' END || 'We list 20 rare variants and 7 mutations.'"
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", f"{t} AS t", "p_size % 4 AS d", "p_size % 10 AS e")
    return p.select("id", scouting.supplement_gap(F.col("t"), F.col("d"), F.col("e")).alias("g")).select("id", "g.*")


_QUOTES = [("12 carriers were found", True), ("12 of 30 carriers", True), ("30 carriers of 12 screened", False), ("3 of 12 carriers", False), ("codon 12 in carriers", False), ("carriers aged 12 years", False), ("p.A12V carriers", False), ("12 tables", False), (None, False), ("In all, 12 probands harboured it", True), ("12.5 carriers", False)]


@query(f"SELECT p_partkey AS id, CAST({_cases('p_partkey', [str(x[1]) for x in _QUOTES])} AS BOOLEAN) AS supported, CASE WHEN p_size % 2 = 0 THEN 'about A1V here' END AS card FROM part")
def quotes_and_cards(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", f"{_cases('p_partkey', [x[0] for x in _QUOTES])} AS q", "CASE WHEN p_size % 2 = 0 THEN 'a1v' ELSE 'A2V' END AS v")
    return p.select("id", scouting.quote_supports(F.col("q"), F.lit(12), "carriers").alias("supported"), scouting.claim_card(F.lit(" about A1V here "), F.col("v")).alias("card"))


@query("""WITH d AS (SELECT doc_id, text, len(list_distinct(regexp_extract_all(lower(text), '\\b(the|of|and|which)\\b', 1))) AS n FROM documents WHERE doc_id % 5 > 0)
SELECT doc_id, CASE WHEN n >= 2 OR trim(text) = '' THEN 'tier2' ELSE 'tier1' END AS stage, CASE WHEN n >= 2 OR trim(text) = '' THEN CASE WHEN contains(text, 'tion') THEN 'PASS' ELSE 'FAIL' END ELSE 'FAIL' END AS decision FROM d WHERE text IS NOT NULL""")
def tiered_filter(spark, sf):
    d = table(spark, sf, "documents").where("text IS NOT NULL")
    second = lambda t: F.when(F.contains(t, F.lit("tion")), "PASS").otherwise("FAIL")
    return scouting.tiered(d, "doc_id", ("the", "of", "and", "which"), second, d.where("doc_id % 5 = 0")).select("doc_id", "stage", "decision")


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN 'secondary_study' WHEN p_size % 3 = 0 THEN 'wrong_gene' WHEN p_size % 3 = 1 AND p_partkey % 4 = 1 THEN 'gene_ambiguous' END AS skipped FROM part")
def current_study_rows(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey AS id", "CASE p_partkey % 4 WHEN 0 THEN 'Table 1 Previously reported mutations' WHEN 1 THEN 'GENE1 and GENE2' ELSE 'Table 2' END AS caption", "'GENE1' AS source", "CASE p_size % 3 WHEN 0 THEN 'GENE2' WHEN 1 THEN ' ' ELSE 'gene1' END AS gene")
    return scouting.current_study(p, "GENE1", ("GENE1", "GENE2"), "caption", "source", "gene").select("id", "skipped")


@query("SELECT p_partkey AS page_id, unnest([0, 2]) AS place, unnest(['/s/' || p_size || '.PDF', 'x.xlsx?v=1']) AS href, unnest(['Data file', 'B']) AS label FROM part")
def page_supplements(spark, sf):
    h = F.concat(F.lit("<a class=k href='/s/"), F.col("p_size").cast("string"), F.lit(".PDF'>Data <b>file</b></a><a href=\"/s/"), F.col("p_size").cast("string"), F.lit(".PDF#2\">again</a> <A HREF=\"x.xlsx?v=1\">B</A><a href='page.html'>no</a>"))
    return scouting.supplement_links(table(spark, sf, "part").select(F.col("p_partkey").alias("page_id"), h.alias("html")))


@query("SELECT p_partkey AS page_id, '## Captions' || chr(10) || chr(10) || '- One ' || p_size || chr(10) || '- Two' AS block FROM part")
def captions_block(spark, sf):
    h = F.concat(F.lit("<figcaption>One "), F.col("p_size").cast("string"), F.lit("</figcaption><caption>Two</caption>"))
    return scouting.rendered_captions(documents.captions(table(spark, sf, "part").select(F.col("p_partkey").alias("page_id"), h.alias("html"))))


@query(f"WITH p AS ({PARTS_SQL}) SELECT doc, short AS variant, CAST(sum(carriers) AS BIGINT) AS carriers FROM p WHERE gene = 'GENE1' GROUP BY 1, 2")
def routed_tables(spark, sf):
    """Tables of a text, repeated ones once, read by the roles of their headers."""
    line = F.concat(F.lit("| "), F.col("gene"), F.lit(" | "), F.col("change"), F.lit(" | "), F.col("carriers").cast("string"), F.lit(" |"))
    docs = _lines(spark, sf, line).withColumn("text", F.concat(F.lit("Table 1\n| Gene | Variant | Carriers |\n|---|---|---|\n"), "text"))
    docs = docs.withColumn("text", F.concat("text", F.lit("\n\n"), "text"))
    found = layouts.distinct_tables(layouts.read_tables(docs, layouts.pipe_tables, "doc"), ["doc"])
    return layouts.table_facts(found, "GENE1", ["doc"]).groupBy("doc", "variant").agg(F.sum("carriers").alias("carriers"))
