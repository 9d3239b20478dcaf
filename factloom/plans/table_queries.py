"""Registered queries of table layouts, file formats and unknown catalogs, with the SQL of what they must find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators import documents, layouts
from factloom.plans.queries import query
from factloom.session import table
from factloom.sources import catalog, formats

#: Parts of a brand as rows of a table: gene, change, counts.
PARTS = {
    "id": "p_partkey",
    "doc": "p_brand",
    "gene": "CASE p_size % 4 WHEN 0 THEN 'GENE2' ELSE 'GENE1' END",
    "change": "CASE p_partkey % 3 WHEN 0 THEN 'p.Ala' || (p_partkey % 300 + 10) || 'Val' WHEN 1 THEN 'R' || (p_partkey % 300 + 10) || 'W' ELSE 'p.Gly' || (p_partkey % 300 + 10) || 'Asp' END",
    "short": "CASE p_partkey % 3 WHEN 0 THEN 'A' || (p_partkey % 300 + 10) || 'V' WHEN 1 THEN 'R' || (p_partkey % 300 + 10) || 'W' ELSE 'G' || (p_partkey % 300 + 10) || 'D' END",
    "carriers": "CAST(p_size AS INT)",
    "affected": "CAST(p_size % 5 AS INT)",
}
PARTS_SQL = "SELECT " + ", ".join(f"{e} AS {a}" for a, e in PARTS.items()) + " FROM part"


def parts(spark, sf) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*[f"{e} AS {a}" for a, e in PARTS.items()])


def _written(rows: DataFrame, line: Column, head: str, tail: str = "") -> DataFrame:
    """One text per document: a head, the lines in order, a tail."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", line.alias("line")))), lambda x: x["line"]), "\n")
    return rows.groupBy("doc").agg(F.concat(F.lit(head), body, F.lit(tail)).alias("text"))


_COUNTED = f"WITH p AS ({PARTS_SQL}) SELECT doc, short AS variant, CAST(sum(carriers) AS BIGINT) AS carriers, CAST(sum(affected) AS BIGINT) AS affected FROM p WHERE gene = 'GENE1' GROUP BY 1, 2"
_cell = lambda name: F.col(name).cast("string")


def _facts(tables: DataFrame) -> DataFrame:
    return layouts.table_facts(tables, "gene1", ["doc"]).select("doc", "variant", "carriers", "affected")


@query(_COUNTED)
def pipe_table_facts(spark, sf):
    """Pipe rows, some of them wrapped over two lines."""
    line = F.concat(F.lit("| "), F.col("gene"), F.lit(" | "), F.col("change"), F.when(F.col("id") % 4 == 0, "\n   more").otherwise(""), F.lit(" | "), _cell("carriers"), F.lit(" patients | "), _cell("affected"), F.lit(" |"))
    line = F.replace(line, F.lit("\n   more |"), F.lit(" |\n   "))
    docs = _written(parts(spark, sf), line, "Intro.\n\nTable 1 Variants\n\n| Gene | Variant | No. of carriers | Affected |\n|---|---|---|---|\n", "\n\nEnd")
    return _facts(layouts.read_tables(docs, layouts.pipe_tables, "doc"))


@query(_COUNTED)
def fixed_width_facts(spark, sf):
    line = F.concat(F.rpad("gene", 12, " "), F.rpad("change", 20, " "), F.rpad(_cell("carriers"), 14, " "), _cell("affected"))
    head = "Words before.\n\nTable 2 Variants in GENE1\n" + "Gene".ljust(12) + "Mutation".ljust(20) + "Carriers".ljust(14) + "Affected\n"
    return _facts(layouts.read_tables(_written(parts(spark, sf), line, head, "\n\nplain words after it"), layouts.fixed_width_tables, "doc"))


@query(_COUNTED)
def vertical_facts(spark, sf):
    """One cell per line, by way of the rebuilt pipe tables."""
    line = F.concat_ws("\n", "gene", "change", _cell("carriers"), _cell("affected"))
    docs = _written(parts(spark, sf), line, "Some text.\n\nTable S1 Compendium of mutations\nGene\nMutation\nNumber of carriers\nAffected\n", "\n\nAfter.")
    return _facts(layouts.read_tables(layouts.rebuilt(docs, "doc"), layouts.pipe_tables, "doc"))


@query(f"WITH p AS ({PARTS_SQL}) SELECT doc, short AS variant, count(*) AS carriers FROM p GROUP BY 1, 2")
def mention_rows(spark, sf):
    """Rows whose header names no column for the change, one person each."""
    line = F.concat(F.lit("| F"), _cell("id"), F.lit(" | has "), F.col("change"), F.lit(" in exon 2 | well |"))
    docs = _written(parts(spark, sf), line, "Table 3\n| Patient | Finding | Status |\n|---|---|---|\n")
    found = layouts.table_facts(layouts.read_tables(docs, layouts.pipe_tables, "doc"), "GENE1", ["doc"])
    return found.select("doc", "variant", "carriers")


@query(f"WITH p AS ({PARTS_SQL}) SELECT doc, 1 AS table_no, 'Table 1 Variants' AS caption, count(*) AS n_rows FROM p GROUP BY 1")
def repeated_tables(spark, sf):
    """A table that a text has twice is used once."""
    line = F.concat(F.lit("| "), F.col("change"), F.lit(" | "), _cell("carriers"), F.lit(" |"))
    head = "Table 1 Variants\n| Variant | Carriers |\n|---|---|\n"
    docs = _written(parts(spark, sf), line, head).withColumn("text", F.concat("text", F.lit("\n\nagain\n\n"), F.replace("text", F.lit("| Variant"), F.lit("|  VARIANT"))))
    found = layouts.distinct_tables(documents.tables(docs, "doc"), ["doc"])
    return found.select("doc", "table_no", "caption", F.size("rows").cast("long").alias("n_rows"))


@query(f"WITH p AS ({PARTS_SQL}) SELECT doc, 5 AS first, CAST(5 + count(*) AS INT) AS last, count(*) + 1 AS n_rows, count(*) AS mentions FROM p GROUP BY 1 HAVING count(*) >= 2")
def pseudo_table_zones(spark, sf):
    line = F.concat(F.rpad("gene", 12, " "), F.rpad("change", 20, " "), F.rpad(_cell("carriers"), 14, " "), _cell("affected"))
    docs = _written(parts(spark, sf), line, "Two  gaps\nbut  short\n\nWords.\nTable 2\nGene        Mutation            Carriers      Affected\n", "\nplain words after it")
    found = layouts.pseudo_zones(docs, "doc")
    return found.select("doc", "first", "last", F.col("rows").alias("n_rows"), "mentions")


@query("SELECT doc, table_no, header, n_rows, total FROM (WITH p AS (" + PARTS_SQL + ") SELECT doc, 1 AS table_no, 'Gene;Variant;Carriers;Affected cases' AS header, CAST(count(*) AS INT) AS n_rows, CAST(sum(carriers) AS BIGINT) AS total FROM p GROUP BY 1)")
def made_doc_tables(spark, sf):
    """documents.tables and documents.table_counts over texts that have tables."""
    line = F.concat(F.col("gene"), F.lit(" | "), F.col("change"), F.lit(" | "), _cell("carriers"), F.lit(" of 99 | "), _cell("affected"))
    found = documents.tables(_written(parts(spark, sf), line, "Gene | Variant | Carriers | Affected cases\n--- | --- | --- | ---\n"), "doc")
    counted = documents.table_counts(found, ["doc", "table_no"]).where("role = 'carriers'").select("doc", "table_no", "total")
    return found.join(counted, ["doc", "table_no"]).select("doc", "table_no", F.array_join("header", ";").alias("header"), F.size("rows").alias("n_rows"), "total")


@query(f"WITH p AS ({PARTS_SQL}) SELECT doc, short AS normalized, CAST(sum(CASE WHEN change LIKE 'p.%' THEN 2 ELSE 1 END) AS BIGINT) AS n FROM p GROUP BY 1, 2")
def made_mentions(spark, sf):
    """n counts the hits of all patterns; p.Ala1Val is one of two."""
    line = F.concat(F.lit("We saw "), F.col("change"), F.lit(" in one family."))
    return documents.mentions(_written(parts(spark, sf), line, ""), "doc").select("doc", "normalized", "n")


@query("SELECT p_partkey AS page_id, unnest(['Table 1. ' || p_brand, 'Figure & more']) AS caption FROM part")
def made_captions(spark, sf):
    pages = table(spark, sf, "part").select(F.col("p_partkey").alias("page_id"), F.concat(F.lit("<table><CAPTION class=x>Table 1.\n<b>"), F.col("p_brand"), F.lit("</b></CAPTION></table><figcaption>Figure & more</figcaption><figcaption>Figure &  more</figcaption>")).alias("html"))
    return documents.captions(pages).select("page_id", "caption")


# ---- formats


def _zip(named: list[tuple[str, str]]) -> bytes:
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, text in named:
            archive.writestr(zipfile.ZipInfo(name), text)
    return out.getvalue()


def _files(brand: str, n: int) -> list[tuple[str, bytes]]:
    """The same little report in every format."""
    xml = f"<article><front><journal-meta>J</journal-meta><article-title>T {brand}</article-title></front><body><sec><title>Methods &amp; more</title><p>We   saw <i>{n}</i>.</p><table><tr><th>a|b</th><th>c</th></tr><tr><td>{n}</td></tr></table></sec></body><ref-list><p>no</p></ref-list></article>"
    html = f"<html><head><style>x</style></head><body><nav>menu</nav><h2>T {brand}</h2><p>We saw <i>{n}</i>.<table><tr><th>a<th>c</tr><tr><td>{n}</td><td></td></tr></table></body></html>"
    word = f"<w:document xmlns:w='w'><w:body><w:p><w:r><w:t>T {brand}</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>{n}</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"
    book = [("xl/workbook.xml", "<workbook><sheets><sheet name='One'/></sheets></workbook>"), ("xl/sharedStrings.xml", f"<sst><si><t>T </t><t>{brand}</t></si></sst>"), ("xl/worksheets/sheet1.xml", f"<worksheet><sheetData><row><c r='A1' t='s'><v>0</v></c></row><row><c r='B2'><v>{n}</v></c></row></sheetData></worksheet>")]
    made = [("a.xml", xml.encode()), ("a.html", html.encode()), ("a.docx", _zip([("word/document.xml", word)])), ("a.xlsx", _zip(book)), ("a.csv", f'h,"x, y"\n{n},\n'.encode()), ("a.bin", b"\x00"), ("bad.xml", b"<a>")]
    return [*made, ("b.zip", _zip([("in/c.txt", f"plain {brand}"), (".hidden", "x"), ("d.tsv", f"k\tv\n1\t{n}")]))]


_EXPECTED = (
    ("a.xml", "'# T ' || b || E'\\n\\n## Methods & more\\n\\nWe saw ' || n || E'.\\n\\n| a/b | c |\\n| --- | --- |\\n| ' || n || ' |  |'", "NULL"),
    ("a.html", "'## T ' || b || E'\\n\\nWe saw ' || n || E'.\\n\\n| a | c |\\n| --- | --- |\\n| ' || n || ' |  |'", "NULL"),
    ("a.docx", "'T ' || b || E'\\n\\n| a | ' || n || E' |\\n| --- | --- |'", "NULL"),
    ("a.xlsx", "E'## One\\n\\n| T ' || b || E' |  |\\n| --- | --- |\\n|  | ' || n || ' |'", "NULL"),
    ("a.csv", "E'| h | x, y |\\n| --- | --- |\\n| ' || n || ' |  |'", "NULL"),
    ("a.bin", "NULL", "'unknown format'"),
    ("bad.xml", "NULL", "'ParseError'"),
    ("b.zip!in/c.txt", "'plain ' || b", "NULL"),
    ("b.zip!d.tsv", "E'| k | v |\\n| --- | --- |\\n| 1 | ' || n || ' |'", "NULL"),
)


@query("WITH p AS (SELECT p_brand AS b, count(*) AS n FROM part GROUP BY 1) " + " UNION ALL ".join(f"SELECT b || '/{path}' AS path, {text} AS text, {problem} AS problem FROM p" for path, text, problem in _EXPECTED))
def formats_to_text(spark, sf):
    import pyarrow as pa

    brands = table(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))

    def write(batches):
        for batch in batches:
            made = [(f"{b}/{path}", content) for b, n in zip(*(c.to_pylist() for c in batch.columns), strict=True) for path, content in _files(b, n)]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in made], pa.string()), pa.array([c for _, c in made], pa.binary())], names=["path", "content"])

    return formats.to_text(brands.mapInArrow(write, "path string, content binary"))


@query("SELECT p_partkey AS at, 'D, \"' || p_size || '\"' AS disease FROM part WHERE p_partkey > 3 AND p_size % 4 = 1")
def curation_rows(spark, sf):
    line = F.when(F.col("p_partkey") <= 2, F.lit('"BANNER","GENE SYMBOL"')).when(F.col("p_partkey") == 3, F.lit('"GENE SYMBOL","DISEASE LABEL"')).when(F.col("p_size") % 4 == 0, F.lit('"+++","+++"'))
    line = line.otherwise(F.concat(F.when(F.col("p_size") % 4 == 1, '"gene1",').otherwise('"GENE2",'), F.lit('"D, ""'), F.col("p_size").cast("string"), F.lit('"""')))
    lines = table(spark, sf, "part").select(F.col("p_partkey").alias("at"), line.alias("line"))
    return formats.curation_rows(lines, "line", "at", "Gene1").select("at", F.col("cells")[1].alias("disease"))


# ---- catalogs

_PENETRANCE = {
    "pmid": "l_orderkey",
    "variant_id": "l_partkey",
    "total_carriers_observed": "CAST(CASE WHEN l_linenumber % 3 > 0 THEN l_quantity END AS INT)",
    "affected_count": "CAST(l_linenumber AS INT)",
    "unaffected_count": "CAST(CASE WHEN l_linenumber % 2 = 0 THEN 3 END AS INT)",
    "trust_tier": "CASE WHEN l_suppkey % 3 = 0 THEN 'quarantine' ELSE 'trusted' END",
    "field_trust": "CASE l_suppkey % 5 WHEN 0 THEN '{\"carriers_total\": \"quarantine\"}' WHEN 1 THEN '' WHEN 2 THEN '{bad' WHEN 3 THEN '{}' END",
}
_PEN_SQL = "SELECT " + ", ".join(f"{e} AS {a}" for a, e in _PENETRANCE.items()) + " FROM lineitem WHERE l_linenumber <= 3"
_RECORD_SQL = "SELECT l_orderkey AS pmid, l_partkey AS variant_id, CASE l_suppkey % 3 WHEN 0 THEN 'Affected' WHEN 1 THEN 'unaffected' ELSE 'uncertain' END AS affected_status FROM lineitem WHERE l_linenumber IN (3, 4, 5)"
_MASK = "(CASE WHEN l_suppkey % 5 = 0 THEN {} WHEN l_suppkey % 5 = 3 THEN false ELSE l_suppkey % 3 = 0 END)"


@query(f"""WITH pen AS (SELECT l_orderkey AS pmid, l_partkey AS variant_id, CASE WHEN NOT {_MASK.format("true")} THEN {_PENETRANCE["total_carriers_observed"]} END AS c, CASE WHEN NOT {_MASK.format("false")} THEN {_PENETRANCE["affected_count"]} END AS a, CASE WHEN NOT {_MASK.format("false")} THEN {_PENETRANCE["unaffected_count"]} END AS u FROM lineitem WHERE l_linenumber <= 3),
p AS (SELECT pmid, variant_id, sum(c) AS c, sum(a) AS a, sum(u) AS u FROM pen GROUP BY 1, 2), rec AS ({_RECORD_SQL}),
r AS (SELECT pmid, variant_id, count(*) AS c, count(*) FILTER (affected_status = 'Affected') AS a, count(*) FILTER (affected_status = 'unaffected') AS u FROM rec GROUP BY 1, 2),
s AS (SELECT DISTINCT l_orderkey AS pmid, l_partkey AS variant_id FROM lineitem)
SELECT CAST(s.pmid AS VARCHAR) AS pmid, 'p.' || s.variant_id AS variant, CAST(CASE WHEN p.pmid IS NOT NULL THEN p.c ELSE r.c END AS INT) AS carriers_total, CAST(CASE WHEN p.pmid IS NOT NULL THEN p.a ELSE r.a END AS INT) AS affected_count, CAST(CASE WHEN p.pmid IS NOT NULL THEN p.u ELSE r.u END AS INT) AS unaffected_count
FROM s LEFT JOIN p ON p.pmid = s.pmid AND p.variant_id = s.variant_id LEFT JOIN r ON r.pmid = s.pmid AND r.variant_id = s.variant_id""")
def catalog_union(spark, sf):
    line = table(spark, sf, "lineitem")
    tables = {
        "variants": table(spark, sf, "part").selectExpr("p_partkey AS variant_id", "concat('p.', p_partkey) AS protein_notation", "CAST(NULL AS STRING) AS cdna_notation"),
        "variant_papers": line.where("l_linenumber > 5").selectExpr("l_orderkey AS pmid", "l_partkey AS variant_id"),
        "penetrance_data": line.where("l_linenumber <= 3").selectExpr(*[f"{e} AS {a}" for a, e in _PENETRANCE.items()]),
        "individual_records": line.where("l_linenumber IN (3, 4, 5)").selectExpr("l_orderkey AS pmid", "l_partkey AS variant_id", "CASE l_suppkey % 3 WHEN 0 THEN 'Affected' WHEN 1 THEN 'unaffected' ELSE 'uncertain' END AS affected_status"),
    }
    return catalog.facts(tables)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS pmid, o_orderpriority AS variant, CAST(o_custkey AS INT) AS carriers_total, CAST(NULL AS INT) AS affected_count, CAST(7 AS INT) AS unaffected_count FROM orders")
def catalog_combined(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS Article_Id", "o_orderpriority AS mutation", "o_custkey AS n_total", "7 AS controls")
    return catalog.add_columns(catalog.facts({"misc": o.limit(0).selectExpr("mutation AS m"), "sheet": catalog.add_columns(o, {"note": "string"})}), {"pmid": "string"})
