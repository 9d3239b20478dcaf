"""Registered queries of rules on single values: each goes through cases whose results are said by hand, one part after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions import counts, identity, links, notation, structure
from factloom.operators import evidence, guards, trust
from factloom.plans.queries import ORACLES, QUERIES, query
from factloom.plans.rollup_queries import _cases
from factloom.session import table


def _rules(name: str, inputs: list[str], outputs: dict[str, str], rows: list[tuple], rule: Callable[..., list[Column]]) -> None:
    """Registers a query whose parts are given the cases in turn; `inputs` and `outputs` have types, a case its inputs, then its results."""
    say = lambda k: _cases("p_partkey", [None if r[k] is None else str(r[k]) for r in rows])
    cast = lambda k, kind: f"CAST({say(k)} AS {kind})"
    sql = "SELECT p_partkey AS id, " + ", ".join(f"{cast(len(inputs) + n, 'VARCHAR' if kind == 'STRING' else kind)} AS {out}" for n, (out, kind) in enumerate(outputs.items())) + " FROM part"

    def run(spark, sf):
        p = table(spark, sf, "part").selectExpr("p_partkey AS id", *[f"{cast(n, kind)} AS c{n}" for n, kind in enumerate(inputs)])
        return p.select("id", *[c.alias(out) for c, out in zip(rule(*[F.col(f"c{n}") for n in range(len(inputs))]), outputs, strict=True)])

    run.__name__ = name
    QUERIES[name], ORACLES[name] = run, sql


_joined = lambda c: F.array_join(c, ",")

_rules(
    "notation_spellings", ["STRING"], {"short": "STRING", "hgvs": "STRING", "canonical": "STRING", "at": "INT", "coding": "STRING"},
    [
        ("p.Ala561Val", "A561V", "p.Ala561Val", "A561V", 561, None), ("a561v", "A561V", "p.Ala561Val", None, 561, None), ("R176W(het)", "R176W", None, None, 176, None), ("R864*", "R864X", "p.Arg864*", "R864X", 864, None),
        ("p.Arg864Ter", "R864X", "p.Arg864*", "R864X", 864, None), ("Ala193fs*46", "A193fsX", "p.Ala193fs*", "A193fsX", 193, None), ("p.Gly628del", None, "p.Gly628del", "G628Del", 628, None), ("c.1682C>T", None, None, None, 1682, "c.1682C>T"),
        ("1231A>G", None, None, None, 1231, "c.1231A>G"), ("185delAG", None, None, "G185Del", 185, None), ("IVS10+4a>g", None, None, "IVS10+4A>G", 10, None), ("p.Asn961=", "N961N", None, None, 961, None), (None, None, None, None, None, None),
    ],
    lambda v: [notation.short_protein(v), notation.hgvs_protein(v), notation.canonical(v), notation.position(v), notation.cdna(v)],
)
_rules(
    "notation_kinds", ["STRING"], {"frameshift": "STRING", "nonsense": "STRING", "deletion": "STRING", "duplication": "STRING", "kind": "STRING", "tidy": "STRING"},
    [
        ("L987fsX10", "L987fsX", None, None, None, "frameshift", "L987fs*10"), ("987fs", "?987fsX", None, None, None, "frameshift", "987fs"), ("R864stop", None, "R864X", None, None, "nonsense", "R864stop"), ("W1001X", None, "W1001X", None, None, "nonsense", "W1001*"),
        ("p. L552del", None, None, None, None, "deletion", "p.L552del"), ("L552_L555del", None, None, "L552_L555del", None, "deletion", "L552_L555del"), ("dup552", None, None, None, "?552dup", "duplication", "dup552"), ("G189ins", None, None, None, None, "insertion", "G189ins"),
        ("c.462_463delAA", None, None, None, None, "deletion", "c.462_463del"), ("IVS9+1", None, None, None, None, "splice", "IVS9+1"), (None, None, None, None, None, "unknown", ""),
    ],
    lambda v: [notation.frameshift(v), notation.nonsense(v), notation.deletion(v), notation.duplication(v), notation.variant_type(v), notation.tidy(v)],
)
_rules(
    "structural_events", ["STRING"], {"event": "STRING", "legacy": "STRING", "folded": "STRING"},
    [
        ("deletion of exons 3-5", "del:exon3-5", None, "deletion of exons 3-5"), ("exon 2 duplication", "dup:exon2", None, "exon 2 duplication"), ("Whole–gene deletion", "del:wholegene", None, "Whole-gene deletion"), ("185delAG", None, "185delAG", "185delAG"),
        ("exons 3 to exon 7 deletion", "del:exon3-7", None, "exons 3 to exon 7 deletion"), (" 3195del3 ", None, "3195del3", " 3195del3 "), ("A‑1", None, None, "A-1"), (None, None, None, None),
    ],
    lambda v: [notation.exon_event(v), notation.legacy(v), notation.unicode_fold(v)],
)
_rules(
    "reference_checks", ["STRING", "STRING", "STRING"], {"verdict": "STRING", "agree": "BOOLEAN"},
    [
        ("p.Ala3Val", "MKAVL", "A3V", "match", True), ("R3W", "MKAVL", "R4W", "mismatch", False), ("A9V", "MKAVL", "A9V", "out_of_range", True), ("c.5A>G", "MKAVL", "c.5A>G", "unknown", True), ("A3V", None, "V3A", "unknown", True), ("c.5A>G", "M", "c.5_6del", "unknown", False),
    ],
    lambda v, s, w: [notation.reference_verdict(v, s), notation.positions_agree(v, w)],
)
_rules(
    "row_gates", ["STRING", "STRING", "STRING", "STRING"], {"junk": "STRING", "artifact": "STRING", "ortholog": "BOOLEAN"},
    [
        ("regex_text", "GENE1", "", "in canine GENE1 cells", "gene_symbol_as_variant", "malformed", True), ("figure", "p.A", None, "GENE1 in the mouse", "short_protein_notation", "malformed", True), ("regex_table", "codon 12 here", "c.1A>G", "human GENE1 in the mouse", "residue_prose", None, False),
        ("llm_text", "GENE1", "", "patients", None, "malformed", False), ("figure", "A9000V", "", "GENE1", None, "out_of_range", False), ("figure", " ", "", None, None, "nameless", False), ("llm_table", "0.05", "", "rat data of GENE1", None, "table artifact", False), ("figure", "A12V", "", "x", None, None, False),
    ],
    lambda layer, protein, coding, text: [guards.junk_reason(layer, protein, coding, F.lit("GENE1")), guards.artifact_reason(protein, coding, F.lit(""), F.lit(1000)), guards.nonhuman_ortholog(text, "GENE1")],
)
_rules(
    "consistency_checks", ["INT", "INT", "INT", "INT", "DOUBLE", "INT", "INT", "INT"], {"facts": "STRING", "person": "STRING"},
    [
        (10, 6, 5, None, None, 50, 60, 40, "error:parts_exceed_total", "onset_after_evaluation,onset_after_diagnosis"), (10, 4, 3, None, 40.0, 50, 40, 60, "warning:parts_below_total", "diagnosis_after_evaluation"), (10, 6, 4, 0, 30.0, 50, 40, 45, "warning:percentage_mismatch", ""), (None, 6, 4, 0, None, None, 40, 30, "", "onset_after_diagnosis"), (0, 0, 0, 0, 10.0, None, None, None, "", ""),
    ],
    lambda t, a, u, x, p, age, onset, diagnosis: [_joined(trust.fact_checks(t, a, u, x, p)), _joined(trust.record_checks(age, onset, diagnosis))],
)
_rules(
    "value_coercion", ["STRING"], {"safe": "INT", "lenient": "INT", "first": "INT", "paper": "STRING", "valid": "BOOLEAN", "text": "STRING", "status": "STRING"},
    [
        ("3.9", 3, 0, 3, "3", False, "3.9", "uncertain"), (" 12 ", 12, 12, 12, "12", False, "12", "uncertain"), ("about 12-15", None, 0, 12, "about 12-15", False, "about 12-15", "uncertain"), ("16470702.0", 16470702, 0, 16470702, "16470702", False, "16470702.0", "uncertain"), ("Patient", None, 0, None, "Patient", False, "Patient", "affected"),
        (" ", None, 0, None, "", False, None, None), (None, None, 0, None, "", False, None, None), ("control", None, 0, None, "control", False, "control", "unaffected"), ("12345678", 12345678, 12345678, 12345678, "12345678", True, "12345678", "uncertain"),
    ],
    lambda v: [counts.safe_int(v), counts.lenient_int(v), counts.first_int(v), counts.normal_id(v), counts.valid_id(v), counts.clean_text(v), counts.affected_status(v)],
)
_rules(
    "count_repairs", ["INT", "INT", "INT", "STRING", "INT"], {"filled": "INT", "checked": "INT", "difference": "INT"},
    [(None, None, 5, "supported", 7, 5, 7, None), (None, 2, 5, "unsupported", 7, None, None, None), (4, None, 5, "supported", None, 4, 4, None), (4, 1, 0, "unsure", 9, 4, 4, 3), (None, None, 0, None, None, None, None, None)],
    lambda total, affected, patients, status, correction: [evidence.fill_total(total, affected, patients), evidence.verified(total, status, correction), counts.count_diff(total, affected)],
)
_rules(
    "quotes_and_places", ["STRING", "STRING"], {"verbatim": "BOOLEAN", "percent": "BOOLEAN", "place": "STRING", "image": "BOOLEAN", "encoded": "STRING", "ids": "STRING", "dois": "STRING"},
    [
        ("We  SAW it", "here we saw\nit", True, False, None, False, "We%20%20SAW%20it", "", ""), ("12.5% of Table S2, row 3", "none", False, True, "S2:3", False, "12.5%25%20of%20Table%20S2%2C%20row%203", "", ""), ("x.PNG", "x.png", True, False, None, True, "x.PNG", "", ""),
        ("PMID: 123, pmid:123", "", False, False, None, False, "PMID%3A%20123%2C%20pmid%3A123", "123", ""), ("see 10.1000/ab.c). and 10.1000/ab.c", "", False, False, None, False, "see%2010.1000%2Fab.c%29.%20and%2010.1000%2Fab.c", "", "10.1000/ab.c"),
    ],
    lambda a, b: [links.verbatim(a, b), links.percentage_quoted(a, F.lit(12.5)), F.concat(links.locator(a)["table"], F.lit(":"), links.locator(a)["row"]), links.image_path(a), links.encode_segment(a), _joined(links.paper_ids(a)), _joined(links.dois(a))],
)
_rules(
    "claim_support", ["BOOLEAN", "BOOLEAN", "BOOLEAN", "BOOLEAN", "STRING"], {"support": "STRING", "layers": "STRING", "primary": "STRING"},
    [(True, False, False, True, "figure, llm_text,figure", "supported", "figure,llm_text", "figure"), (False, False, True, True, " LLM_Table ", "off_target", "LLM_Table", "llm_table"), (False, True, True, False, "odd", "off_target", "odd", None), (False, False, False, None, None, "weak", "", None), (False, True, True, True, "pubtator", "supported", "pubtator", "pubtator")],
    lambda known, near, other, in_range, layers: [guards.specificity(known, near, other, in_range), _joined(links.layer_union(layers)), links.layer_primary(layers)],
)


@query("SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'Body of ' || p_brand ELSE 'Body' END || chr(10) || chr(10) || '<!-- supplement:start -->' || chr(10) || 'S ' || p_size || chr(10) || '<!-- supplement:end -->' || chr(10) AS t FROM part")
def supplement_fold(spark, sf):
    """Folded twice, the second time over an older block: the result is that of folding once."""
    body = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Body of "), "p_brand")).otherwise("Body")
    new = F.concat(F.lit("S "), F.col("p_size").cast("string"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), guards.fold_supplement(guards.fold_supplement(body, F.lit("old")), new).alias("t"))


@query("SELECT l_orderkey AS paper, l_linenumber AS line, l_suppkey AS k, CASE WHEN l_linenumber % 3 = 0 THEN CAST(min(l_suppkey % 7) OVER (PARTITION BY l_orderkey, l_linenumber) AS INT) ELSE CAST(l_quantity AS INT) END AS carriers, CASE WHEN l_linenumber % 3 = 0 THEN 'quarantine' ELSE 'trusted' END AS trust_tier FROM lineitem")
def recovered_counts(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey AS paper", "l_linenumber AS line", "l_suppkey AS k", "CASE WHEN l_linenumber % 3 > 0 THEN CAST(l_quantity AS INT) END AS carriers")
    found = rows.groupBy("paper", "line").agg(F.min(F.col("k") % 7).cast("int").alias("carriers"))
    return evidence.recovered(rows, found, ["paper", "line"], ("carriers",)).select("paper", "line", "k", "carriers", "trust_tier")


@query("""WITH r AS (SELECT p_partkey AS id, CASE WHEN p_size % 3 > 0 THEN 'P' || p_size % 5 END AS protein, CASE WHEN p_size % 3 <> 1 THEN 'C' || CASE WHEN p_size % 5 = 0 THEN p_size % 2 ELSE p_size % 5 + 10 END END AS coding FROM part),
p AS (SELECT protein AS k, min(coding) AS v FROM r WHERE protein IS NOT NULL AND coding IS NOT NULL GROUP BY 1 HAVING count(DISTINCT coding) = 1), c AS (SELECT coding AS k, min(protein) AS v FROM r WHERE protein IS NOT NULL AND coding IS NOT NULL GROUP BY 1 HAVING count(DISTINCT protein) = 1)
SELECT id, coalesce(protein, c.v) AS protein, coalesce(coding, p.v) AS coding FROM r LEFT JOIN p ON p.k = protein LEFT JOIN c ON c.k = coding""")
def notation_backfill(spark, sf):
    r = table(spark, sf, "part").selectExpr("p_partkey AS id", "CASE WHEN p_size % 3 > 0 THEN concat('P', p_size % 5) END AS protein", "CASE WHEN p_size % 3 <> 1 THEN concat('C', CASE WHEN p_size % 5 = 0 THEN p_size % 2 ELSE p_size % 5 + 10 END) END AS coding")
    return evidence.backfill_pairs(r, r.select("protein", "coding").where("protein is not null and coding is not null")).select("id", "protein", "coding")


@query("""WITH v AS (SELECT l_partkey AS variant_key, l_orderkey AS pmid, l_returnflag AS raw FROM lineitem) SELECT variant_key, count(DISTINCT pmid) AS n_papers, count(*) AS n_rows, string_agg(DISTINCT raw, ',' ORDER BY raw) AS spellings FROM v GROUP BY 1""")
def fact_groups(spark, sf):
    v = table(spark, sf, "lineitem").selectExpr("l_partkey AS variant_key", "l_orderkey AS pmid", "l_returnflag AS raw")
    return evidence.group_facts(v).withColumn("spellings", _joined(F.col("spellings")))


@query("""WITH e AS (SELECT l_suppkey AS gene, l_linenumber * 100 AS s, l_linenumber * 100 + 29 + (l_suppkey % 3) AS e FROM lineitem GROUP BY 1, 2, 3), c AS (SELECT *, greatest(least(e, 520) - greatest(s, 150) + 1, 0) AS n FROM e), o AS (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY s) AS exon, coalesce(sum(n) OVER (PARTITION BY gene ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM c)
SELECT gene, CAST(exon AS INT) AS exon, CAST(n AS BIGINT) AS coding_length, CAST(o AS BIGINT) AS offset_, n > 0 AND o % 3 = 0 AND n % 3 = 0 AS in_frame FROM o""")
def exon_records(spark, sf):
    e = table(spark, sf, "lineitem").selectExpr("l_suppkey AS gene", "l_linenumber * 100 AS start", "l_linenumber * 100 + 29 + (l_suppkey % 3) AS end").distinct()
    coding = e.select("gene").distinct().selectExpr("gene", "150 AS cds_start", "520 AS cds_end")
    return structure.exon_records(e, coding).select("gene", "exon", F.col("coding_length").cast("long"), F.col("offset").cast("long").alias("offset_"), "in_frame")


@query("SELECT p_partkey AS id, list_aggregate([1.0, least(10.0, 2.0), least(10.0, 4.0)], 'sum') AS waits, CASE WHEN p_size % 2 = 0 THEN 'GENE 1' END AS alias FROM part")
def retry_and_aliases(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 2 == 0, F.lit("the GENE  1-like")).otherwise("GENE12 XGENE1").alias("t"))
    found = F.nullif(F.regexp_replace(F.regexp_extract("t", identity.alias_pattern(("GENE 1", "G1")), 0), r"\s+", " "), F.lit(""))
    return p.select("id", F.aggregate(identity.retry_waits(4), F.lit(0.0), lambda a, x: a + x).alias("waits"), found.alias("alias"))


