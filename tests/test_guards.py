"""Gates on literal rows."""

from factloom.operators import guards
from pyspark.sql import functions as F


def values(spark, column, cases):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(cases)], "n int, v string").select("n", column(F.col("v")).alias("out")).orderBy("n").collect()
    return [r.out for r in rows]


def test_ortholog_gate(spark):
    given = ["exon 11 of canine BRCA2", "BRCA2 variants in dogs", "human BRCA2 variants assayed in mice", "BRCA2 and DNA repair in yeast", None]
    assert values(spark, lambda c: guards.nonhuman_ortholog(c, "BRCA2"), given) == [True, True, False, False, False]


def test_layers(spark):
    none = F.lit(None).cast("string")
    assert values(spark, lambda c: guards.infer_layer(none, c), ["ClinVar", "Table 2", "figure 1 table", "router table", "text scan", None]) == ["clinvar", "llm_table", "figure", "regex_table", "regex_text", "llm_text"]
    assert values(spark, lambda c: guards.infer_layer(c, F.lit("table")), ["figure, llm_text", "nonsense"]) == ["figure", "llm_table"]
    assert values(spark, lambda c: guards.junk_reason(F.lit("regex_text"), c, none, F.lit("KCNH2")), ["kcn h2", "p.R", "residues 5-9", "R5W", None]) == ["gene_symbol_as_variant", "short_protein_notation", "residue_prose", None, None]
    assert values(spark, lambda c: guards.junk_reason(F.lit("llm_text"), c, none, F.lit("KCNH2")), ["KCNH2"]) == [None]


def test_sanitize(spark):
    form = "protein_notation string, cdna_notation string, legacy_notation string, genomic_position string, variant_class string, structural_description string"
    rows = [("p.(Ala5Val)", "A", None, None, "Point", None), ("0.05", "x", None, None, None, None), (None, None, None, None, "exon_deletion", "exon 3"), ("R5W", "c.13C>T", None, None, "odd", None)]
    out = guards.sanitize(spark.createDataFrame(rows, form)).collect()
    assert [(r.protein_notation, r.cdna_notation, r.variant_class, r.usable) for r in out] == [("p.Ala5Val", None, "point", True), (None, None, None, False), (None, None, "exon_deletion", True), ("R5W", "c.13C>T", None, True)]


def test_target_gene_needs_unanimous_attribution(spark):
    rows = spark.createDataFrame([("A1V", None), ("A2V", None), ("A3V", "OTHER"), ("A4V", "g")], "raw string, gene string")
    said = spark.createDataFrame([("A1V", "X"), ("A2V", "X"), ("A2V", "G")], "raw string, gene string")
    assert {r.raw for r in guards.keep_target_gene(rows, said, "G").collect()} == {"A2V", "A4V"}


def test_claim_score(spark):
    rows = spark.createDataFrame([("regex_table", 120, 100, 10, None, True, None, "auto-detected"), ("llm_text", None, None, None, None, False, None, None), ("llm_text", 3, 2, 1, None, False, "per_variant_carrier", None)], "l string, t int, a int, u int, n int, r boolean, d string, x string")
    c = F.col
    assert [r[0] for r in rows.select(guards.claim_score(c("l"), c("t"), c("a"), c("u"), c("n"), c("r"), c("d"), c("x"))).collect()] == [2 + 7 + 4 + 6 + 5 + 2 + 3, 0, 2]


def test_reference_gate(spark):
    rows = spark.createDataFrame([("G", "A3V"), ("G", "C3V"), ("G", "A99V"), ("H", "A3V")], "gene_symbol string, protein_notation string")
    seq = spark.createDataFrame([("G", "MKA" + "K" * 20)], "gene string, sequence string")
    flagged = {r.protein_notation + r.gene_symbol: r.ref_verdict for r in guards.reference_gate(rows, seq).collect()}
    assert flagged == {"A3VG": "match", "C3VG": "mismatch", "A99VG": "out_of_range", "A3VH": "unknown"}
    assert guards.reference_gate(rows, seq, "drop").count() == 3


def test_final_check_is_idempotent(spark):
    tiered = spark.createDataFrame([(1, ["population_count", "paper_final_check:old"]), (2, [])], "id int, trust_reasons array<string>")
    found = spark.createDataFrame([(2, "HIGH", True, "a", "a", "sum"), (2, "low", True, "a", "a", "x"), (1, "high", False, "a", "a", "y"), (1, "high", True, "a", "b", "z")], "id int, severity string, grounded boolean, source_hash string, current_hash string, code string")
    once = guards.compose_final_check(tiered, found, ["id"])
    twice = guards.compose_final_check(once.drop("trust_tier"), found, ["id"])
    expected = {1: (["population_count"], "quarantine"), 2: (["paper_final_check:sum"], "quarantine")}
    assert {r.id: (r.trust_reasons, r.trust_tier) for r in twice.collect()} == expected


def test_fold_is_idempotent(spark):
    fold = lambda c: guards.fold_supplement(guards.fold_supplement(c, F.lit("S1")), F.lit("S2"))
    assert values(spark, fold, ["body\n"]) == ["body\n\n<!-- supplement:start -->\nS2\n<!-- supplement:end -->\n"]
