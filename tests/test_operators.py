"""Evidence operators on small literal tables."""

import datetime
import json

import pandas as pd
import pytest

from factloom.functions import counts, links, structure, text
from factloom.operators import documents, evidence, matching, registry, relational, scoring, triage, trust
from factloom.sources import tables as sources
from factloom.streaming import incremental
from pyspark.sql import functions as F


def values(spark, column, cases, kind="string"):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(cases)], f"n int, v {kind}").select("n", column(F.col("v")).alias("out")).orderBy("n").collect()
    return [r.out for r in rows]


def test_numbers_from_text(spark):
    given = ["3.0", "3.9", " 7 ", "about 12-15", "", None, "multiple"]
    assert values(spark, counts.safe_int, given) == [3, 3, 7, None, None, None, None]
    assert values(spark, counts.lenient_int, given) == [0, 0, 7, 0, 0, 0, 0]
    assert values(spark, counts.first_int, given) == [3, 3, 7, 12, None, None, None]
    assert values(spark, counts.normal_id, ["16470702.0", " 12 ", "PMC12", None]) == ["16470702", "12", "PMC12", ""]
    assert values(spark, counts.valid_id, ["1", "123456789", "12a", None]) == [True, False, False, False]
    assert values(spark, counts.affected_status, ["Case", "healthy", "carrier", " ", None]) == ["affected", "unaffected", "uncertain", None, None]


def test_closed_vocabulary_fails_on_unknown(spark):
    check = lambda c: counts.closed_vocabulary(c, ("a", "b"), "status")
    assert values(spark, check, ["a", None]) == ["a", None]
    with pytest.raises(Exception, match="unknown status: z"):
        values(spark, check, ["z"])


def test_authoritative_count_never_falls_back(spark):
    rows = spark.createDataFrame([("adjudicated", None, 5), (None, None, 5), ("adjudicated", 2, 5)], "s string, a int, b int")
    assert [r[0] for r in rows.select(counts.authoritative_count(F.col("s"), F.col("a"), F.col("b"))).collect()] == [None, 5, 2]


FACT = "paper string, carriers int, affected int, unaffected int, uncertain int, study_design string, carriers_count_type string, carriers_source string, affected_source string"


def test_trust_rules(spark):
    facts = [
        ("a", 5, 3, 2, None, None, None, None, None),
        ("a", 200_000, None, None, None, None, None, None, None),
        ("a", 4, 5, None, None, None, None, None, None),
        ("a", 6, 2, 2, 1, None, None, None, None),
        ("b", 3, 3, 0, None, "case_control", None, None, None),
        ("b", -1, None, None, None, None, "family_count", None, None),
        ("b", 9, None, None, None, "gwas", "cohort_total", "count_recovery", "figure_count_repair"),
        ("c", None, None, None, None, "review_meta", None, None, None),
    ]
    out = trust.tier(spark.createDataFrame(facts, FACT), "paper").collect()
    by = {(r.paper, r.carriers): r for r in out}
    assert by["a", 5].trust_reasons == [] and by["a", 5].trust_tier == "trusted"
    assert by["a", 200_000].trust_reasons == ["paper_outlier", "population_count"]
    assert by["a", 4].trust_reasons == ["arith_inconsistent"] and by["a", 6].trust_reasons == ["arith_inconsistent"]
    assert by["b", 3].trust_reasons == ["implied_unaffected_zero"] and by["b", 3].masked_fields == ["unaffected"]
    assert by["b", -1].trust_reasons == ["arith_inconsistent", "family_count_not_carrier", "negative_count"]
    assert by["b", 9].trust_reasons == ["count_is_total", "figure_count_unverified:affected", "recovered_count_unverified", "study_type_mismatch"]
    assert by["c", None].trust_reasons == []
    seen = {r.carriers for r in trust.trusted(trust.tier(spark.createDataFrame(facts, FACT), "paper")).collect() if r.paper == "a"}
    assert seen == {5, None}


def test_outlier_guard_is_inclusive_where_the_trust_rule_is_strict(spark):
    rows = spark.createDataFrame([("p", v) for v in (60, 6, 6, 6, 6)], "paper string, carriers int")
    assert {r.carriers for r in trust.outlier_guard(rows, "paper").collect() if r.outlier} == {60}
    cleared = trust.outlier_guard(rows, "paper", "clear").collect()
    assert sorted((r.carriers or 0, r.raw_carriers or 0) for r in cleared)[0] == (0, 60)
    with pytest.raises(ValueError):
        trust.outlier_guard(rows, "paper", "drop")
    strict = rows.withColumn("affected", F.lit(None).cast("int")).withColumn("unaffected", F.lit(None).cast("int"))
    assert all(r.trust_tier == "trusted" for r in trust.tier(strict, "paper").collect())


def test_phenotype_clears(spark):
    rows = spark.createDataFrame([(4, 4, 0, False, False), (1, 1, 0, False, False), (1, 1, 0, True, False), (None, 2, None, True, False), (5, 3, 1, False, False), (5, 0, None, False, False), (4, 4, 0, False, True)], "c int, a int, u int, f boolean, s boolean")
    out = rows.select(trust.phenotype_clears(F.col("c"), F.col("a"), F.col("u"), F.col("f"), F.col("s"), F.lit(False)).alias("x")).collect()
    assert [[(x.field, x.reason) for x in r.x] for r in out] == [
        [("affected", "copied_carriers_onto_affected"), ("unaffected", "implied_unaffected_zero")],
        [],
        [("affected", "figure_copied_phenotype"), ("unaffected", "figure_copied_phenotype")],
        [("affected", "figure_incomplete_phenotype")],
        [("affected", "partition_does_not_close")],
        [("affected", "unsourced_zero_affected")],
        [],
    ]


def test_suspicious_labels(spark):
    assert values(spark, trust.suspicious_label, ["Patient No.", "gnomAD", " het ", "Total cases", "carriers", None]) == ["row identifier", "population allele frequency/count", "genotype observation count", "cohort denominator", None, None]


def test_text_gates(spark):
    body = "\n".join(f"This is a long paragraph line number {i} about the results of the study population and the discussion of it." for i in range(120))
    assert values(spark, text.article_reason, [None, "", "x", body + "\nReferences\nSupplementary\nAcknowledgments", "available to purchase " + body, "\n".join([body[:3400]] + ["Same affiliation line here"] * 6)])[:5] == ["empty", "empty", "thin body", "ok", "paywall phrase"]
    assert values(spark, text.worst_repeat, ["a" * 20 + "\n" + "a" * 20, "| --- | --- | --- |\n" * 9, "short\nshort"]) == [2, 0, 0]
    assert values(spark, text.body_chars, ["# head\n" + "p" * 90 + "\n| a | bb |\n| --- | --- |\n- item"]) == [93]
    assert values(spark, text.quality_reason, ["%PDF-1.4", "a" * 100, None]) == ["binary: pdf", "too short", "empty"]
    assert values(spark, text.clean, ["<b>x</b> &lt;y&gt;\ndoi:10.1/x\n\n\n\n\nz    w", "a\n## References\n1. x\n2. y\n3. z\n4. w"]) == ["x <y>\n\n\nz w", "a\n\n[References section removed]"]
    assert values(spark, text.origin_class, ["somatic tumor", "germline proband", "somatic germline", "x"]) == ["somatic", "germline", "ambiguous", "unknown"]


def test_embargo_counts_days_not_months(spark):
    d = datetime.date(2024, 1, 1)
    rows = spark.createDataFrame([(d, 6, datetime.date(2024, 7, 1)), (d, 6, datetime.date(2024, 7, 2)), (None, 6, d), (None, None, d)], "p date, m int, t date")
    assert [r[0] for r in rows.select(text.embargo_open(F.col("p"), F.col("m"), F.col("t"))).collect()] == [False, True, False, True]


def test_links(spark):
    assert values(spark, links.dois, ["see 10.1000/abc.1, and 10.1000/abc.1."]) == [["10.1000/abc.1"]]
    assert values(spark, links.encode_doi, ["10.1/a b:c*"]) == ["10.1/a%20b:c%2A"]
    assert values(spark, links.normal_url, ["http://x/y/#z"]) == ["http://x/y"]
    assert values(spark, lambda c: links.country(c, ("France", "Japan")), ["Inst, Paris, France.", "Japan Heart Center, Tokyo", "x"]) == ["france", "japan", None]
    assert values(spark, lambda c: links.layer_union(c, F.lit("figure")), ["llm_text, figure", None]) == [["llm_text", "figure"], ["figure"]]
    assert values(spark, lambda c: links.locator(c), ["Table 2A, row 5"])[0].asDict() == {"table": "2A", "row": "5", "paragraph": None, "section": None}


def test_greedy_matching(spark):
    gold = spark.createDataFrame([(1, "p", "p.Ala561Val"), (2, "p", "c.692_693delCA"), (3, "p", "c.1841C>T"), (4, "p", "G572S"), (5, "q", "A561V"), (6, "p", "Pro926AlafsTer14")], "gold_id int, paper string, variant string")
    found = spark.createDataFrame([(10, "p", "A561V"), (11, "p", "c.693delCA"), (12, "p", "p.Ala614Val"), (13, "p", "G628S"), (14, "q", "nothing"), (15, "p", "P926fsX")], "found_id int, paper string, variant string")
    out = {(r.gold_id, r.found_id): r.match_type for r in matching.match(gold, found).collect()}
    assert out == {(1, 10): "exact", (2, 11): "deletion_span", (3, 12): "codon_bridge", (4, None): "none", (None, 13): "none", (5, None): "none", (None, 14): "none", (6, 15): "exact"}
    assert matching.similarity("ab", "ab") == 1 and matching.similarity("abcd", "abxd") == 0.75 and matching.similarity("", "a") == 0
    assert not matching.numbers_agree("G572S", "G628S") and matching.numbers_agree("p.Pro926AlafsTer14", "P926fsX") and not matching.numbers_agree("c.1890+5G>A", "c.1890G>A")


def test_pipe_tables_and_counts(spark):
    doc = "intro\nTable 1. Carriers\n| Variant | Carriers | Unaffected | Total screened |\n| --- | --- | --- | --- |\n| A561V | 5 (x) | 2 | 900 |\n| R1W | 3 |\nend\na | b\n--- | ---\n1 | 2"
    docs = spark.createDataFrame([(1, doc), (2, None), (3, "no | table")], "doc_id long, text string")
    found = documents.tables(docs).orderBy("table_no").collect()
    assert [(r.doc_id, r.table_no, r.caption, r.header) for r in found] == [(1, 1, "Table 1. Carriers", ["Variant", "Carriers", "Unaffected", "Total screened"]), (1, 2, None, ["a", "b"])]
    assert doc[found[0].start_char : found[0].end_char].startswith("| Variant")
    sums = {r.role: r.total for r in documents.table_counts(documents.tables(docs).where("table_no = 1"), ["doc_id"]).collect()}
    assert sums == {"carriers": 8, "unaffected": 2}


def test_mentions(spark):
    docs = spark.createDataFrame([(1, "p.Ala561Val (A561V) and c.1682C>T; IVS10+4A>G"), (2, None)], "doc_id long, text string")
    assert {(r.normalized, r.n, r.kind) for r in documents.mentions(docs).collect()} == {("A561V", 3, "hgvs_protein"), ("c.1682C>T", 1, "coding"), ("IVS10+4A>G", 1, "splice")}


def test_triage(spark):
    docs = spark.createDataFrame([("KCN gene A561V carriers\nTable 1", "t"), ("nothing", "t"), ("KCN here", "t"), ("KCN A561V\nTable 2", "t"), ("KCN", "A review")], "text string, title string")
    out = docs.select(triage.triage(triage.signals(F.col("text"), F.col("title"), "KCN")).alias("t")).collect()
    assert [(r.t.decision, r.t.confidence) for r in out] == [("extract_now", 0.88), ("skip", 0.9), ("defer", 0.62), ("extract_now", 0.74), ("skip", 0.9)]


def test_relational(spark):
    rows = spark.createDataFrame([(1, None, "x", 3), (2, None, "x", 3), (3, "a", None, 4)], "id int, k string, v string, n int")
    kept, moved = relational.collapse_duplicates(rows, ["k", "v", "n"], "id")
    assert kept.count() == 2 and {(r.id, r.keeper_id) for r in moved.collect()} == {(1, 1), (2, 1), (3, 3)}
    up = relational.upsert(rows.where("id = 1").select("k", "v", "n"), rows.where("id > 1").select("k", F.lit("new").alias("v"), F.lit(9).alias("n")), ["k"], ["v", "n"])
    assert {(r.k, r.v, r.n, r.action) for r in up.collect()} == {(None, "x", 3, "updated"), ("a", "new", 9, "added")}
    rich = spark.createDataFrame([("a", 0, False), ("a", 1, True), ("b", 2, False), (" ", 3, True)], "k string, o int, r boolean")
    assert {(x.k, x.o, x.position) for x in relational.richest(rich, ["k"], F.col("r"), "o").collect()} == {("a", 1, 0), ("b", 2, 2)}


def test_extraction_documents(spark, tmp_path):
    good = {"paper_metadata": {"pmid": "12", "title": "T", "gene_symbol": "G"}, "variants": [{"protein_notation": "A1V", "penetrance_data": {"total_carriers_observed": "about 5", "affected_count": 2}, "individual_records": [{"individual_id": "i", "affected_status": "case"}], "count_provenance": {"carriers_column_label": "n"}, "functional_data": {"assays": ["x"]}}]}
    (tmp_path / "G_PMID_12.json").write_text(json.dumps(good))
    (tmp_path / "G_PMID_13.json").write_text("{broken")
    (tmp_path / "other.json").write_text(json.dumps(good))
    rows = sources.extraction_files(spark, str(tmp_path)).cache()
    assert {r.file_id for r in rows.collect()} == {"12", "13"}
    out = sources.flatten(rows)
    assert [(r.pmid, r.carriers, r.affected, r.unaffected) for r in out["variants"].collect()] == [("12", 5, 2, None)]
    assert [r.affected_status for r in out["individual_records"].collect()] == ["affected"]
    checked = {r.file_id: r.errors for r in evidence.validate(rows).collect()}
    assert checked["12"] == [] and "no_metadata" in checked["13"]
    cards = evidence.evidence_cards(out["variants"], ["pmid", "ordinal"]).collect()
    assert {(c.field, tuple(c.triggers), c.verdict) for c in cards} == {("carriers", (), "NONE"), ("affected", ("unsourced",), "WITHHOLD")}
    facts = evidence.provenance_rows(out["variants"], ["pmid", "ordinal"])
    assert facts.count() == 3 and evidence.insert_new(facts, facts).count() == 0


def test_reference_table_and_log(spark, tmp_path):
    (tmp_path / "gold.csv").write_text("Protein Change,PubMed ID,Carriers,Unaffected,Affected\nA1V,12.0,3,,0\n")
    r = sources.reference_table(spark, str(tmp_path / "gold.csv")).first()
    assert (r.variant, r.pmid, r.carriers, r.affected, r.unaffected) == ("A1V", "12", 3, 0, None)
    (tmp_path / "log.jsonl").write_text('{"pmid": "1", "final_decision": "PASS"}\n\n{bad\n')
    good, bad = sources.progress(spark, str(tmp_path / "log.jsonl"))
    assert good.count() == 1 and bad.count() == 1
    sources.register(spark)
    assert spark.read.format("factloom_stub").option("ids", "1,2,3").option("batch", 2).load().count() == 3
    assert [r.query for r in sources.expand_queries(spark, ["A", "B", "A"], ["x"]).orderBy("ordinal").collect()] == ['("A"[Title/Abstract] OR "B"[Title/Abstract])', '("A"[Title/Abstract] OR "B"[Title/Abstract]) AND (x)']


def test_exons(spark):
    exons = spark.createDataFrame([("g", 1, 10), ("g", 21, 26), ("g", 31, 45)], "gene string, start int, end int")
    coding = spark.createDataFrame([("g", 5, 40)], "gene string, cds_start int, cds_end int")
    out = structure.exon_records(exons, coding).orderBy("exon").collect()
    assert [(r.coding_length, r.offset, r.in_frame, r.first_residue, r.last_residue) for r in out] == [(6, 0, True, 1, 2), (6, 6, True, 3, 4), (10, 12, False, 5, 8)]


def test_breaker_and_taper(spark):
    states, carried = incremental.breaker_states([False] * 5 + [True] * 3, [0, 1, 2, 3, 4, 70, 71, 72])
    assert states == ["closed"] * 4 + ["open", "half_open", "half_open", "closed"] and carried[0] == "closed"
    batches = spark.createDataFrame([(n, v) for n, v in enumerate([0, 0, 12, 3, 9, 1, 2, 50])], "b int, fresh int")
    assert [r.b for r in incremental.stop_after_taper(batches, "b", "fresh").orderBy("b").collect()] == [0, 1, 2, 3, 4, 5, 6]
    slots = incremental.rate_slots(spark.createDataFrame([("k", 0.0), ("k", 0.1), ("k", 5.0)], "k string, t double"), ["k"], F.col("t"), 2.0).orderBy("t").collect()
    assert [r.slot for r in slots] == [0.0, 2.0, 5.0]


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    folder, out, mark = tmp_path / "in", tmp_path / "out", tmp_path / "mark"
    folder.mkdir()

    def run():
        stream = incremental.new_files(spark, str(folder), "id long")
        stream.writeStream.format("parquet").option("checkpointLocation", str(mark)).trigger(availableNow=True).start(str(out)).awaitTermination()
        return sorted(r.id for r in spark.read.schema("id long").parquet(str(out)).collect())

    (folder / "a.json").write_text('{"id": 1}\n')
    assert run() == [1]
    (folder / "b.json").write_text('{"id": 2}\n')
    assert run() == [1, 2]


def test_registry():
    @registry.register
    class One:
        NAME = "one"

    assert registry.strategies()["one"] is One
    with pytest.raises(ValueError):
        registry.register(type("Bad", (), {"NAME": "base"}))
    assert registry.attempt_order([("a", False), ("b", True), ("c", False)]) == ["b", "a", "c"]
    assert registry.keyword_stub("gene")(pd.Series(["Gene x", "y", None])).tolist() == ["PASS", "FAIL", "PASS"]


def test_health_band_takes_the_worst(spark):
    rows = spark.createDataFrame([(0.1, None), (0.2, 0.4), (None, None), (0.15, 0.0)], "a double, b double")
    assert [r[0] for r in rows.select(scoring.health_band(F.col("a"), F.col("b"))).collect()] == ["healthy", "needs attention", "not yet gated", "watch"]


def test_zones_are_merged_before_the_best_are_kept(spark):
    the, no, strong = "the one", "nothing", "the patient carriers"
    docs = spark.createDataFrame([(1, "\n\n".join([the] * 60)), (2, "\n\n".join([the, no] * 39 + [strong])), (3, no), (4, None)], "doc_id long, text string")
    found = documents.zones(docs, r"(?i)\bthe\b").orderBy("doc_id", "place").collect()
    assert [(r.place, r["last"], r.n) for r in found if r.doc_id == 1] == [(0, 59, 60)]
    assert [r.place for r in found if r.doc_id == 2] == [*range(0, 58, 2), 78]
    assert {r.doc_id for r in found} == {1, 2}
