"""Spans of mentions and the genes they belong to, each against a plain version."""

import itertools
import random

import pytest

from factloom.operators import attribution, scanner

# What texts say, and the mentions they hold.
SAID = [
    ("found the p.Arg534Cys mutation", ["p.Arg534Cys"]), ("p.(Arg176Trp), p.(Ser906Leu)", ["p.(Arg176Trp)", "p.(Ser906Leu)"]), ("HERGG604S and hERGT613M", ["G604S", "T613M"]), ("p.Leu987Profs*10 or L987fsX12", ["p.Leu987Profs*10", "L987fsX12"]),
    ("W1001X, R864stop, Trp1001Ter", ["W1001X", "R864stop", "Trp1001Ter"]), ("p.Leu552_Leu559del", ["p.Leu552_Leu559del"]), ("delI642-V644; del552", ["delI642-V644", "del552"]), ("c.1600C>T, 1810G→A, c.123delAinsT", ["c.1600C>T", "1810G>A", "c.123delAinsT"]),
    ("c.1234+1G>A IVS9+1G>A IVS10+1del", ["c.1234+1G>A", "IVS9+1G>A", "IVS10+1del"]), ("185delAG and 120delta", ["185delAG"]), ("We found a deletion of exons 3–5.", ["deletion of exons 3–5"]), ("No deletion of exon 5 was found", []), ("deletion of exons 3-5 was not detected", []),
    ("MLPA detects exon deletions", []), ("A whole-gene deletion was identified", ["whole-gene deletion"]), ("", []), ("a" * 5000 + " R534C", ["R534C"]),
]


@pytest.mark.parametrize(("text", "mentions"), SAID)
def test_mentions_of_a_text(text, mentions):
    found = scanner.best_spans(scanner.candidates(text, ("HERG", "KCNH2")))
    assert [text[s:e].replace("→", ">") for s, e, _, _ in found] == mentions


def test_best_spans_equal_all_subsets():
    rng = random.Random(5)
    for _ in range(300):
        spans = []
        for _ in range(rng.randrange(9)):
            start = rng.randrange(20)
            spans.append((start, start + rng.randrange(1, 9), rng.randrange(4), rng.choice((70, 85, 90))))
        spans = list(dict.fromkeys(spans))
        best = 0
        for k in range(len(spans) + 1):
            for some in itertools.combinations(spans, k):
                if all(a[1] <= b[0] or b[1] <= a[0] for a, b in itertools.combinations(some, 2)):
                    best = max(best, sum((e - s) * c for s, e, _, c in some))
        found = scanner.best_spans(spans)
        assert sum((e - s) * c for s, e, _, c in found) == best and all(a[1] <= b[0] for a, b in itertools.pairwise(found))
        assert found == scanner.best_spans(rng.sample(spans, len(spans)))


def test_scan_of_hard_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "R534C R534C", "x"), (3, "R534C", "x"), (None, "c.1A>G", "x"), (4, "😀 é p.R10W", "x"), (5, "R100W " * 3000, "x")], "doc_id long, text string, start string")
    rows = scanner.scan(docs).collect()
    assert sorted((r.doc_id or 0, r.start, r.raw) for r in rows if r.doc_id != 5) == [(0, 0, "c.1A>G"), (3, 0, "R534C"), (3, 0, "R534C"), (3, 6, "R534C"), (4, 4, "p.R10W")]
    assert sum(r.doc_id == 5 for r in rows) == 3000
    assert not scanner.scan(docs.limit(0)).count()


def test_rejections(spark):
    text = "R175H, R534C, R2000W, S1 at 37C; G628S variant; del552"
    found = scanner.described(scanner.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    reasons = {r.raw: r.reason for r in found.select("raw", scanner.rejection("KCNH2", 1159).alias("reason")).collect()}
    assert reasons == {"R175H": "hotspot", "R534C": None, "R2000W": "beyond", "G628S": None, "del552": None}


TERMS = {"KCNH2": "KCNH2", "hERG": "KCNH2", "SCN5A": "SCN5A", "Nav1.5": "SCN5A", "KCNQ1": "KCNQ1"}
ATTRIBUTED = [
    ("KCNQ1 L187P and SCN5A R18W.", {"L187P": (["KCNQ1"], "clause"), "R18W": (["SCN5A"], "clause")}),
    ("P297S of KCNH2; P117L of SCN5A", {"P297S": (["KCNH2"], "clause"), "P117L": (["SCN5A"], "clause")}),
    ("In hERG, many. We saw R534C.", {"R534C": (["KCNH2"], "paragraph")}),
    ("KCNH2 and SCN5A were read. R534C was new.", {"R534C": (["KCNH2", "SCN5A"], "paragraph")}),
    ("# SCN5A\n\nText.\n\nR534C was new.", {"R534C": (["SCN5A"], "section")}),
    ("# SCN5A\n\nText.\n\n# Methods\n\nR534C was new.", {}),
    ("Table 1 SCN5A\n| V | n |\n|---|---|\n| R534C | 1 |\n| KCNQ1 R53W | 2 |", {"R534C": (["SCN5A"], "caption"), "R53W": (["KCNQ1"], "row")}),
    ("| KCNH2 | SCN5A |\n|---|---|\n| R534C | R18W |", {"R534C": (["KCNH2"], "header"), "R18W": (["SCN5A"], "header")}),
    ("R534C", {}),
    ("KCNH2 " + "word " * 100 + "R534C", {"R534C": (["KCNH2"], "paragraph")}),
]


@pytest.mark.parametrize("target", [None, "KCNH2"])
def test_nearest_gene(spark, target):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(ATTRIBUTED)] + [(99, None)], "doc_id long, text string")
    seen = scanner.scan(docs)
    told = attribution.attribute(docs, seen, TERMS)
    if target is None:
        raws = {(r.doc_id, r.start): r.raw for r in seen.collect()}
        found = {i: {} for i in range(len(ATTRIBUTED))}
        for r in told.collect():
            found[r.doc_id][raws[r.doc_id, r.start]] = (r.genes, r.scope)
        assert found == {i: genes for i, (_, genes) in enumerate(ATTRIBUTED)}
    else:
        kept = {(r.doc_id, r.normalized) for r in scanner.variants(seen, told, target, 1159).collect()}
        plain = {(r.doc_id, r.raw) for r in seen.collect()} - {(i, raw) for i, (_, genes) in enumerate(ATTRIBUTED) for raw, (g, _) in genes.items() if target not in g}
        assert kept == plain


def test_one_mention_in_the_own_gene_keeps_a_token(spark):
    docs = spark.createDataFrame([(1, "SCN5A R534C.\n\nhERG R534C.\n\nR534C."), (2, "SCN5A R534C.\n\nR534C.")], "doc_id long, text string")
    seen = scanner.scan(docs)
    found = scanner.variants(seen, attribution.attribute(docs, seen, TERMS), "KCNH2")
    assert [(r.doc_id, r.normalized, r.n) for r in found.collect()] == [(1, "R534C", 2)]


def test_extraction_rows(spark):
    docs = spark.createDataFrame([(1, "we saw\n the c.12A>G   change and R534C")], "doc_id long, text string")
    rows = scanner.extraction_rows(scanner.variants(scanner.scan(docs), None, "KCNH2"), docs, "KCNH2").collect()
    assert {(r.protein_notation, r.cdna_notation) for r in rows} == {("R534C", None), (None, "c.12A>G")}
    assert {r.key_quote for r in rows} == {"we saw the c.12A>G change and R534C"}
