"""Roles of columns and the facts of tables whose headers are whole, missing, swapped, split or over several rows."""

import itertools
import random

import pytest

from factloom.operators import columns

WHOLE = "Table 1 GENE1 changes\n| Gene | cDNA | Protein | Carriers | Affected | Unaffected |\n|---|---|---|---|---|---|\n"
BODY = "| GENE1 | c.12A>G | p.Ala4Val | 9 | 5 | 4 |\n| GENE1 | c.40C>T | R14W | 7 | 7 | 0 |\n| GENE2 | c.70C>T | R24W | 70 | 7 | 63 |\n"
SAME = [("A4V", 9, 5, 4, None), ("R14W", 7, 7, 0, None)]
TABLES = [
    (WHOLE + BODY, SAME),
    (BODY, SAME),  # no header at all: the sum tells the counts
    (WHOLE.replace("cDNA | Protein", "Protein | cDNA") + BODY, SAME),  # names swapped
    ("| Gene | Base | Residue | No. of | Affected | Unaffected |\n| | change | change | carriers | | |\n|---|---|---|---|---|---|\n" + BODY, SAME),
    ("| | Notation | | Counts | | |\n|---|---|---|---|---|---|\n| Gene | cDNA | Protein | Carriers | Affected | Unaffected |\n" + BODY, SAME),  # parents over their columns
    ("| Variant | Affected/carriers |\n|---|---|\n| A4V | 5/9 |\n| p.Arg14Trp† | 7 / 7 |\n", [("A4V", 9, 5, None, None), ("R14W", 7, 7, None, None)]),
    ("| Variant | Carriers (n/N screened) |\n|---|---|\n| A4V | 3/120 (2.5%) |\n", [("A4V", 3, None, None, 120)]),
    ("| Variant | Carriers |\n|---|---|\n| A4V | 3 patients |\n| R14W | 4a |\n| R24W | 12% |\n| G5D | 20000 |\n", [("A4V", 3, None, None, None), ("G5D", None, None, None, None), ("R14W", 4, None, None, None), ("R24W", None, None, None, None)]),
    ("| Variant | Carriers |\n|---|---|\n| GENE2 | |\n| A4V | 3 |\n| GENE1 | |\n| R14W | 4 |\n", [("R14W", 4, None, None, None)]),  # rows that part the genes
    ("Table 2 Variants of GENE2\n| Variant | Carriers |\n|---|---|\n| A4V | 3 |\n", []),
    ("| **Table 3. GENE1** | | |\n| Protein | N | Diagnosis |\n|---|---|---|\n| A4V | 3 | long, sad |\n", [("A4V", 3, None, None, None)]),
    (WHOLE + BODY + "\nTable 1 (continued)\n| GENE1 | c.12A>G | p.Ala4Val | 1 | 1 | 0 |\n", [("A4V", 10, 6, 4, None), ("R14W", 7, 7, 0, None)]),
    ("| Patient | Variant | Sex |\n|---|---|---|\n| P1 | A4V | f |\n| P2 | A4V | m |\n", [("A4V", 2, None, None, None)]),
    ("no table", []), (None, []), ("|", []), ("| a |\n|---|", []), ("|---|\n|---|\n", []),
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TABLES)], "doc_id long, text string")
    return columns.typed_facts(docs, "GENE1").collect()


@pytest.mark.parametrize("i", range(len(TABLES)))
def test_facts_of_a_table(found, i):
    assert sorted((r.variant, r.carriers, r.affected, r.unaffected, r.total) for r in found if r.doc_id == i) == TABLES[i][1]


def test_phenotype_and_count_type(found):
    assert {(r.phenotype, r.count_type) for r in found if r.doc_id == 10} == {("long, sad", "per_variant_carrier")}


def test_matching_equals_trying_everything():
    rng = random.Random(8)
    for _ in range(150):
        width, roles = rng.randrange(1, 5), rng.randrange(1, 5)
        points = [[rng.choice((0, 30, 41, 60, 100, 120)) for _ in range(roles)] for _ in range(width)]
        best = max(sum(points[c][r] - 40 for c, r in enumerate(own) if r is not None and points[c][r] > 40) for own in itertools.product([None, *range(roles)], repeat=width) if len({r for r in own if r is not None}) == sum(r is not None for r in own))
        found = columns.best_roles(points)
        assert len({r for r in found if r >= 0}) == sum(r >= 0 for r in found) and sum(points[c][r] - 40 for c, r in enumerate(found) if r >= 0) == best


def test_texts_of_one_id_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, BODY, "x")], "doc_id long, text string, header string")
    assert columns.typed_facts(docs, "gene1").count() == 2 and not columns.typed_facts(docs.limit(0), "GENE1").count()
