"""A clustered table gives what a scan gives, and reads few files for few keys."""

import random
import tempfile

import pytest

from factloom.sources import clustered


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["g1"] * 40 + [f"g{k}" for k in range(30)] + [None]), rng.choice([None, *range(200)]), k) for k in range(6000)]
    table = clustered.Clustered(spark, "file://" + tempfile.mkdtemp() + "/t")
    table.write(spark.createDataFrame(rows, "gene string, position int, row long"), 25)
    return table, rows


def files_of(frame):
    return {r[0] for r in frame.select("_metadata.file_path").distinct().collect()}


def test_lookups_equal_a_scan_and_read_few_files(spark, made, monkeypatch):
    table, rows = made
    rng = random.Random(2)
    for n in (0, 1, 10):
        keys = [(rng.choice([r[0] for r in rows]), rng.randrange(220)) for _ in range(n)] + [(None, 3), ("g1", None), ("zz", 5)]
        wanted = spark.createDataFrame([(a, b, "x") for a, b in [*keys, *keys]], "gene string, position int, row string")
        plain = sorted(r[2] for r in rows if r[0] is not None and r[1] is not None and r[:2] in set(keys))
        found = table.lookup(wanted)
        assert sorted(r.row for r in found.collect()) == plain
        assert len(found.inputFiles()) <= 2 * (n + 1) < 25
        monkeypatch.setattr(clustered, "MOST_KEYS", 2)
        assert sorted(r.row for r in table.lookup(wanted).collect()) == plain
        monkeypatch.undo()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(gene" in plan and "position" in plan


def test_slices_and_leading_keys(made):
    table, rows = made
    for gene in ("g1", "g29", "zz", "g"):
        found = table.slice(gene)
        assert sorted(r.row for r in found.collect()) == sorted(r[2] for r in rows if r[0] == gene)
        assert len(found.inputFiles()) < 25
    assert {r.gene for r in table.leading().collect()} == {r[0] for r in rows} - {None}
    zones = table.zones().collect()
    assert len(zones) == 25 and sum(z.n for z in zones) == len(rows)
    # The hot gene is many files, of which those it fills alone are not read for the distinct keys.
    assert sum(z.first.gene == z.last.gene == "g1" for z in zones) > 5


def test_an_empty_table(spark):
    table = clustered.Clustered(spark, "file://" + tempfile.mkdtemp() + "/t")
    table.write(spark.createDataFrame([], "gene string, position int"))
    wanted = spark.createDataFrame([("g", 1)], "gene string, position int")
    assert not table.lookup(wanted).count() and not table.slice("g").count() and not table.leading().count()
