"""Queries and their SQL on small tables that hold what the driver's smallest ones lack: ties, hotspots, far keys, many copies."""

import duckdb
import pytest

from factloom.operators import rollups
from factloom.plans import catalogue
from factloom.sources import clustered
from factloom.streaming.ledger import LedgerTable

PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def same(spark, name, folder, **tables):
    """Rows of a query and of its SQL on tables of (rows, schema)."""
    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    found = catalogue.QUERIES[name](spark, str(folder))
    said = con.execute(catalogue.ORACLES[name])
    columns = [c[0] for c in said.description]
    expected = sorted(said.fetchall(), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr) == expected
    return columns, expected


def test_hotspots_of_other_genes_are_no_changes_of_the_target(spark, tmp_path):
    rows = [(182, "x", "Brand#1", "t", 3, 1.0), (1082, "x", "Brand#2", "t", 3, 1.0), (190, "x", "Brand#1", "t", 3, 1.0)]  # R282W twice, R290W
    assert same(spark, "target_changes", tmp_path, part=(rows, PART))[1] == [("Brand#1", "R290W", 1)]


@pytest.mark.parametrize("turn", [1, -1])
def test_of_several_first_rows_the_least_stands(spark, turn):
    rows = [(1, 7, 1, 3, 1, layer) for layer in ("figure", "llm_table", "llm_text")][::turn]
    facts = spark.createDataFrame(rows, "variant long, paper long, line long, carriers int, affected int, layer string").coalesce(1)
    assert [r.layer for r in rollups.variant_summary(facts, ["variant"], "paper", "carriers", "affected", "line", ["layer"]).collect()] == ["figure"]


def swapped(monkeypatch, spark):
    """Rows of a union in the other order, as a shuffle between machines may bring them."""
    frame = type(spark.range(1))
    union = frame.unionByName
    monkeypatch.setattr(frame, "unionByName", lambda self, other: union(other, self))


@pytest.mark.parametrize("turned", [False, True])
def test_a_later_batch_stands_before_equally_new_rows(spark, tmp_path, monkeypatch, turned):
    table = LedgerTable(spark, f"file://{tmp_path}/table", "k long, o long, v string", "k", "o", 1)
    if turned:
        swapped(monkeypatch, spark)
    for batch, rows in enumerate(([(1, 5, "a"), (2, 5, "a")], [(1, 5, "b"), (2, 4, "b")])):
        table.upsert(spark.createDataFrame(rows, "k long, o long, v string").coalesce(1), "q", batch)
    assert {r.k: r.v for r in table.rows().collect()} == {1: "b", 2: "a"}


def test_job_state_of_far_keys(spark, tmp_path):
    """Each later file is of days whose keys lie far before those of the first."""
    from datetime import datetime, timedelta

    rows = [(k + 10**9 * g, k % 3, "O", 1.0, datetime(1995, 1, 1) + timedelta(days=40 - g), "p") for g in range(40) for k in range(12)]
    same(spark, "streamed_job_state", tmp_path, orders=(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"))


def test_files_of_a_clustered_table_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(clustered, "ROWS_A_FILE", 50)
    for n in (100, 1000):
        made = clustered.Clustered(spark, f"{tmp_path}/{n}")
        made.write(spark.range(n).selectExpr("concat('g', id % 20) AS gene", "CAST(id AS INT) AS position"))
        zones = made.zones().collect()
        assert sum(z.n for z in zones) == n and max(z.n for z in zones) <= 150
        for z in zones:
            keys = [(r.gene, r.position) for r in spark.read.parquet(z.file).collect()]
            assert (min(keys), max(keys), len(keys)) == (tuple(z["first"]), tuple(z["last"]), z.n)


def test_compared_rows_are_dealt_by_their_number(spark, monkeypatch):
    from factloom.operators import shared
    from factloom.plans.queries import compared
    from pyspark.sql import functions as F

    monkeypatch.setattr(shared, "ROWS_A_TASK", 500)  # sf0.001 has 6,000 lines
    rows = compared(spark, "/root/testdata/sf0.001")
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 12 and max(r["count"] for r in sizes) < 1000
