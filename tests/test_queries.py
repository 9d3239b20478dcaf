"""Every registered evidence query against its SQL on the smallest tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from factloom.plans import catalogue
from factloom.session import TABLES
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, sql, name):
    found = catalogue.QUERIES[name](spark, FOLDER)
    expected = sql.execute(catalogue.ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert len(set(found.columns)) == len(found.columns), "a table cannot be written with two columns of one name"
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found.columns, [tuple(r) for r in found.collect()]) == rows_of(columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert catalogue.QUERIES[name](spark, FOLDER).count() >= 0


def expanded(rows, left, right):
    """All pairs of parts that classes and links between them stand for."""
    of = {kind: {} for kind in (left, right)}
    for r in rows:
        if r.kind != "link":
            of[r.kind].setdefault(r.a, []).append(r.b)
    pairs = [(a, b) for r in rows if r.kind == "link" for a in of[left][r.a] for b in of[right][r.b]]
    return pairs + [(a, b) for m in of[left].values() for a in m for b in m if a < b] if left == right else pairs


def test_form_overlap_holds_every_pair(spark):
    rows = [(r.p_partkey, r.p_brand, {r.p_size, r.p_size + r.p_partkey % 7}) for r in spark.read.parquet(f"{FOLDER}/part.parquet").collect()]
    pairs = sorted((a, b) for a, x, f in rows for b, y, g in rows if a < b and x == y and f & g)
    found = expanded(catalogue.QUERIES["form_overlap_all"](spark, FOLDER).collect(), "member", "member")
    assert pairs and sorted((min(p), max(p)) for p in found) == pairs


def test_form_overlap_does_not_expand_copies(spark, tmp_path):
    for times in (1, 20):
        part = spark.read.parquet(f"{FOLDER}/part.parquet").crossJoin(spark.range(times).withColumnRenamed("id", "g")).withColumn("p_partkey", F.expr("p_partkey + g * 70000")).drop("g")
        part.write.parquet(f"{tmp_path}/{times}/part.parquet")
        n = {r.kind: r["count"] for r in catalogue.QUERIES["form_overlap_all"](spark, f"{tmp_path}/{times}").groupBy("kind").count().collect()}
        assert n["member"] == part.count()
        links = n["link"] if times == 1 else links
        assert n["link"] == links


def test_form_overlap_join_gives_all_pairs_of_all_parts(spark):
    rows = [(r.p_partkey, r.p_brand, {r.p_size, r.p_size + r.p_partkey % 7}) for r in spark.read.parquet(f"{FOLDER}/part.parquet").collect()]
    pairs = sorted((a, b) for a, x, f in rows for b, y, g in rows if x == y and f & g)
    found = sorted((r.a, r.b) for r in catalogue.QUERIES["form_overlap_join"](spark, FOLDER).select("a", "b").collect())
    assert found == pairs
    assert {a for a, _ in found} == {a for a, _, _ in rows}, "every part is read"


def test_form_overlap_join_on_odd_parts_equals_sql(spark, tmp_path):
    """Keys of several rows, in one brand and in two; nulls in each column; the largest size; many copies."""
    rows = [(1, "A", 5), (1, "B", 9), (1, "A", 5), (2, "B", 8), (3, "A", 6), (None, "A", 5), (None, "B", 9), (4, None, 5), (5, "A", None), (7, "A", 2**31 - 1), (8, "A", 2**31 - 1), (9, "A", 2**31 - 1), (-3, "A", 7)]
    rows += [(7 * k, "C", 1) for k in range(100, 300)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{tmp_path}/part.parquet/*.parquet')")
    expected = con.execute(catalogue.ORACLES["form_overlap_join"]).fetchall()
    found = catalogue.QUERIES["form_overlap_join"](spark, str(tmp_path)).select("a", "b").collect()
    assert len(expected) > 200 * 200 and sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
