"""Job state as a stream against the batch form, restarts, expiry, and sinks that write no batch twice."""

import tempfile
from datetime import datetime, timedelta

import pytest

from factloom.streaming import jobs, state
from factloom.streaming.ledger import LedgerTable
from pyspark.sql import functions as F

EVENTS = "job long, at timestamp, step string, progress long"
DAY = datetime(2024, 1, 1)


def at(hours):
    return DAY + timedelta(hours=hours)


def put(spark, folder, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, table, checkpoint, age=timedelta(days=5), **hooks):
    with state.rocks(spark):
        stream = spark.readStream.schema(EVENTS).parquet(folder)
        query = state.keep(state.job_states(stream, age), table, "jobs", checkpoint, **hooks)
        query.awaitTermination()


def said(table):
    return {r.job: (r.current_step, r.updated_at, dict(r.progress), r.expired) for r in table.rows().collect()}


def test_a_restarted_stream_gives_the_batch_result_and_expires_once(spark):
    base = "file://" + tempfile.mkdtemp()
    folder, table = f"{base}/in", state.state_table(spark, f"{base}/table", 4)
    first = [(1, at(0), "fetch", 5), (1, at(2), "extract", 7), (2, at(1), "completed", None), (3, at(3), "fetch", None)]
    put(spark, folder, first)
    run(spark, folder, table, f"{base}/check")
    second = [(1, at(1), "extract", 6), (3, at(4), "failed", 1), (4, at(5), "fetch", 2)]  # one event comes late
    put(spark, folder, second)
    run(spark, folder, table, f"{base}/check")
    rows = spark.createDataFrame(first + second, EVENTS)
    plain = {r.job: (r.current_step, r.updated_at, dict(r.step_progress or {}), False) for r in jobs.job_state(rows, "job", "at", "step", "progress").collect()}
    assert said(table) == plain

    seen = []
    put(spark, folder, [(9, at(24 * 6 + 1), "fetch", None)])
    run(spark, folder, table, f"{base}/check")
    put(spark, folder, [(9, at(24 * 6 + 2), "fetch", None)])
    run(spark, folder, table, f"{base}/check", before_commit=lambda: seen.append(1))
    now = said(table)
    assert {j for j, v in now.items() if v[3]} == {2, 3} and now[1][3] is False and now[4][3] is False  # running jobs never expire
    put(spark, folder, [(9, at(24 * 30), "fetch", None)])
    run(spark, folder, table, f"{base}/check")
    assert {j for j, v in said(table).items() if v[3]} == {2, 3} and seen


def test_a_writer_that_dies_before_the_commit_leaves_the_same_rows(spark):
    base = "file://" + tempfile.mkdtemp()
    table = LedgerTable(spark, base, "k long, v string, o long", "k", "o", 4)
    rows = lambda *x: spark.createDataFrame(list(x), "k long, v string, o long")
    assert table.upsert(rows((1, "a", 1), (2, "b", 1)), "q", 0) and not table.rows().where("k = 9").count()

    def die():
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError, match="killed"):
        table.upsert(rows((1, "c", 2), (3, "d", 1)), "q", 1, die)
    assert sorted(tuple(r) for r in table.rows().collect()) == [(1, "a", 1), (2, "b", 1)]
    assert table.upsert(rows((1, "c", 2), (3, "d", 1)), "q", 1)
    assert not table.upsert(rows((1, "c", 2), (3, "d", 1)), "q", 1)  # replayed
    assert not table.upsert(rows((7, "x", 2)), "q", 0)
    assert table.upsert(rows((2, "old", 0)), "other", 0)  # another query's batches; older rows change nothing
    assert sorted(tuple(r) for r in table.rows().collect()) == [(1, "c", 2), (2, "b", 1), (3, "d", 1)]
    assert table.upsert(rows(), "q", 2) and table.entry()["batches"] == {"q": 2, "other": 0}


def test_two_writers_cannot_both_commit(spark):
    base = "file://" + tempfile.mkdtemp()
    one, two = (LedgerTable(spark, base, "k long, o long", "k", "o", 2) for _ in range(2))
    rows = spark.createDataFrame([(1, 1)], "k long, o long")
    with pytest.raises(RuntimeError, match="another writer"):
        one.upsert(rows, "a", 0, lambda: two.upsert(rows.withColumn("o", F.lit(5)), "b", 0))
    assert [tuple(r) for r in one.rows().collect()] == [(1, 5)] and one.upsert(rows, "a", 0)
    assert [tuple(r) for r in one.rows().collect()] == [(1, 5)]


def test_an_empty_ledger_table(spark):
    table = LedgerTable(spark, "file://" + tempfile.mkdtemp(), "k long, o long", "k", "o")
    assert table.rows().columns == ["k", "o"] and not table.rows().count()
