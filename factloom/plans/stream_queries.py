"""Registered queries that run as streams to their end: state by key, and a sink that a batch reaches once."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from factloom.operators.shared import folder_of
from factloom.plans.queries import query
from factloom.streaming import state
from factloom.streaming.ledger import LedgerTable

_EVENT = {
    "job": "CAST(unix_date(CAST(o_orderdate AS DATE)) AS BIGINT)",
    "at": "timestamp_micros(o_orderkey - {least} + 86400000000)",  # a watermark begins at 0, and what is not later is late
    "step": "CASE o_orderkey % 5 WHEN 0 THEN 'fetch' WHEN 1 THEN 'extract' WHEN 2 THEN 'failed' WHEN 3 THEN 'completed' ELSE 'extract' END",
    "progress": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END",
}


def _scratch(spark) -> str:
    return f"{folder_of(spark)}/stream-{uuid.uuid4().hex}"


@query("""WITH e AS (SELECT date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS job, o_orderkey AS t, CASE o_orderkey % 5 WHEN 0 THEN 'fetch' WHEN 1 THEN 'extract' WHEN 2 THEN 'failed' WHEN 3 THEN 'completed' ELSE 'extract' END AS step, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS p FROM orders),
s AS (SELECT job, max(t) AS updated_at, arg_max(step, t) AS current_step FROM e GROUP BY 1) SELECT s.*, (SELECT max(p) FROM e WHERE e.job = s.job AND step = 'extract') AS extracted FROM s""")
def streamed_job_state(spark, sf):
    """The state of each job (the orders of a day) by a stream of events, which come in files of any order, two to a batch, into a ledger table; the delay is longer than the span of their times, so none is late and no job is so old that it expires."""
    place = _scratch(spark)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    span = orders.agg(F.coalesce(F.min("o_orderkey"), F.lit(0)).alias("least"), F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("most")).first()
    rows = orders.selectExpr(*[f"{e.format(least=span.least)} AS {c}" for c, e in _EVENT.items()])
    rows.repartition(4).write.parquet(f"{place}/events")
    events = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{place}/events")
    table = state.state_table(spark, f"{place}/table")
    with state.rocks(spark):
        state.keep(state.job_states(events, timedelta(days=100_000), f"{(span.most - span.least) // 1_000_000 + 86_400} seconds"), table, "jobs", f"{place}/checkpoint").awaitTermination()
    return table.rows().select("job", (F.unix_micros("updated_at") - 86_400_000_000 + span.least).alias("updated_at"), "current_step", F.try_element_at("progress", F.lit("extract")).alias("extracted"))


@query("SELECT o_custkey AS k, max(o_orderkey) AS o, arg_max(o_orderstatus, o_orderkey) AS v FROM orders GROUP BY 1")
def ledger_replays(spark, sf):
    """Orders merged in four batches, each of which comes twice, one of them after its writer died before the commit: the newest order of each customer."""
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("o"), F.col("o_orderstatus").alias("v"))
    table = LedgerTable(spark, _scratch(spark), "k long, o long, v string", "k", "o", 8)

    def die() -> None:
        raise InterruptedError

    for batch in range(4):
        part = rows.where(F.pmod(F.xxhash64("o"), F.lit(4)) == batch)
        if batch == 2:
            try:
                table.upsert(part, "orders", batch, die)
            except InterruptedError:
                pass
        for _ in range(2):
            table.upsert(part, "orders", batch)
    return table.rows()
