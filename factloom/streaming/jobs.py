"""Job state as tables of events: steps, attempts, expiry, run statistics. State is derived by aggregation, so events may come late or twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Steps that end a job, and outcomes of an attempt.
ENDED = ("completed", "failed")
FAILURES = ("parse_failed", "error")


def job_state(events: DataFrame, job: str, at: str, step: str, progress: str) -> DataFrame:
    """Per job its current step, when it was updated, and the last progress of each step as a map."""
    per = events.groupBy(job, step).agg(F.max_by(progress, F.when(F.col(progress).isNotNull(), F.col(at))).alias("_p"), F.max(at).alias("_at"))
    return per.groupBy(job).agg(
        F.max_by(step, "_at").alias("current_step"), F.max("_at").alias("updated_at"), F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("_p").isNotNull(), F.struct(step, "_p"))))).alias("step_progress")
    )


def expired(jobs: DataFrame, now: Column, max_age_days: int = 30, step: str = "current_step", updated: str = "updated_at") -> DataFrame:
    """Jobs that have ended and were not updated for so long; running ones never expire."""
    return jobs.where(F.col(step).isin(*ENDED) & (F.col(updated) < now - F.make_dt_interval(F.lit(max_age_days))))


def attempt_summary(attempts: DataFrame, call: str, order: str, trace: str, outcome: str) -> DataFrame:
    """Per call: the last accepted trace, all accepted, failed and discarded ones in order, number of attempts and parse failures.

    An attempt that was neither accepted nor failed is discarded.
    """
    kind = F.when(F.col(outcome) == "accepted", "accepted").when(F.col(outcome).isin(*FAILURES), "failed").otherwise("discarded")
    rows = attempts.withColumn("_kind", kind)
    listed = lambda name: F.transform(F.array_sort(F.collect_list(F.when((F.col("_kind") == name) & F.col(trace).isNotNull(), F.struct(order, trace)))), lambda x: x[trace])
    out = rows.groupBy(call).agg(listed("accepted").alias("accepted"), listed("failed").alias("failed"), listed("discarded").alias("discarded"), F.count(F.lit(1)).alias("attempts"), F.count_if(F.col(outcome) == "parse_failed").alias("parse_failures"))
    return out.withColumn("accepted_last", F.try_element_at("accepted", F.lit(-1)))


def run_statistics(events: DataFrame, run: str, at: str, status: str) -> DataFrame:
    """Per run: start, end, papers done and failed, share that succeeded."""
    out = events.groupBy(run).agg(F.min(at).alias("started"), F.max(at).alias("ended"), F.count_if(F.col(status) == "completed").alias("done"), F.count_if(F.col(status) == "failed").alias("failed"))
    return out.withColumn("success", F.try_divide(F.col("done").cast("double"), (F.col("done") + F.col("failed")).cast("double")))


def last_entries(index: DataFrame, line: str, order: str, path: str = "path") -> DataFrame:
    """The last entry of each path of a log of JSON lines; broken lines are skipped."""
    key = F.get_json_object(line, f"$.{path}")
    good = index.where(F.try_parse_json(line).isNotNull() & key.isNotNull())
    return good.groupBy(key.alias(path)).agg(F.max_by(line, order).alias(line))
