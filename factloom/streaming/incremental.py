"""Resuming, retries, rate slots and per-key breakers: batch forms and Structured Streaming forms."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def unprocessed(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return todo.join(done.select(key), key, "left_anti")


def new_files(spark: SparkSession, folder: str, schema, kind: str = "json", per_batch: int = 1000) -> DataFrame:
    """Files that come into a folder, each once; the checkpoint of the query that reads it keeps what was read."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", per_batch).load(folder)


def first_of_key(stream: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Each key once within the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def event_rate(events: DataFrame, time: str, width: str, *by: str, delay: str = "1 hour") -> DataFrame:
    """Events per window; in a stream, windows close after the delay."""
    rows = events.withWatermark(time, delay) if events.isStreaming else events
    return rows.groupBy(F.window(time, width).alias("window"), *by).agg(F.count(F.lit(1)).alias("n"))


def rate_slots(calls: DataFrame, by: list[str], seconds: Column, step: float) -> DataFrame:
    """The slot of each call when slots lie `step` seconds apart: max(previous slot + step, its time)."""
    order = Window.partitionBy(*by).orderBy(seconds)
    place = F.row_number().over(order)
    return calls.withColumn("_n", place).withColumn("slot", F.max(seconds - F.col("_n") * step).over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_n") * step).drop("_n")


def stop_after_taper(batches: DataFrame, order: str, fresh: str, least: int = 8, patience: int = 2) -> DataFrame:
    """Batches up to the one where, after some yield, `patience` in a row brought fewer than `least` new items."""
    w = Window.orderBy(order)  # one row per batch of documents
    seen = F.max((F.col(fresh) >= least).cast("int")).over(w)
    run = F.sum(F.when(F.col(fresh) >= least, 1).otherwise(0)).over(w)
    marked = batches.withColumn("_run", run).withColumn("_seen", seen)
    low = F.row_number().over(Window.partitionBy("_run").orderBy(order)) - 1
    counted = marked.withColumn("_low", F.when(F.col("_seen") == 1, low).otherwise(0))
    done = F.max((F.col("_low") >= patience).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return counted.withColumn("_done", done).where(F.coalesce("_done", F.lit(0)) == 0).drop("_run", "_seen", "_low", "_done")


def breaker_states(results: list[bool], times: list[float], max_failures: int = 5, reset: float = 60.0, good: int = 3, state: tuple = ("closed", 0, 0.0, 0)) -> tuple[list[str], tuple]:
    """The breaker's state after each call, and what to carry on: (state, failures, opened at, successes)."""
    name, failures, opened, successes = state
    out = []
    for ok, now in zip(results, times, strict=True):
        if name == "open" and now - opened >= reset:
            name, successes = "half_open", 0
        if name == "half_open":
            if not ok:
                name, opened = "open", now
            else:
                successes += 1
                if successes >= good:
                    name, failures = "closed", 0
        elif name == "closed":
            failures = 0 if ok else failures + 1
            if failures >= max_failures:
                name, opened = "open", now
        out.append(name)
    return out, (name, failures, opened, successes)


def circuit_breaker(calls: DataFrame, key: str, max_failures: int = 5, reset: float = 60.0) -> DataFrame:
    """A stream of (key, ok, seconds) with the state of the key's breaker after each call; state is kept per key."""

    def step(k, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        carried = tuple(state.get) if state.exists else ("closed", 0, 0.0, 0)
        for frame in frames:
            frame = frame.sort_values("seconds")
            names, carried = breaker_states(frame["ok"].tolist(), frame["seconds"].tolist(), max_failures, reset, state=carried)
            yield pd.DataFrame({key: frame[key], "seconds": frame["seconds"], "state": names})
        state.update(carried)

    kind = dict(calls.dtypes)[key]
    return calls.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, seconds double, state string", "name string, failures int, opened double, successes int", "append", "NoTimeout")


def retry_queue(stored: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Failures folded into the queue: the newest reason, the ordered union of failed sources, attempts counted."""
    rows = stored.select(key, "reason", "sources", "attempts", "at").unionByName(failed.select(key, "reason", "sources", F.lit(1).alias("attempts"), "at"))
    return rows.groupBy(key).agg(
        F.max_by("reason", "at").alias("reason"),
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "sources"))), lambda x: x["sources"]))).alias("sources"),
        F.sum("attempts").cast("int").alias("attempts"),
        F.max("at").alias("at"),
    )


def pending(queue: DataFrame, limit: int, status: str = "pending") -> DataFrame:
    return queue.where(F.col("status") == status).orderBy("priority", "added").limit(limit)
