"""Job state kept by a stream: the current step and the progress of each job, and timers that let ended jobs expire."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from factloom.streaming.jobs import ENDED
from factloom.streaming.ledger import LedgerTable

_STATE = "current_step string, updated_at timestamp"
_OUT = "job long, current_step string, updated_at timestamp, progress map<string,long>, expired boolean"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class JobState(StatefulProcessor):
    """A value for the newest step and a map of progress by step; a timer for each job that has ended.

    Events may come in any order within the delay of the watermark: the newest by time is the current step, and a
    step's progress is that of its newest event that states one. A job that has
    ended and was not touched for `max_age` of event time is emitted once more as
    expired, and forgotten.
    """

    def __init__(self, max_age: timedelta):
        self.max_age = max_age

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _STATE)
        self.progress = handle.getMapState("progress", "step string", "value long, at timestamp")

    def _row(self, job: int, step: str, at: datetime, expired: bool) -> pd.DataFrame:
        said = {k[0]: v[0] for k, v in self.progress.iterator()}
        return pd.DataFrame({"job": [job], "current_step": [step], "updated_at": [at], "progress": [said], "expired": [expired]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803, ANN001
        known = self.state.get() if self.state.exists() else None
        step, at = known if known else (None, None)
        for batch in rows:
            batch = batch.sort_values("at")
            last = batch.iloc[-1]
            if at is None or last["at"].to_pydatetime() >= at:
                step, at = last["step"], last["at"].to_pydatetime()
            stated = batch[batch["progress"].notna()]
            for own, one in stated.groupby("step"):
                newest = one.iloc[-1]
                before = self.progress.getValue((own,)) if self.progress.containsKey((own,)) else None
                if before is None or newest["at"].to_pydatetime() >= before[1]:
                    self.progress.updateValue((own,), (int(newest["progress"]), newest["at"].to_pydatetime()))
        self.state.update((step, at))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if step in ENDED:
            self.handle.registerTimer((at + self.max_age - datetime(1970, 1, 1)) // timedelta(milliseconds=1))
        yield self._row(int(key[0]), step, at, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803, ANN001
        step, at = self.state.get()
        row = self._row(int(key[0]), step, at, True)
        self.state.clear()
        self.progress.clear()
        yield row

    def close(self) -> None:
        pass


@contextmanager
def rocks(spark: SparkSession):
    """The state store that keyed state and timers need, for the time a query is started and run."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before else spark.conf.unset(_STORE)


def job_states(events: DataFrame, max_age: timedelta, delay: str = "1 second") -> DataFrame:
    """A stream of states from a stream of (job, at, step, progress): a row for each job that a batch touches, and one when it expires. Events that come later than `delay` behind the newest are dropped, as the watermark says."""
    return events.withWatermark("at", delay).groupBy("job").transformWithStateInPandas(JobState(max_age), outputStructType=_OUT, outputMode="Update", timeMode="EventTime")


def keep(states: DataFrame, table: LedgerTable, query: str, checkpoint: str, **hooks):
    """Run a stream of states over all that there is, into a ledger table; a restart from the checkpoint goes on, and writes no batch twice."""

    def write(batch: DataFrame, number: int) -> None:
        table.upsert(batch.withColumn("moved", F.struct("updated_at", "expired")), query, number, **hooks)

    return states.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()


STATES = _OUT + ", moved struct<updated_at:timestamp,expired:boolean>"


def state_table(spark: SparkSession, folder: str, buckets: int = 16) -> LedgerTable:
    return LedgerTable(spark, folder, STATES, "job", "moved", buckets)
