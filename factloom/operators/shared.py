"""Tables written to the folder that all executors share, to fix rows that are read more than once."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, SparkSession] = {}


def folder_of(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a local folder only in local mode, where that need not be set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Rows of a partition of dealt().
ROWS_A_TASK = 250_000


def dealt(frame: DataFrame, *keys: str) -> DataFrame:
    """The rows by hash of their keys, in as many partitions as their number asks for: aggregates and joins on the keys need no other shuffle, and what a task holds does not grow with the table."""
    return frame.repartition(max(1, -(-frame.count() // ROWS_A_TASK)), *keys)


def fixed(frame: DataFrame) -> DataFrame:
    """The rows by way of a table in the shared folder; it is there until discard() or exit."""
    spark = frame.sparkSession
    path = f"{folder_of(spark)}/fixed-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    _made[path] = spark
    out = spark.read.schema(frame.schema).parquet(path)
    out._fixed_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the tables of rows that nobody will read again."""
    for frame in frames:
        path = getattr(frame, "_fixed_path", None)
        if path and (spark := _made.pop(path, None)):
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _discard_all() -> None:
    for path, spark in list(_made.items()):
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # the session has ended; the folder's owner clears it
            return
