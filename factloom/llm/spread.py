"""Shared-storage cuts, joins on skewed keys, and connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot in a join when it holds over 1/HOT_SHARE of the rows, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 500
HOT_SALTS = 64

_made: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a local folder only in local mode, where none need be set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(frame: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends there, and lost executors lose nothing."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    _made[path] = spark
    out = spark.read.schema(frame.schema).parquet(path)
    out._cut_path = path
    return out


def scratch(spark: SparkSession) -> str:
    """A new folder of the shared storage for an operator's own files; it is deleted at exit."""
    path = f"{shared_folder(spark)}/out-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


def drop(*frames: DataFrame) -> None:
    """Delete cuts whose rows nobody will read again."""
    for frame in frames:
        path = getattr(frame, "_cut_path", None)
        if path and (spark := _made.pop(path, None)):
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _delete_all() -> None:
    for path, spark in list(_made.items()):
        try:
            _delete(spark, path)
        except Exception:  # the session has ended; the folder's owner clears it
            return


def hot_keys(rows: DataFrame, key: str) -> DataFrame | None:
    """The keys that hold over 1/HOT_SHARE of the rows, fewer than HOT_SHARE by definition; None where there are none."""
    found = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") * HOT_SHARE > max(rows.count(), HOT_SHARE * HOT_SALTS)).select(key).toArrow()
    return F.broadcast(rows.sparkSession.createDataFrame(found).withColumn("_hot", F.lit(True))) if found.num_rows else None


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """Join on `key`, unique in `right`: right rows of hot keys are repeated over HOT_SALTS salts, their left rows dealt over these."""
    if hot is None:
        return left.join(right, key, how)
    salt = F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(HOT_SALTS))).otherwise(F.lit(0)).cast("int")
    dealt = left.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = right.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return dealt.join(spread, [key, "_salt"], how).drop("_salt")


def skewed_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on `key`, unique in `right`, where a few keys may hold most rows of `left`."""
    return salted_join(left, right, key, hot_keys(left.select(key), key), how)


def component_labels(links: DataFrame) -> DataFrame:
    """(id, label) for every id in the links (a, b): the smallest id reachable from it.

    Every round takes the least label among neighbours, then follows labels to
    their own labels, so long chains shorten by halves. An end of very many
    links and a label of very many ids are dealt over salts. Rounds go through
    the shared folder; nothing is collected but whether a label changed.
    """
    both = cut(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    hubs = hot_keys(both.select("a"), "a")
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    while True:
        near = salted_join(both, labels.withColumnRenamed("id", "a"), "a", hubs).groupBy(F.col("b").alias("id")).agg(F.min("label").alias("near"))
        step = cut(labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = step.select(F.col("id").alias("label"), F.col("label").alias("next"))
        new = cut(skewed_join(step, jump, "label").select("id", F.least("label", "next").alias("label"), "old"))
        changed = new.where("label <> old").limit(1).count()
        drop(step, labels)
        labels = new
        if not changed:
            break
    drop(both)
    return labels.select("id", "label")
