"""Session settings and table loading."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

#: What the operators expect of a session; sizes of partitions are left to the cluster and to adaptive execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def session(name: str = "factloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map={**SETTINGS, **settings})
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder; filters and columns are pushed down to the scan by whoever reads it."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers find this library where the driver found it, whatever folder they start in."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (home, known) if x)
