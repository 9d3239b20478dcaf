"""Corpus cleaning in stages: language ID, exact dedup, near-dedup, benchmark decontamination, packing.

Every stage reads all rows that its predecessor kept, through Parquet, and each
but the last returns the columns of documents, further ones included, whatever
their names. For all stages: null texts have no language and end at the first
stage (alone, later stages take them as empty); rows without an id are kept
where their text is; of equal or near texts the least id stays, so ties are of
equal ids alone and repeated rows of one id stay or go together, but for exact
copies, of which one row stays; an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import decontaminate, exact_dedup, language_id, near_dedup, packing
from factloom.llm.spread import cut
from factloom.session import ship


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; the model learns from the same documents as op2."""
    ship(spark)
    return language_id.keep_identified(docs, language_id.fit(docs, ~language_id.held_out()))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copy with the smallest id of each text; of repeated rows one, of copies without any id one."""
    ship(spark)
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by a similarity of 0.8 on five-word shingles.

    Rows without an id go by a hash of their text above all ids (exact copies are
    gone by then). Null and empty texts are linked with nothing and stay.
    """
    ship(spark)
    own = F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1))
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id"), own).alias("id"), F.col("text").alias("text"))
    kept = near_dedup.near_dedup(rows, id_col="id").where("kept").select("id").distinct()
    return rows.join(kept, "id", "left_semi").select("row.*")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts have none, repeated rows stay or go together."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, packed into sequences; every row by itself, null texts as the end id alone."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack_sequences),
]

#: SQL cannot express language ID, near copies at scale, alignment or packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
