"""Exact duplicates: 128-bit content hash, smallest or largest id stays, bytes compared inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.spread import cut, skewed_join


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=None, stay: str = "min") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by the MD5 of the normalised text (128 bits), combined
    before the shuffle. Each group also carries its least and greatest text, so
    texts are compared byte by byte: where the two differ, a hash collision put
    unlike texts together, and that group is formed again on the texts.

    `normalise` maps the text column to the one compared (default: as it is).
    `stay` says which id of a group stays: "min" or "max".

    Null text counts as empty; empty texts form one group. A row repeated with
    the same id counts in group_size each time, and every copy is returned. A
    null id is never the one that stays unless its whole group has null ids; kept
    is then false. No rows give no rows; other columns are ignored.
    """
    pick = {"min": F.min, "max": F.max}[stay]
    text: Column = F.coalesce(F.col(text_col), F.lit(""))
    text = normalise(text) if normalise else text
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    hashed = rows.select("_id", "_text", F.unhex(F.md5("_text")).alias("_key"))
    groups = cut(
        hashed.groupBy("_key").agg(
            pick("_id").alias("_keep"),
            F.count(F.lit(1)).alias("_size"),
            F.min("_text").alias("_least"),
            F.max("_text").alias("_most"),
        ).select("_key", "_keep", "_size", (F.col("_least") != F.col("_most")).alias("_mixed"))
    )
    ids = hashed.select("_id", "_key", F.sha2("_text", 256).alias("_sha"))
    # A group of one needs no join: what it says is known from the row itself.
    several = groups.where("_size > 1")
    joined = skewed_join(ids, several, "_key", "left")
    plain = joined.where("not coalesce(_mixed, false)").select("_id", F.coalesce("_keep", "_id").alias("_keep"), F.coalesce("_size", F.lit(1)).alias("_size"), "_sha")
    if several.where("_mixed").limit(1).count():
        unlike = hashed.join(F.broadcast(several.where("_mixed").select("_key")) if several.where("_mixed").limit(1001).count() <= 1000 else several.where("_mixed").select("_key"), "_key", "left_semi")
        true_groups = cut(unlike.groupBy("_text").agg(pick("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")))
        plain = plain.union(skewed_join(unlike, true_groups, "_text").select("_id", "_keep", "_size", F.sha2("_text", 256).alias("_sha")))
    return plain.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").cast("long").alias("group_size"),
        F.coalesce(F.col("_id") == F.col("_keep"), F.lit(False)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, with all its columns, of each group of equal texts: that with the smallest id.

    Groups are combined before the shuffle, so a group of any size reaches a
    task as one row from each task that read it. As in exact_dedup, a group
    whose least and greatest texts differ is formed again on the texts. Null
    counts as empty; of rows with equal ids any one stays; a null id comes last.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.unhex(F.md5(text)).alias("_key"), text.alias("_text"), F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i")).alias("_order"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    first = F.min_by("_row", "_order").alias("_row")
    groups = cut(rows.groupBy("_key").agg(first, (F.min("_text") != F.max("_text")).alias("_mixed")))
    out = groups.where("not _mixed").select("_row.*")
    mixed = groups.where("_mixed").select("_key")
    if mixed.limit(1).count():
        out = out.union(rows.join(mixed, "_key", "left_semi").groupBy("_text").agg(first).select("_row.*"))
    return out


def op3(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), stay="max")


ORACLE = """
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(coalesce(d.text, '')) AS text_sha256
FROM documents d
JOIN (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1) g
  ON coalesce(d.text, '') = g.t
"""
