"""Exons, coding offsets and structural keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def feature_table(lines: DataFrame, gene: str = "gene", text: str = "value") -> DataFrame:
    """gene, kind (exon or CDS), start, end from tab lines of three parts or more; spans given backwards are turned."""
    parts = F.split(F.col(text), "\t", -1)
    number = lambda n: F.regexp_extract(parts[n], r"\d+", 0).try_cast("int")
    rows = lines.where(F.size(parts) >= 3).select(gene, parts[2].alias("kind"), F.least(number(0), number(1)).alias("start"), F.greatest(number(0), number(1)).alias("end"))
    return rows.where(F.col("kind").isin("exon", "CDS") & F.col("start").isNotNull())


def exon_records(exons: DataFrame, coding: DataFrame, gene: str = "gene") -> DataFrame:
    """Per exon its part in the coding span, the offset of coding bases before it, and whether its loss keeps the frame.

    exons: gene, start, end; coding: gene, cds_start, cds_end (one row per gene).
    """
    both = exons.join(coding, gene).withColumn("exon", F.row_number().over(Window.partitionBy(gene).orderBy("start")))
    length = F.greatest(F.least("end", "cds_end") - F.greatest("start", "cds_start") + 1, F.lit(0))
    before = Window.partitionBy(gene).orderBy("exon").rowsBetween(Window.unboundedPreceding, -1)
    out = both.withColumn("coding_length", length).withColumn("offset", F.coalesce(F.sum("coding_length").over(before), F.lit(0)))
    return out.withColumn("in_frame", (F.col("coding_length") > 0) & (F.col("offset") % 3 == 0) & (F.col("coding_length") % 3 == 0)).withColumn(
        "first_residue", F.when(F.col("coding_length") > 0, F.floor(F.col("offset") / 3) + 1)
    ).withColumn("last_residue", F.when(F.col("coding_length") > 0, F.ceil((F.col("offset") + F.col("coding_length")) / 3)))


def deletion_spans(events: DataFrame, records: DataFrame, gene: str = "gene") -> DataFrame:
    """Events (gene, first_exon, last_exon) with the residues they delete and whether the frame holds."""
    inside = records.join(events, gene).where("exon between first_exon and last_exon")
    sums = inside.groupBy(gene, "first_exon", "last_exon").agg(F.min("first_residue").alias("from_residue"), F.max("last_residue").alias("to_residue"), (F.sum("coding_length") % 3 == 0).alias("in_frame"))
    return sums.withColumn("key", F.when(F.col("in_frame"), F.concat(F.lit("del:"), F.col("from_residue"), F.lit("-"), F.col("to_residue"))))
