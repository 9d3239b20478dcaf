"""Recall, error and precision of extracted rows against a curated reference set.

`rows` holds one row per compared fact: paper, variant, match (bool: both
sides), in_gold, in_found, and for each field gold_<f> and found_<f> counts.
All of it is partial aggregation: what is shuffled is one row per group and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.counts import ratio

FIELDS = ("carriers", "affected", "unaffected")


def aggregate_counts(facts: DataFrame, keys: list[str], fields: tuple[str, ...] = FIELDS, layer: str | None = None) -> DataFrame:
    """Per key the sum of each count (null if none is stated) and whether it is stated; layers are one name or "mixed"."""
    out = [x for f in fields for x in (F.sum(f).cast("long").alias(f), F.max(F.col(f).isNotNull()).alias(f"{f}_present"))]
    if layer:
        out.append(F.when(F.count_distinct(layer) > 1, "mixed").otherwise(F.min(layer)).alias("layer"))
    return facts.groupBy(*keys).agg(*out, F.count(F.lit(1)).alias("n_rows"))


def compare(gold: DataFrame, found: DataFrame, keys: list[str], fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Full outer comparison on exact keys; both sides have one row per key."""
    g = gold.select(*keys, *[F.col(f).alias(f"gold_{f}") for f in fields], F.lit(True).alias("_g"))
    d = found.select(*keys, *[F.col(f).alias(f"found_{f}") for f in fields], F.lit(True).alias("_d"), *(["layer"] if "layer" in found.columns else []))
    out = g.join(d, keys, "full_outer").withColumn("in_gold", F.coalesce("_g", F.lit(False))).withColumn("in_found", F.coalesce("_d", F.lit(False)))
    return out.withColumn("match", F.col("in_gold") & F.col("in_found")).drop("_g", "_d")


def recall_summary(rows: DataFrame, paper: str, variant: str, fields: tuple[str, ...] = FIELDS, by: list[str] = ()) -> DataFrame:
    """(by), metric, matched, gold, recall: papers, rows, unique variants, and the sums of each count."""
    pairs: list[tuple[str, Column, Column]] = [
        ("papers", F.count_distinct(F.when(F.col("match"), F.col(paper))), F.count_distinct(F.when(F.col("in_gold"), F.col(paper)))),
        ("rows", F.count_if("match"), F.count_if("in_gold")),
        ("unique_variants", F.count_distinct(F.when(F.col("match"), F.col(variant))), F.count_distinct(F.when(F.col("in_gold"), F.col(variant)))),
    ]
    for f in fields:
        gold, found = F.col(f"gold_{f}"), F.col(f"found_{f}")
        pairs.append((f, F.sum(F.when(F.col("match"), F.least(gold, found))), F.sum(F.when(F.col("in_gold"), gold))))
    wide = rows.groupBy(*by).agg(*[x for name, m, g in pairs for x in (m.cast("long").alias(f"{name}_m"), g.cast("long").alias(f"{name}_g"))])
    metric = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"{n}_m").alias("matched"), F.col(f"{n}_g").alias("gold")) for n, _, _ in pairs])).alias("x")
    return wide.select(*by, metric).select(*by, "x.*").withColumn("recall", ratio(F.col("matched"), F.col("gold")))


def matched_error(rows: DataFrame, fields: tuple[str, ...] = FIELDS, by: list[str] = ()) -> DataFrame:
    """(by), field, n, mae, rmse over matched rows where both counts are stated."""
    unpivoted = _errors(rows.where("match"), fields, by).where("gold is not null and found is not null")
    d = F.col("found") - F.col("gold")
    return unpivoted.groupBy(*by, "field").agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"))


def end_to_end_error(rows: DataFrame, fields: tuple[str, ...] = FIELDS, by: list[str] = ()) -> DataFrame:
    """(by), field, n, n_missed, mae, rmse, median, p95, max over all stated gold counts; a count not found is 0."""
    stated = _errors(rows.where("in_gold"), fields, by).where("gold is not null")
    d = F.abs(F.coalesce("found", F.lit(0)) - F.col("gold")).alias("d")
    return stated.withColumn("d", d).groupBy(*by, "field").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("found").isNull()).alias("n_missed"),
        F.avg("d").alias("mae"),
        F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rmse"),
        F.percentile("d", 0.5).alias("median"),
        F.percentile("d", 0.95).alias("p95"),
        F.max("d").cast("long").alias("max_error"),
    )


def _errors(rows: DataFrame, fields: tuple[str, ...], by: list[str]) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"gold_{f}").cast("long").alias("gold"), F.col(f"found_{f}").cast("long").alias("found")) for f in fields])).alias("x")
    return rows.select(*by, each).select(*by, "x.*")


def precision_by_layer(rows: DataFrame, paper: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """layer (ALL for all), matched, extras, counted_extras, raw and counted precision.

    Only papers of the gold set count: extras elsewhere say nothing. A counted
    extra is one with any count.
    """
    gold_papers = rows.where("in_gold").select(paper).distinct()
    own = rows.join(gold_papers, paper, "left_semi").where("in_found")
    counted = F.lit(False)
    for f in fields:
        counted = counted | F.col(f"found_{f}").isNotNull()
    sums = own.rollup("layer").agg(
        F.grouping("layer").alias("_all"),
        F.count_if("match").alias("matched"),
        F.count_if(~F.col("match")).alias("extras"),
        F.count_if(~F.col("match") & counted).alias("counted_extras"),
    )
    named = sums.withColumn("layer", F.when(F.col("_all") == 1, "ALL").otherwise(F.coalesce("layer", F.lit("none")))).drop("_all")
    return named.withColumn("precision", ratio(F.col("matched"), F.col("matched") + F.col("extras"))).withColumn("counted_precision", ratio(F.col("matched"), F.col("matched") + F.col("counted_extras")))


def counted_extras(rows: DataFrame, paper: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Found-only rows with a count, in papers of the gold set."""
    some = F.coalesce(*[F.col(f"found_{f}") for f in fields]).isNotNull()
    return rows.where(F.col("in_found") & ~F.col("in_gold") & some).join(rows.where("in_gold").select(paper).distinct(), paper, "left_semi")


def pooled_recall(parts: DataFrame, by: list[str]) -> DataFrame:
    """Micro-average: sums of matched and gold, then their ratio."""
    return parts.groupBy(*by).agg(F.sum("matched").cast("long").alias("matched"), F.sum("gold").cast("long").alias("gold")).withColumn("recall", ratio(F.col("matched"), F.col("gold")))


def pooled_error(parts: DataFrame, by: list[str]) -> DataFrame:
    """From n, mae, rmse, max_error of parts: pooled n, mae, rmse, max; a median cannot be pooled and is null."""
    n, size = F.sum("n"), F.coalesce(F.col("n"), F.lit(0))
    return parts.groupBy(*by).agg(
        n.cast("long").alias("n"),
        F.try_divide(F.sum(F.coalesce("mae", F.lit(0.0)) * size), F.nullif(n.cast("double"), F.lit(0.0))).alias("mae"),
        F.sqrt(F.try_divide(F.sum(F.coalesce(F.col("rmse") * F.col("rmse"), F.lit(0.0)) * size), F.nullif(n.cast("double"), F.lit(0.0)))).alias("rmse"),
        F.max("max_error").alias("max_error"),
        F.lit(None).cast("double").alias("median"),
    )


def stratified(rows: DataFrame, stratum: str) -> DataFrame:
    """Every row under ALL and under its own stratum."""
    return rows.withColumn("stratum", F.explode(F.array(F.lit("ALL"), F.col(stratum))))


def run_delta(before: DataFrame, after: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """Full outer by key: after - before of each metric; null where either run lacks it."""
    b = before.select(key, *[F.col(m).alias(f"b_{m}") for m in metrics])
    a = after.select(key, *[F.col(m).alias(f"a_{m}") for m in metrics])
    return b.join(a, key, "full_outer").select(key, *[(F.col(f"a_{m}") - F.col(f"b_{m}")).alias(f"d_{m}") for m in metrics])


def health_band(*bad_rates: Column) -> Column:
    """By the worst rate at hand: from .35 needs attention, from .15 watch, else healthy; with none not yet gated."""
    worst = F.greatest(*bad_rates) if len(bad_rates) > 1 else bad_rates[0]
    return F.when(worst >= 0.35, "needs attention").when(worst >= 0.15, "watch").when(worst.isNotNull(), "healthy").otherwise("not yet gated")
