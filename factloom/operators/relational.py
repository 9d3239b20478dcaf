"""Joins, identity, de-duplication, intervals and windows of the evidence tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.operators.shared import fixed


def latest(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The row with the greatest `order` of each key: a partial aggregation, without sorting a group."""
    packed = F.max_by(F.struct(*[F.col(c) for c in rows.columns if c not in key]), order).alias("_row")
    return rows.groupBy(*key).agg(packed).select(*key, "_row.*")


def first_seen(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by `order`, which must tell rows apart."""
    packed = F.min_by(F.struct(*[F.col(c) for c in rows.columns if c not in key]), F.struct(*order)).alias("_row")
    return rows.groupBy(*key).agg(packed).select(*key, "_row.*")


def richest(rows: DataFrame, key: list[str], rich: Column, order: str) -> DataFrame:
    """One row of each key: the first rich one, else the first; rows whose whole key is blank are dropped; keeps `position`, the place of the first."""
    some = F.coalesce(*[F.nullif(F.trim(F.col(k).cast("string")), F.lit("")) for k in key]).isNotNull()
    best = F.min_by(F.struct(*[F.col(c) for c in rows.columns if c not in key]), F.struct((~rich).alias("poor"), F.col(order))).alias("_row")
    return rows.where(some).groupBy(*key).agg(best, F.min(order).alias("position")).select(*key, "_row.*", "position")


def link_spine(sources: list[DataFrame], key: list[str]) -> DataFrame:
    """Every key that any source has, once."""
    spine = sources[0].select(*key)
    for s in sources[1:]:
        spine = spine.union(s.select(*key))
    return spine.distinct()


def with_precedence(spine: DataFrame, layers: list[DataFrame], key: list[str], fields: list[str]) -> DataFrame:
    """Each field from the first layer that states it; layers have one row per key."""
    out = spine
    for n, layer in enumerate(layers):
        out = out.join(layer.select(*key, *[F.col(f).alias(f"_{n}_{f}") for f in fields]), key, "left")
    return out.select(*key, *[F.coalesce(*[F.col(f"_{n}_{f}") for n in range(len(layers))]).alias(f) for f in fields])


def count_gaps(rows: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Keys of which some field is null on every row, with those fields."""
    stated = rows.groupBy(*key).agg(*[F.max(F.col(f).isNotNull()).alias(f) for f in fields])
    return stated.withColumn("missing", F.array_compact(F.array(*[F.when(~F.col(f), F.lit(f)) for f in fields]))).where(F.size("missing") > 0).select(*key, "missing")


def null_safe_join(left: DataFrame, right: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """Join where null equals null; the key of the left side is kept."""
    r = right.select(*[F.col(k).alias(f"_{k}") for k in key], *[c for c in right.columns if c not in key])
    on = F.lit(True)
    for k in key:
        on = on & left[k].eqNullSafe(r[f"_{k}"])
    return left.join(r, on, how).drop(*[f"_{k}" for k in key])


def upsert(stored: DataFrame, incoming: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Stored rows with their null fields filled from incoming ones, and new keys added; null equals null in a key. Both have one row per key."""
    s = stored.select(*key, *[F.col(f).alias(f"_s_{f}") for f in fields], F.lit(True).alias("_stored"))
    i = incoming.select(*[F.col(k).alias(f"_i_{k}") for k in key], *[F.col(f).alias(f"_i_{f}") for f in fields], F.lit(True).alias("_new"))
    on = F.lit(True)
    for k in key:
        on = on & s[k].eqNullSafe(i[f"_i_{k}"])
    both = s.join(i, on, "full_outer")
    pick = lambda k: F.when(F.col("_stored"), F.col(k)).otherwise(F.col(f"_i_{k}")).alias(k)
    return both.select(*map(pick, key), *[F.coalesce(f"_s_{f}", f"_i_{f}").alias(f) for f in fields], F.when(F.col("_stored") & F.col("_new"), "updated").when(F.col("_stored"), "kept").otherwise("added").alias("action"))


def collapse_duplicates(rows: DataFrame, value_columns: list[str], row_id: str) -> tuple[DataFrame, DataFrame]:
    """(one row per distinct values, null equal to null, with the smallest id; every id with the id that stays)."""
    kept = rows.groupBy(*value_columns).agg(F.min(row_id).alias(row_id))
    moved = null_safe_join(rows, kept.withColumnRenamed(row_id, "keeper_id"), value_columns).select(row_id, "keeper_id")
    return kept, moved


def snapshot_diff(before: DataFrame, after: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """key, change: added, removed, updated or same, by a hash of the fields."""
    packed = F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
    b, a = before.select(*key, packed.alias("_b")), after.select(*key, packed.alias("_a"))
    kind = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(F.col("_a") == F.col("_b"), "same").otherwise("updated")
    return b.join(a, key, "full_outer").select(*key, kind.alias("change"))


def complementary_merge(rows: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Rows of a key become one where every field has at most one stated value; other keys keep their rows as strata."""
    spread = rows.groupBy(*key).agg(*[F.count_distinct(f).alias(f"_n_{f}") for f in fields])
    clash = F.greatest(*[F.col(f"_n_{f}") for f in fields], F.lit(0)) > 1
    marked = rows.join(spread.select(*key, clash.alias("_clash")), key)
    merged = marked.where(~F.col("_clash")).groupBy(*key).agg(*[F.max(f).alias(f) for f in fields])
    return merged.unionByName(marked.where("_clash").select(*key, *fields))


def coalesce_intervals(rows: DataFrame, by: list[str], start: str, end: str, gap: float = 0, more: Sequence[Column] = ()) -> DataFrame:
    """Intervals of a group merged where one starts no more than `gap` after the greatest end so far; `more` are further aggregates."""
    order = Window.partitionBy(*by).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col(start) > reach + gap), 1).otherwise(0)
    island = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = rows.withColumn("_new", new).withColumn("island", island)
    return marked.groupBy(*by, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n"), *more)


def context_window(lines: DataFrame, by: list[str], order: str, text: str, around: int = 2) -> DataFrame:
    """Each line with the lines around it."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-around, around)
    return lines.withColumn("context", F.array_join(F.collect_list(text).over(w), "\n"))


def nearest_before(lines: DataFrame, by: list[str], order: str, header: Column, name: str = "section") -> DataFrame:
    """Each line with the last header at or before it."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(name, F.last_value(header, True).over(w))


def prioritise(candidates: DataFrame, score: str, ties: list[Column], top: int | None, offset: int = 0) -> DataFrame:
    """rank over all candidates by score and ties, and whether it lies in [offset, offset + top).

    Ranks come from ranges: rows are dealt by score range and numbered within
    partitions, then moved by the rows of lower partitions, so no single task sorts all.
    """
    order = [F.col(score).desc(), *ties]
    dealt = candidates.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = dealt.withColumn("_id", F.monotonically_increasing_id())
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    placed = fixed(placed.withColumn("_part", part).withColumn("_place", place))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = placed.join(sizes.select("_part", before.alias("_before")), "_part").withColumn("rank", F.col("_before") + F.col("_place") + 1)
    inside = F.lit(True) if not top else F.col("rank").between(offset + 1, offset + top)
    return ranked.withColumn("selected", inside).drop("_id", "_part", "_place", "_before")


def quarantine(rows: DataFrame, bad_ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows without the bad ids, rows with them)."""
    ids = bad_ids.select(key).distinct()
    return rows.join(ids, key, "left_anti"), rows.join(ids, key, "left_semi")
