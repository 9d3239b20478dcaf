"""Connected identities: rows that share a notation are one variant, where nothing in what they say together conflicts.

Components are found by alternating stars (every node is moved to the least of
its neighbours, first of the larger ones, then of the smaller), which shortens
chains by halves and never lets a hub's links grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators.shared import discard, fixed


def components(links: DataFrame) -> DataFrame:
    """(id, label) for each end of the links (a, b): the least id reachable. Links to itself and null ends are ignored."""
    edges = fixed(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        # Larger stars: the larger neighbours of a node go to the least of its neighbourhood.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = fixed(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # Smaller stars: a node and its smaller neighbours go to the least of these.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        new = fixed(small.distinct())
        discard(edges, large)
        edges = new
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).union(roots)


def identities(rows: DataFrame, shared: list[str], single: list[str], scope: str = "gene", id_col: str = "id") -> DataFrame:
    """For each row: id, variant_id, ambiguous.

    Rows of one scope that share a value of a column in `shared` are connected,
    through others too. A component in which a column of `single` has two values
    holds two identities at least: nothing in it is joined by an alias, and its
    rows are one only where all their columns are equal, null with null. Rows
    that share nothing are by themselves, so a column outside `shared` (a
    protein change, which several coding ones may cause) never joins two rows
    alone, unless all their columns are equal. variant_id is the least id of
    those joined; the order of rows says nothing. Ids must be unique; blank
    notations count as null.
    """
    columns = list(dict.fromkeys([*shared, *single]))
    value = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    own = fixed(rows.select(F.col(id_col).alias("id"), F.col(scope).alias("_scope"), *[value(c).alias(f"_{c}") for c in columns]))
    every = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(f"_{c}").alias("value")) for c in shared])
    said = own.select("id", "_scope", F.explode(every).alias("k")).select("id", "_scope", "k.*").where("value IS NOT NULL")
    # Rows with the same in all columns are connected as well.
    same = own.select("id", "_scope", F.lit("").alias("kind"), F.sha2(F.to_json(F.struct(*[F.coalesce(f"_{c}", F.lit("")).alias(c) for c in columns])), 256).alias("value"))
    keyed = said.union(same)
    # A scope may be null, so joins are on whether it is, too.
    told_of = ["_null", "_of", "kind", "value"]
    keyed = keyed.select("id", F.col("_scope").isNull().alias("_null"), F.coalesce(F.col("_scope").cast("string"), F.lit("")).alias("_of"), "kind", "value")
    first = keyed.groupBy(*told_of).agg(F.min("id").alias("first"))
    by_key = keyed.join(first, told_of)
    label = fixed(components(by_key.select(F.col("id").alias("a"), F.col("first").alias("b"))))
    labelled = own.join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    two = F.lit(False)
    for c in single:
        two = two | F.coalesce(F.min(f"_{c}") != F.max(f"_{c}"), F.lit(False))
    judged = labelled.groupBy("label").agg(two.alias("ambiguous"))
    told = labelled.join(judged, "label").select("id", "label", "ambiguous")
    exact = by_key.where("kind = ''").select("id", "first")
    return told.join(exact, "id").select("id", F.when(F.col("ambiguous"), F.col("first")).otherwise(F.col("label")).alias("variant_id"), "ambiguous")


def enriched(rows: DataFrame, found: DataFrame, columns: list[str], scope: str = "gene", id_col: str = "id") -> DataFrame:
    """One row per variant: variant_id, scope, the value of each column that any of its rows has (the least of several), n_rows."""
    value = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    joined = rows.withColumnRenamed(id_col, "_id").join(found.select(F.col("id").alias("_id"), "variant_id"), "_id")
    return joined.groupBy("variant_id").agg(F.first(scope).alias(scope), *[F.min(value(c)).alias(c) for c in columns], F.count(F.lit(1)).alias("n_rows"))


def aliases(rows: DataFrame, found: DataFrame, columns: list[str], id_col: str = "id") -> DataFrame:
    """(variant_id, kind, value) of all notations of variants that hold no conflict: what a later load may be joined by."""
    sure = rows.withColumnRenamed(id_col, "_id").join(found.where("NOT ambiguous").select(F.col("id").alias("_id"), "variant_id"), "_id")
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias("value")) for c in columns]))
    return sure.select("variant_id", each.alias("a")).select("variant_id", "a.*").where("value IS NOT NULL").distinct()
