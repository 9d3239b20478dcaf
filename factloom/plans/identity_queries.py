"""Registered queries of connected identities, on rows made from part, with SQL that knows the blocks they were made in."""

from __future__ import annotations

from factloom.operators import graph
from factloom.plans.queries import query
from factloom.session import table

# Four parts in a row are one variant, told by a chain: a coding notation, that and a genomic one, that and an old label, that and a
# protein change. Every fifth block says two protein changes; a further row of it repeats its second one in all columns.
_ROWS = """SELECT p_partkey AS id, 'GENE' || (CAST(floor(p_partkey / 4) AS BIGINT) % 3) AS gene, CAST(floor(p_partkey / 4) AS BIGINT) AS block,
  CASE WHEN p_partkey % 4 <= 1 THEN 'c.' || CAST(floor(p_partkey / 4) AS BIGINT) || 'A>G' END AS cdna,
  CASE WHEN p_partkey % 4 BETWEEN 1 AND 2 THEN 'g.' || CAST(floor(p_partkey / 4) AS BIGINT) END AS genomic,
  CASE WHEN p_partkey % 4 >= 2 THEN CAST(floor(p_partkey / 4) AS BIGINT) || 'delAG' END AS legacy,
  CASE WHEN p_partkey % 4 = 3 THEN 'p.' || CAST(floor(p_partkey / 4) AS BIGINT) WHEN p_partkey % 4 = 0 AND floor(p_partkey / 4) % 5 = 0 THEN 'p.other' ELSE '' END AS protein
FROM part"""
_SHARED, _SINGLE = ["cdna", "genomic", "legacy"], ["protein", "cdna", "genomic", "legacy"]


def _rows(spark, sf):
    return spark.sql(_ROWS.replace("FROM part", "FROM {part}"), part=table(spark, sf, "part"))


_JUDGED = f"""SELECT r.*, first, bad FROM ({_ROWS}) r JOIN (
  SELECT block, min(id) AS first, count(DISTINCT nullif(protein, '')) > 1 AS bad FROM ({_ROWS}) GROUP BY block) USING (block)"""


@query(f"SELECT id, CASE WHEN bad THEN id ELSE first END AS variant_id, bad AS ambiguous FROM ({_JUDGED})")
def connected_identities(spark, sf):
    return graph.identities(_rows(spark, sf), _SHARED, _SINGLE)


@query(f"SELECT CASE WHEN bad THEN id ELSE first END AS variant_id, max(gene) AS gene, max(cdna) AS cdna, max(genomic) AS genomic, max(legacy) AS legacy, max(nullif(protein, '')) AS protein, count(*) AS n_rows FROM ({_JUDGED}) GROUP BY 1")
def enriched_variants(spark, sf):
    rows = _rows(spark, sf)
    return graph.enriched(rows, graph.identities(rows, _SHARED, _SINGLE), [*_SHARED, "protein"])


@query(f"""SELECT DISTINCT first AS variant_id, kind, value FROM (
  SELECT first, bad, unnest(['cdna', 'genomic', 'legacy', 'protein']) AS kind, unnest([cdna, genomic, legacy, nullif(protein, '')]) AS value FROM ({_JUDGED})) WHERE NOT bad AND value IS NOT NULL""")
def sure_aliases(spark, sf):
    rows = _rows(spark, sf)
    return graph.aliases(rows, graph.identities(rows, _SHARED, _SINGLE), [*_SHARED, "protein"])
