"""All registered queries of the library, and their SQL."""

from __future__ import annotations

from factloom.plans import document_queries, gate_queries, guard_queries, identity_queries, made_queries, repair_queries, rollup_queries, routing_queries, rule_queries, scan_queries, scouting_queries, source_queries, stream_queries, table_queries, warehouse_queries  # noqa: F401  each registers its queries
from factloom.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
