"""Registered queries of the gates on harvested texts, links and reviews, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import gates, notation
from factloom.plans.queries import query
from factloom.session import table

#: Documents as harvested texts: with the heads, marks and ends that the gates look for.
HARVESTED = (
    "CASE doc_id % 12 WHEN 0 THEN '# ABSTRACT-ONLY FALLBACK ' || text WHEN 1 THEN 'Full text could not be retrieved. It contains only the PubMed abstract. ' || text "
    "WHEN 2 THEN '<!-- SUPPLEMENT_SURFACE_STATUS: Unavailable -->' || chr(10) || text WHEN 3 THEN 'SUPPLEMENT_SURFACE_STATUS: ok' || chr(10) || 'SUPPLEMENT_SURFACE_STATUS: scrape_error' || chr(10) || text "
    "WHEN 4 THEN '# REHARVESTED FULL TEXT ' || text WHEN 5 THEN text || ' Buy this article' WHEN 6 THEN repeat(text || chr(10), 20) WHEN 7 THEN NULL WHEN 8 THEN '' "
    "WHEN 9 THEN text || ' please Enable Cookies ' ELSE text END"
)


def _any(text: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in phrases) + ")"


_LINES = "len(list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: x <> '' AND left(x, 1) NOT IN ('#', '>')))"
_ABSTRACT = "coalesce(contains(lower(left(t, 8192)), '# abstract-only fallback') OR (contains(lower(left(t, 8192)), 'full text could not be retrieved') AND contains(lower(left(t, 8192)), 'contains only the pubmed abstract')), false)"
_STATUS = "coalesce(lower(trim(regexp_extract(left(t, 8192), 'SUPPLEMENT_SURFACE_STATUS:([^\\r\\n]*)', 1), ' -!><')) IN ('unavailable', 'scrape_error'), false)"


@query(f"""WITH d AS (SELECT doc_id, {HARVESTED} AS t, CASE WHEN doc_id % 5 = 0 THEN 'abstract_only' END AS status, CASE WHEN doc_id % 7 = 0 THEN 'PubMed_abstract' END AS source FROM documents)
SELECT doc_id, {_ABSTRACT} AS abstract_only, {_STATUS} AS incomplete, coalesce(length(left(t, 8192)) >= 500, false) AND NOT {_ABSTRACT} AS usable, coalesce(length(left(t, 8192)) >= 500, false) AND NOT {_ABSTRACT} AND NOT {_STATUS} AS reusable,
  CASE WHEN t IS NULL OR t = '' THEN 'empty' WHEN {_any("lower(t)", gates.PAYWALL_SENTINELS)} THEN 'paywall' WHEN length(t) < 4000 THEN 'short' WHEN length(t) < 8000 AND {_LINES} < 15 THEN 'few lines' ELSE 'ok' END AS body,
  CASE WHEN t IS NULL THEN 'missing' WHEN contains(left(t, 500), '# ABSTRACT-ONLY FALLBACK') THEN 'abstract' WHEN contains(left(t, 200), '# REHARVESTED FULL TEXT') THEN 'already' WHEN strlen(t) < 4000 THEN 'tiny'
    WHEN {_any("lower(t)", gates.PAYWALL_SENTINELS)} THEN 'paywall' WHEN length(t) < 8000 AND {_LINES} < 15 THEN 'few lines' ELSE 'ok' END AS reharvest,
  t IS NULL OR t = '' OR contains(lower(left(t, 12000)), 'abstract-only fallback') OR {_any("lower(left(t, 12000))", gates.SHELL_MARKERS)}
    OR (strlen(t) < 5000 AND (coalesce(status = 'abstract_only', false) OR source IS NOT NULL)) AS retry FROM d""")
def source_gates(spark, sf):
    t, status, source = F.col("t"), F.col("status"), F.col("source")
    d = table(spark, sf, "documents").selectExpr("doc_id", f"{HARVESTED} AS t", "CASE WHEN doc_id % 5 = 0 THEN 'abstract_only' END AS status", "CASE WHEN doc_id % 7 = 0 THEN 'PubMed_abstract' END AS source")
    return d.select(
        "doc_id", gates.abstract_only(t).alias("abstract_only"), gates.incomplete_supplement(t).alias("incomplete"), gates.usable_source(t).alias("usable"), gates.reusable_source(t).alias("reusable"),
        gates.body_reason(t).alias("body"), gates.reharvest_reason(t).alias("reharvest"), gates.needs_retry(t, status, source).alias("retry"),
    )


_REVIEW = {
    "id": "o_orderkey",
    "verdict": "CASE o_orderstatus WHEN 'F' THEN 'Flag' WHEN 'O' THEN 'pass' END",
    "flags": "CAST(CASE WHEN o_custkey % 4 = 0 THEN o_custkey % 3 END AS INT)",
    "missing": "CAST(CASE WHEN o_custkey % 5 < 3 THEN o_custkey % 2 END AS INT)",
    "status": "CASE o_custkey % 4 WHEN 0 THEN 'complete' WHEN 1 THEN 'OK' WHEN 2 THEN 'partial' END",
    "truncated": "o_orderkey % 6 = 1",
    "confidence": "CASE o_orderkey % 5 WHEN 0 THEN '0.95' WHEN 1 THEN '0.5' WHEN 2 THEN 'high' WHEN 3 THEN '0.9' END",
}
_REVIEW_SQL = "SELECT " + ", ".join(f"{e} AS {a}" for a, e in _REVIEW.items()) + " FROM orders"


@query(f"""WITH r AS ({_REVIEW_SQL}) SELECT id, array_to_string(list_filter([CASE WHEN lower(verdict) = 'flag' THEN 'cheap_flagged' END, CASE WHEN flags > 0 THEN 'cheap_flags' END, CASE WHEN missing > 0 THEN 'cheap_missing_carriers' END,
  CASE WHEN lower(status) NOT IN ('complete', 'ok') THEN 'completeness_not_complete' END, CASE WHEN truncated THEN 'source_truncated' END, CASE WHEN TRY_CAST(confidence AS DOUBLE) < 0.9 THEN 'low_cheap_confidence' END,
  CASE WHEN confidence IS NOT NULL AND TRY_CAST(confidence AS DOUBLE) IS NULL THEN 'unparseable_confidence' END], lambda x: x IS NOT NULL), ',') AS reasons FROM r""")
def review_escalation(spark, sf):
    r = table(spark, sf, "orders").selectExpr(*[f"{e} AS {a}" for a, e in _REVIEW.items()])
    reasons = gates.escalation(*(F.col(c) for c in ("verdict", "flags", "missing", "status", "truncated", "confidence")))
    return r.select("id", F.array_join(reasons, ",").alias("reasons"))


_LINK = {
    "id": "p_partkey",
    "doi": "CASE p_partkey % 9 WHEN 0 THEN '10.1016/J.' || p_size WHEN 1 THEN '10.1111/j.1' WHEN 2 THEN '10.1038/ng' || p_size WHEN 3 THEN '10.1002/' WHEN 4 THEN '10.1186/s' WHEN 5 THEN '10.10161/x' WHEN 6 THEN NULL WHEN 7 THEN '10.1365/q' ELSE 'doi:10.1016/x' END",
    "url": "CASE p_partkey % 10 WHEN 0 THEN 'https://www.omim.org/entry/' || p_size WHEN 1 THEN 'http://ftp.UniProt.org' WHEN 2 THEN 'https://notomim.org/x' WHEN 3 THEN 'https://www.ncbi.nlm.nih.gov/clinvar/variation/1' WHEN 4 THEN 'https://www.ncbi.nlm.nih.gov/pubmed/1' WHEN 5 THEN '/files/S1.PDF?download=1' WHEN 6 THEN 'https://x.org/a/table.xlsx#p' WHEN 7 THEN 'https://x.org/view?file=a.pdf' WHEN 8 THEN NULL ELSE ' https://x.org/a%2Ezip ' END",
    "open_access": "CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END",
    "in_archive": "p_partkey % 7 = 0",
    "landing": "CASE p_size % 5 WHEN 0 THEN 'Please Verify you are no robot' WHEN 1 THEN 'Get access or subscribe' WHEN 2 THEN 'Cloudflare; purchase' WHEN 3 THEN 'welcome' END",
    "change": "CASE p_partkey % 8 WHEN 0 THEN 'p.Arg175His' WHEN 1 THEN 'V600E' WHEN 2 THEN 'Gly12Asp' WHEN 3 THEN 'A' || (p_partkey % 2000) || 'V' WHEN 4 THEN 'E545Kfs' WHEN 5 THEN 'c.12A>G' WHEN 6 THEN 'H1047R' END",
    "gene": "CASE p_size % 3 WHEN 0 THEN 'BRAF' WHEN 1 THEN 'TP53' ELSE 'GENE1' END",
    "long": "CASE WHEN p_size % 4 > 0 THEN 700 END",
}
_LINK_SQL = "SELECT " + ", ".join(f"{e} AS {a}" for a, e in _LINK.items()) + " FROM part"
#: What the changes above are in the short form, said by hand.
_SHORT = "CASE id % 8 WHEN 0 THEN 'R175H' WHEN 1 THEN 'V600E' WHEN 2 THEN 'G12D' WHEN 3 THEN change WHEN 4 THEN 'E545fsX' WHEN 6 THEN 'H1047R' END"


@query(f"""WITH p AS ({_LINK_SQL}), q AS (SELECT *, {_SHORT} AS s FROM p)
SELECT id, CASE id % 9 WHEN 0 THEN 'elsevier' WHEN 1 THEN 'wiley' WHEN 2 THEN 'springer' WHEN 3 THEN 'wiley' WHEN 4 THEN 'springer' WHEN 7 THEN 'springer' END AS publisher, id % 10 IN (0, 1, 3) AS tool, id % 10 IN (5, 6, 9) AS supplement,
  CASE WHEN open_access OR in_archive THEN CASE WHEN landing LIKE 'Please%' OR landing LIKE 'Cloud%' THEN 'FREE_BUT_BLOCKED' ELSE 'FREE_BUT_MISSED' END WHEN landing LIKE 'Please%' THEN 'FREE_BUT_BLOCKED' WHEN landing LIKE 'Get%' OR landing LIKE 'Cloud%' THEN 'TRULY_PAYWALLED' ELSE 'LIKELY_PAYWALLED' END AS cause,
  CASE WHEN (s = 'R175H' AND gene <> 'TP53') OR (s = 'V600E' AND gene <> 'BRAF') OR s IN ('G12D', 'H1047R') THEN 'hotspot' WHEN CAST(regexp_extract(s, '[0-9]+') AS INT) > long THEN 'beyond' END AS non_target,
  long IS NULL OR coalesce(CAST(regexp_extract(s, '[0-9]+') AS INT), 0) BETWEEN 1 AND long AS valid FROM q""")
def link_and_target_gates(spark, sf):
    c = F.col
    p = table(spark, sf, "part").selectExpr(*[f"{e} AS {a}" for a, e in _LINK.items()]).withColumn("s", notation.short_protein(c("change")))
    at = F.coalesce(notation.position(c("s")), F.lit(0))
    return p.select(
        "id", gates.publisher(c("doi")).alias("publisher"), gates.tool_link(c("url")).alias("tool"), gates.supplement_file(c("url")).alias("supplement"),
        gates.paywall_cause(c("open_access"), c("in_archive"), c("landing")).alias("cause"), gates.non_target_reason(c("s"), c("gene"), c("long")).alias("non_target"), gates.valid_position(at, c("long")).alias("valid"),
    )
