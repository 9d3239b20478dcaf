"""Registered queries of rules on single values: values are spelled from columns of part in several ways, and SQL says from the same columns what a rule must make of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions import counts, links, notation
from factloom.operators import evidence, guards, trust
from factloom.plans.queries import ORACLES, QUERIES
from factloom.session import table

_N = "(p_partkey + 10)"
_R1, _R2 = "substr('ARNDCQEGHILKMFPSTWYV', p_size % 20 + 1, 1)", "substr('ARNDCQEGHILKMFPSTWYV', CAST(p_partkey % 20 AS INT) + 1, 1)"
_T1, _T2 = "substr('AlaArgAsnAspCysGlnGluGlyHisIleLeuLysMetPheProSerThrTrpTyrVal', 3 * (p_size % 20) + 1, 3)", "substr('AlaArgAsnAspCysGlnGluGlyHisIleLeuLysMetPheProSerThrTrpTyrVal', 3 * CAST(p_partkey % 20 AS INT) + 1, 3)"


def _made(name: str, inputs: dict[str, str], outputs: dict[str, str], forms: list[tuple[str, ...]], rule: Callable[..., list[Column]]) -> None:
    """Registers a query: a form has an SQL expression of part's columns for each input, then for each output."""

    def pick(k: int, kind: str) -> str:
        kind = "VARCHAR" if kind == "STRING" else kind
        return f"CAST(CASE p_partkey % {len(forms)} " + " ".join(f"WHEN {i} THEN {f[k]}" for i, f in enumerate(forms)) + f" END AS {kind})"

    said = ", ".join(f"{pick(len(inputs) + n, kind)} AS {out}" for n, (out, kind) in enumerate(outputs.items()))

    def run(spark, sf):
        given = [f"{pick(n, kind).replace('VARCHAR', 'STRING')} AS {i}" for n, (i, kind) in enumerate(inputs.items())]
        rows = table(spark, sf, "part").selectExpr("p_partkey AS id", *given)
        return rows.select("id", *[c.alias(out) for c, out in zip(rule(*[F.col(i) for i in inputs]), outputs, strict=True)])

    run.__name__ = name
    QUERIES[name], ORACLES[name] = run, f"SELECT p_partkey AS id, {said} FROM part"


_joined = lambda c: F.array_join(c, ",")

_made(
    "made_notations", {"v": "STRING"}, {"short": "STRING", "hgvs": "STRING", "canonical": "STRING", "kind": "STRING", "place": "INT", "coding": "STRING"},
    [
        (f"'p.' || {_T1} || {_N} || {_T2}", f"{_R1} || {_N} || {_R2}", f"'p.' || {_T1} || {_N} || {_T2}", f"{_R1} || {_N} || {_R2}", "'missense'", _N, "NULL"),
        (f"{_R1} || {_N} || '*'", f"{_R1} || {_N} || 'X'", f"'p.' || {_T1} || {_N} || '*'", f"{_R1} || {_N} || 'X'", "'nonsense'", _N, "NULL"),
        (f"{_T1} || {_N} || 'fs*' || p_size", f"{_R1} || {_N} || 'fsX'", f"'p.' || {_T1} || {_N} || 'fs*'", f"{_R1} || {_N} || 'fsX'", "'frameshift'", _N, "NULL"),
        (f"'p.' || {_T1} || {_N} || 'del'", "NULL", f"'p.' || {_T1} || {_N} || 'del'", f"{_R1} || {_N} || 'Del'", "'deletion'", _N, "NULL"),
        (f"{_R1} || {_N} || {_R2} || '(het)'", f"{_R1} || {_N} || {_R2}", "NULL", "NULL", "'missense'", _N, "NULL"),
        (f"'c.' || {_N} || 'A>G'", "NULL", "NULL", "NULL", "'unknown'", _N, f"'c.' || {_N} || 'A>G'"),
        (f"{_N} || 'C>T'", "NULL", "NULL", "NULL", "'unknown'", _N, f"'c.' || {_N} || 'C>T'"),
        (f"'p.' || {_T1} || {_N} || '='", f"{_R1} || {_N} || {_R1}", "NULL", "NULL", "'missense'", _N, "NULL"),
    ],
    lambda v: [notation.short_protein(v), notation.hgvs_protein(v), notation.canonical(v), notation.variant_type(F.coalesce(notation.short_protein(v), notation.canonical(v))), notation.position(v), notation.cdna(v)],
)
_made(
    "made_structures", {"v": "STRING"}, {"event": "STRING", "old": "STRING", "shift": "STRING", "stop": "STRING", "cut": "STRING", "twice": "STRING"},
    [
        ("'deletion of exons ' || p_size || '-' || (p_size + 2)", "'del:exon' || p_size || '-' || (p_size + 2)", "NULL", "NULL", "NULL", "NULL", "NULL"),
        ("'exon ' || p_size || ' duplication'", "'dup:exon' || p_size", "NULL", "NULL", "NULL", "NULL", "NULL"),
        (f"{_N} || 'delAG'", "NULL", f"{_N} || 'delAG'", "NULL", "NULL", "NULL", "NULL"),
        (f"{_R1} || {_N} || 'fsX' || p_size", "NULL", "NULL", f"{_R1} || {_N} || 'fsX'", "NULL", "NULL", "NULL"),
        (f"{_T1} || {_N} || 'Ter'", "NULL", "NULL", "NULL", f"{_R1} || {_N} || 'X'", "NULL", "NULL"),
        (f"'del' || {_N}", "NULL", "NULL", "NULL", "NULL", f"'?' || {_N} || 'del'", "NULL"),
        (f"{_R1} || {_N} || '_' || {_R2} || ({_N} + 3) || 'dup'", "NULL", "NULL", "NULL", "NULL", "NULL", f"{_R1} || {_N} || '_' || {_R2} || ({_N} + 3) || 'dup'"),
    ],
    lambda v: [notation.exon_event(v), notation.legacy(v), notation.frameshift(v), notation.nonsense(v), notation.deletion(v), notation.duplication(v)],
)
_made(
    "made_values", {"v": "STRING"}, {"safe": "INT", "lenient": "INT", "first": "INT", "paper": "STRING", "valid": "BOOLEAN", "text": "STRING"},
    [
        ("p_size || '.0'", "p_size", "0", "p_size", "CAST(p_size AS VARCHAR)", "false", "p_size || '.0'"),
        ("' ' || p_size || ' '", "p_size", "p_size", "p_size", "CAST(p_size AS VARCHAR)", "false", "CAST(p_size AS VARCHAR)"),
        ("'about ' || p_size || '-' || (p_size + 5)", "NULL", "0", "p_size", "'about ' || p_size || '-' || (p_size + 5)", "false", "'about ' || p_size || '-' || (p_size + 5)"),
        ("CAST(10000000 + p_partkey AS VARCHAR)", "10000000 + p_partkey", "10000000 + p_partkey", "10000000 + p_partkey", "CAST(10000000 + p_partkey AS VARCHAR)", "true", "CAST(10000000 + p_partkey AS VARCHAR)"),
        ("CASE WHEN p_size % 2 = 0 THEN ' ' END", "NULL", "0", "NULL", "''", "false", "NULL"),
    ],
    lambda v: [counts.safe_int(v), counts.lenient_int(v), counts.first_int(v), F.trim(counts.normal_id(v)), counts.valid_id(v), counts.clean_text(v)],
)
_made(
    "made_references", {"v": "STRING", "w": "STRING"}, {"verdict": "STRING", "agree": "BOOLEAN"},
    [
        (f"{_R1} || (p_size % 20 + 1) || {_R2}", f"'p.' || {_T1} || (p_size % 20 + 1) || {_T2}", "'match'", "true"),
        (f"substr('RNDCQEGHILKMFPSTWYVA', p_size % 20 + 1, 1) || (p_size % 20 + 1) || {_R2}", f"{_R1} || {_N} || 'X'", "'mismatch'", f"p_size % 20 + 1 = {_N}"),
        (f"{_R1} || {_N} || '00' || {_R2}", f"{_R1} || {_N} || '00fsX'", "'out_of_range'", "true"),
        (f"'c.' || {_N} || 'A>G'", f"'c.' || {_N} || '_' || ({_N} + 1) || 'del'", "'unknown'", "false"),
    ],
    lambda v, w: [notation.reference_verdict(v, F.lit("ARNDCQEGHILKMFPSTWYV")), notation.positions_agree(v, w)],
)
_made(
    "made_counts", {"total": "INT", "affected": "INT", "patients": "INT", "status": "STRING", "correction": "INT"}, {"filled": "INT", "checked": "INT", "difference": "INT", "checks": "STRING"},
    [
        ("NULL", "NULL", "p_size", "'supported'", "7", "p_size", "7", "NULL", "''"),
        ("NULL", "p_size", "5", "'unsupported'", "7", "NULL", "NULL", "NULL", "''"),
        ("p_size + 3", "p_size", "0", "'unsure'", "9", "p_size + 3", "p_size + 3", "3", "'warning:parts_below_total'"),
        ("p_size", "p_size + 1", "0", "'supported'", "NULL", "p_size", "p_size", "-1", "'error:parts_exceed_total'"),
    ],
    lambda t, a, n, s, c: [evidence.fill_total(t, a, n), evidence.verified(t, s, c), counts.count_diff(t, a), _joined(trust.fact_checks(t, a, F.when(t.isNotNull() & a.isNotNull(), F.lit(0)), F.lit(None).cast("int"), F.lit(None).cast("double")))],
)
_made(
    "made_places", {"v": "STRING"}, {"place": "STRING", "image": "BOOLEAN", "encoded": "STRING", "ids": "STRING", "dois": "STRING", "spoken": "BOOLEAN"},
    [
        ("'Table S' || p_size || ', row ' || p_partkey", "'S' || p_size || ':' || p_partkey", "false", "'Table%20S' || p_size || '%2C%20row%20' || p_partkey", "''", "''", "false"),
        ("'fig' || p_partkey || '.PNG'", "NULL", "true", "'fig' || p_partkey || '.PNG'", "''", "''", "false"),
        ("'PMID: ' || (1000 + p_partkey) || ', pmid:' || (1000 + p_partkey)", "NULL", "false", "'PMID%3A%20' || (1000 + p_partkey) || '%2C%20pmid%3A' || (1000 + p_partkey)", "CAST(1000 + p_partkey AS VARCHAR)", "''", "false"),
        ("'see 10.1000/a' || p_partkey || '. and 10.1000/a' || p_partkey", "NULL", "false", "'see%2010.1000%2Fa' || p_partkey || '.%20and%2010.1000%2Fa' || p_partkey", "''", "'10.1000/a' || p_partkey", "false"),
        ("'in ' || p_size || '.5% of them'", "NULL", "false", "'in%20' || p_size || '.5%25%20of%20them'", "''", "''", "p_size = 12"),
    ],
    lambda v: [F.concat(links.locator(v)["table"], F.lit(":"), links.locator(v)["row"]), links.image_path(v), links.encode_segment(v), _joined(links.paper_ids(v)), _joined(links.dois(v)), links.percentage_quoted(v, F.lit(12.5))],
)
_made(
    "made_gates", {"layer": "STRING", "protein": "STRING", "text": "STRING"}, {"artifact": "STRING", "ortholog": "BOOLEAN", "layer_of": "STRING"},
    [
        ("'figure'", "'A' || (p_size + 9000) || 'V'", "'human GENE1 of ' || p_brand", "'out_of_range'", "false", "'figure'"),
        ("' LLM_Table '", f"{_R1} || (p_size + 10) || {_R2}", "'in canine GENE1 cells of ' || p_brand", "NULL", "true", "'llm_table'"),
        ("'odd' || p_size", f"{_R1} || (p_size + 10) || 'X'", "'patients with GENE1'", "NULL", "false", "NULL"),
    ],
    lambda layer, protein, text: [guards.artifact_reason(protein, F.lit(""), F.lit(""), F.lit(1000)), guards.nonhuman_ortholog(text, "GENE1"), links.layer_primary(layer)],
)
