"""Connected identities against a plain union-find, with chains, hubs and conflicts."""

import random

import pytest

from factloom.operators import graph

ROW = "id long, gene string, cdna string, genomic string, legacy string, protein string"
SHARED, SINGLE = ["cdna", "genomic", "legacy"], ["protein", "cdna", "genomic", "legacy"]


def plain_components(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {x: root(x) for x in list(parent)}


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(300)], [(0, i) for i in range(1, 300)] + [(999, i) for i in range(1, 300, 7)], [(i, 500 - i) for i in range(240)] + [(3, 4), (7, 7)], []], ids=["chain", "hubs", "pairs", "none"])
def test_components(spark, links):
    found = {r.id: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    plain = {k: v for k, v in plain_components(links).items() if any(k in x and x[0] != x[1] for x in links)}
    assert found == plain


def test_components_of_random_links(spark):
    rng = random.Random(3)
    links = [(rng.randrange(900), rng.randrange(900)) for _ in range(600)]
    found = {r.id: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    plain = plain_components(links)
    assert all(found[k] == plain[k] for k in found) and {k for a, b in links if a != b for k in (a, b)} == set(found)


def plain_identities(rows):
    label = {r[0]: r[0] for r in rows}
    groups = {}
    for r in rows:
        own = [x.strip() or None if x else None for x in r[2:]]
        for k, v in [*((k, own[k]) for k in range(3)), ("all", tuple(own))]:
            if v is not None:
                groups.setdefault((r[1], k, v), []).append(r[0])
    label = plain_components([(ids[0], i) for ids in groups.values() for i in ids])
    members = {}
    for r in rows:
        members.setdefault(label[r[0]], []).append(r)
    out = {}
    for rows_ in members.values():
        own = {r[0]: tuple((x.strip() or None) if x else None for x in r[2:]) for r in rows_}
        two = any(len({v[k] for v in own.values()} - {None}) > 1 for k in range(4))
        for r in rows_:
            out[r[0]] = (min(i for i in own if own[i] == own[r[0]]) if two else min(own), two)
    return out


def test_identities_equal_union_find_in_any_order(spark):
    rng = random.Random(5)
    pick = lambda name, n: rng.choice([None, "", *[f"{name}{k}" for k in range(n)]])
    rows = [(i, rng.choice(["G1", "G2", None]), pick("c", 30), pick("g", 30), pick("l", 30), pick("p", 3)) for i in range(150)]
    plain = plain_identities(rows)
    for _ in range(2):
        rng.shuffle(rows)
        found = graph.identities(spark.createDataFrame(rows, ROW), SHARED, SINGLE)
        assert {r.id: (r.variant_id, r.ambiguous) for r in found.collect()} == plain


def test_aliases_of_a_chain_and_not_of_a_conflict(spark):
    chain = [(1, "G", "c1", None, None, None), (2, "G", "c1", "g1", None, None), (3, "G", None, "g1", "l1", "p1"), (4, "G", None, None, None, "p1")]
    conflict = [(10, "G", "c9", None, None, "p1"), (11, "G", "c9", None, None, "p2"), (12, "G", "c9", None, None, "p2")]
    rows = spark.createDataFrame(chain + conflict, ROW)
    found = graph.identities(rows, SHARED, SINGLE)
    assert {r.id: r.variant_id for r in found.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 10: 10, 11: 11, 12: 11}
    assert {tuple(r) for r in graph.aliases(rows, found, [*SHARED, "protein"]).collect()} == {(1, "cdna", "c1"), (1, "genomic", "g1"), (1, "legacy", "l1"), (1, "protein", "p1"), (4, "protein", "p1")}
    merged = {r.variant_id: (r.cdna, r.genomic, r.legacy, r.protein, r.n_rows) for r in graph.enriched(rows, found, [*SHARED, "protein"]).collect()}
    assert merged[1] == ("c1", "g1", "l1", "p1", 3) and merged[11] == ("c9", None, None, "p2", 2)
    assert not graph.identities(rows.limit(0), SHARED, SINGLE).count()
