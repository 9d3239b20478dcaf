"""Texts that queries write come in pieces of bounded size, and what is read from them is that of the whole."""

import pytest

from factloom.operators import borders
from factloom.plans import scan_queries


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(scan_queries, "PIECE_IDS", 40)
    monkeypatch.setattr(scan_queries, "PIECE_ROWS", 10)


def test_texts_have_a_bounded_length_and_their_places(spark, small):
    rows = spark.createDataFrame([(i, "b" if i < 300 else None, f"l{i} ", "R10W", " r") for i in range(-20, 320)], "id long, doc string, lead string, change string, rest string")
    texts = scan_queries._texts(rows, "Head\n").collect()
    assert max(len(r.text) for r in texts) < 90 * 12 and len(texts) > 6
    for doc, ids in (("b", range(-20, 300)), (None, range(300, 320))):
        own = "Head\n" + "\n".join(f"l{i} R10W r" for i in ids)
        pieces = [r for r in texts if r.doc.doc == doc]
        assert sum(len(r.text) - 5 for r in pieces) == len(own) - 5 - (len(pieces) - 1)
        assert all(own[5 + r.doc.at :].startswith(r.text[5:]) for r in pieces)


@pytest.mark.parametrize("name", ["linear_table_facts", "mention_genes"])
def test_pieces_say_the_same_as_the_whole(spark, monkeypatch, small, name):
    query = getattr(scan_queries, name)
    few = sorted(map(tuple, query(spark, "/root/testdata/sf0.001").collect()), key=repr)
    monkeypatch.setattr(scan_queries, "PIECE_IDS", 1 << 40)
    monkeypatch.setattr(scan_queries, "PIECE_ROWS", 1 << 40)
    assert few == sorted(map(tuple, query(spark, "/root/testdata/sf0.001").collect()), key=repr)


def test_steps_of_a_long_linear_table_take_a_byte_each():
    import tracemalloc

    types = ["gene", "protein", "count", "count", "words"] * 4000
    tracemalloc.start()
    try:
        cost, places = borders._aligned(types, types[:5])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert cost == 0 and places == [0, 1, 2, 3, 4] * 4000 and peak < 3_000_000
