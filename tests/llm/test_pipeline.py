"""The stages on a small table, and the registered queries."""

import corpus_pipeline
from factloom.llm.queries import ORACLES, QUERIES

WORDS = "the quick brown fox jumps over the lazy dog while seven small birds sing near an old stone bridge in the early morning light".split()


def test_stages_in_order(spark, tmp_path):
    base = " ".join(WORDS * 3)
    near = base + " again"
    leak = "benchmark question about the colour of the evening sky above the northern harbour wall"
    rows = [(i, " ".join(f"{WORDS[k % 24]} number {i * 7919 + k}" for k in range(20)), "en") for i in range(24)]
    rows += [(100, base, "en"), (101, base, "en"), (102, near, "en"), (103, None, "en"), (104, "", "en"), (105, f"{base[:60]} {leak} {base[60:90]}", "en"), (106, "123 !!", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        kept[name] = {r.doc_id for r in at.select("doc_id").collect()}
        if name != "packing":
            assert at.columns == docs.columns
    assert {103, 104, 106} & kept["language_id"] == set() and 100 in kept["language_id"]
    assert 101 not in kept["exact_dedup"] and {100, 102} <= kept["exact_dedup"]
    assert 102 not in kept["near_dedup"] and 100 in kept["near_dedup"]
    assert 105 in kept["near_dedup"] and 105 not in kept["decontamination"]
    assert kept["packing"] == kept["decontamination"]


def test_near_dedup_keeps_rows_without_id(spark):
    base, other = " ".join(WORDS * 3), " ".join(f"{w} {i}" for i, w in enumerate(WORDS * 2))
    rows = [(100, base), (None, base + " again"), (None, other), (None, other + " again"), (None, "five words that stand alone")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_exact_copies(spark, docs, ""), "")
    assert found.columns == docs.columns
    kept = {(r.doc_id, r.text) for r in found.collect()}
    assert kept >= {(100, base), (None, "five words that stand alone")} and len(kept) == 3
    assert len(kept & {(None, other), (None, other + " again")}) == 1


def test_stages_on_hard_rows(spark, tmp_path):
    base, long_ = " ".join(WORDS * 3), " ".join(f"{w} {i}" for i, w in enumerate(WORDS * 4000))
    rows = [(1, base), (1, base), (2, long_), (3, None), (None, None), (None, base), (4, ""), (5, base + " again")]
    form = "doc_id long, text string, lang string, source string, n_chars long, _kept int, _near int, id int, row int, text_sha256 string, _text string"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, 3, 4, "x", "y") for i, t in rows], form)
    spark.createDataFrame([(1, "no such thing in any of these texts whatever they say about foxes")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, str(tmp_path))
        if name == "packing":
            assert {r.doc_id for r in out.select("doc_id").collect()} == {1, 2, 3, 4, 5, None}
            continue
        assert out.columns == docs.columns and out.select("_kept", "_near", "id", "row").distinct().count() == 1
        ids = sorted((r.doc_id or 0) for r in out.select("doc_id").collect())
        assert ids == {"exact_dedup": [1, 2, 3, 5], "near_dedup": [0, 1, 1, 2, 3, 4], "decontamination": [0, 0, 1, 1, 2, 3, 4, 5]}[name], name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.identify_language(spark, docs, "").columns == docs.columns
    assert corpus_pipeline.identify_language(spark, docs.limit(0), "").count() == 0


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
