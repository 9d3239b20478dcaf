"""Texts and pages that are made to take long: each operator reads them in time and memory that follow their length, and leaves nothing out."""

import random
import re
import time
import tracemalloc

import numpy as np
import pytest

from factloom.llm import decontaminate, html_extract, lm_score, quality, secrets
from pyspark.sql import functions as F


def within(seconds, megabytes, run):
    tracemalloc.start()
    began = time.process_time()
    try:
        out = run()
        took, peak = time.process_time() - began, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert took < seconds and peak < megabytes, (took, peak)
    return out


# ---- 4

HEAD = "eyJhbGciOiJIUzI1NiJ9"  # {"alg":"HS256"}


@pytest.mark.parametrize("text", ["eyJ" * 100_000, "-----BEGIN PRIVATE KEY-----" * 20_000, "eyJ" * 20_000 + ".eyJhbGciOiJ.abcdefgh", ("eyJ" * 40 + ".eyJ") * 2000, "ghp_" * 50_000, "token" * 50_000, "eyJhIjoi" * 20_000 + ".eyJhbGciOiJ.abcdefgh"], ids=range(7))
def test_secrets_of_long_refused_runs(text):
    within(10, 400, lambda: secrets.find_secrets(text))


def test_tokens_behind_refused_ones_are_found():
    token = f"{HEAD}.eyJzdWIiOiIxIn0.abcdefgh12"
    for text in ("eyJ" * 500 + " " + token, "eyJxyz." + token, "eyJ" + token, "a-eyJ_" + token):
        spans = [text[s:e] for s, e, kind in secrets.find_secrets(text) if kind == "jwt"]
        assert spans == [token] or spans == [text[text.index(HEAD) :]]
    text = "-----BEGIN PRIVATE KEY-----a-----END PRIVATE KEY----- x -----BEGIN PRIVATE KEY-----b"
    assert [text[s:e] for s, e, kind in secrets.find_secrets(text)] == ["-----BEGIN PRIVATE KEY-----a-----END PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----"]


# ---- 5


def test_runs_of_signs():
    within(2, 200, lambda: quality.labels("#" * 200_000 + "a"))
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice("ab_é#!. \n\x1c") for _ in range(rng.randrange(30)))
        assert sum(map(quality._odd_end, text.split())) == len(re.findall(r"[^\w\s]{2,}(?!\S)", text))


# ---- 7


def passage(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(n))


@pytest.mark.parametrize("item", ["0" * 150, passage(1)[:120] + "0" * 150 + passage(2)[:120], "0" * 1000])
@pytest.mark.parametrize("n", [20_000, 1_000_000])
def test_long_runs_in_texts_and_items(item, n):
    index = decontaminate.Index([(1, item), (2, passage(3))], decontaminate.WINDOW, decontaminate.ERROR_RATE)
    data = np.frombuffer((passage(4) + " " + "0" * n + " " + passage(3) + " " + passage(5)).encode(), np.uint8)
    found = within(20, 500, lambda: index.matches(data))
    assert {m[0] for m in found} == {1, 2}


def test_a_match_at_either_end_of_a_long_run():
    item = passage(1)[:70] + "0" * 40 + passage(2)[:70]
    index = decontaminate.Index([(1, item)], decontaminate.WINDOW, decontaminate.ERROR_RATE)
    for text in (passage(1)[:70] + "0" * 9000, "0" * 9000 + passage(2)[:70], passage(7) + item + "0" * 9000, "x" * 9000 + item):
        data = np.frombuffer(text.encode(), np.uint8)
        plain = decontaminate.Index([(1, item)], decontaminate.WINDOW, decontaminate.ERROR_RATE)
        plain._outside_runs = lambda grams, hits: hits
        assert {m[:2] for m in index.matches(data)} == {m[:2] for m in plain.matches(data)}


def test_blocks_of_a_benchmark_are_dropped_one_after_another(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    items = spark.createDataFrame([(i, passage(i)) for i in range(4)] + [(9, None)], "item_id long, text string")
    docs = spark.createDataFrame([(i, passage(i % 8) + " more", "x") for i in range(16)] + [(99, None, "x")], "doc_id long, text string, item_id string")
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()) == [4, 5, 6, 7, 12, 13, 14, 15, 99]


# ---- 10


def listing(n, seed):
    rng = random.Random(seed)
    return "<html><body><div class=top>Site</div>" + "".join(f"<div class=item><h3>Name {rng.random()}</h3><div><span>by</span><p>Some words {k} {rng.random()}</p></div></div>" for k in range(n)) + "</body></html>"


@pytest.mark.parametrize("pair", [(listing(800, 1), listing(800, 2)), (listing(4000, 1), listing(3000, 2)), ("".join(f"<div class=c{k % 7}><p>{k}</p><ul><li>{k}</ul></div>" for k in range(2000)),) * 2, ("<div>" * 20_000,) * 2], ids=range(4))
def test_pages_of_many_blocks_are_matched(pair):
    def run():
        a, b = (html_extract.read_tree(html_extract.write_tree(html_extract.Page(x).tree())) for x in pair)
        return html_extract.match_trees(a, b)

    assert within(20, 400, run)[0] >= 1
    for page in pair:
        assert html_extract.Page(page).text().count("Some words") == page.count("Some words")


@pytest.mark.parametrize("source", ["<a " * 100_000, '<a b="' * 100_000, "<!" * 100_000, "<!--" * 50_000, "<a '" * 50_000 + ">", "</" * 100_000, "<script" * 50_000], ids=range(7))
def test_tags_that_never_end(source):
    within(5, 300, lambda: html_extract.Page("<p>Before</p>" + source))
    assert html_extract.Page("<p>Before</p>" + source).text().startswith("Before")


def test_ends_of_pages():
    for source, text in (("a<!-- b", "a"), ("a<!-- b > c", "a"), ("a <b", "a <b"), ("a > b", "a > b"), ("<p>x</p> y <!-- z", "x\ny"), ("1 < 2", "1 < 2"), ("<p>x<!-- y --> z", "x z")):
        assert html_extract.Page(source).text() == text, source


# ---- 6


def test_scores_do_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60))), i % 3 == 0) for i in range(200)] + [(900, None, True), (901, "", None), (None, "w1 w2", True), (5, "w1 w2 w1", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, target boolean")
    say = lambda frame: sorted((r.doc_id or -1, r.n_tokens, round(r.loss_target or 0, 4), round(r.loss_background or 0, 4)) for r in frame.collect())
    few = say(lm_score.score(docs))
    monkeypatch.setattr(lm_score, "BUCKET_ENTRIES", 20)
    assert say(lm_score.score(docs.orderBy(F.rand(1)))) == few
