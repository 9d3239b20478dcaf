"""Hard negatives, token files and whitening on hard little tables, each against a plain version."""

import math
import random
import re
import tempfile
import zlib

import numpy as np
import pytest

from factloom.llm import negatives, packing, token_file, vectors, whitening
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, label int, _id string, _x string, component string, n string, start string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, *["clash"] * 6) for i, v, label in rows], VECTORS)


def plain_x(vector):
    return [math.floor(256 * float(np.float32(c))) for c in vector]


def usable(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def many(seed, n, width, labels, spread=0.3):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(width)], rng.randrange(labels)) for i in range(n)]


BAD = [(900, None, 1), (901, [0.1, None], 1), (902, [float("nan")], 1), (903, [float("inf"), 0.0], 1), (904, [0.5, 0.5, 0.5], None), (None, [0.5, 0.5, 0.5], 1)]


# ---- 11


def plain_negatives(rows, anchor, positives=5, negatives=5, low=80):
    own, seen = [], set()
    for i, v, label in rows:
        if i is None or label is None or not usable(v):
            continue
        key = (i, label, tuple(plain_x(v)))
        if key not in seen:
            seen.add(key)
            own.append((i, label, plain_x(v)))
    out = []
    for i, label, x in own:
        if not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), j, m) for j, m, y in own]
        near = sorted((s, j) for s, j, m in scored if m == label and j != i)[:positives]
        for s, j in near:
            far = sorted((t, k) for t, k, m in scored if m != label and low * -s <= 100 * -t <= 100 * -s)[:negatives]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(far, 1)]
    return sorted(out)


@pytest.mark.parametrize(("width", "labels", "sizes"), [(3, 2, (4, 2, 3)), (7, 40, (5, 3, 4)), (64, 10, (4096, 32, 128)), (5, 1, (7, 2, 2))])
def test_hard_negatives_equal_brute_force(spark, width, labels, sizes):
    rows = many(width, 140, width, labels) + BAD
    rows += [(i, list(v), label) for i, v, label in rows[:30]]  # repeated rows
    rows += [(i + 2000, list(rows[9][1]), i % 3) for i in range(20)]  # ties of score
    rows += [(3000, [0.25], 0), (3001, [0.25, 0.0], 1), (3010, [], 0), (3002, [-0.5] * (width + 3), 1), (10, [0.5] * width, 0)]
    block, chunk, panel = sizes
    found = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 5 == 0, block=block, chunk=chunk, panel=panel)
    assert sorted(tuple(r) for r in found.collect()) == plain_negatives(rows, lambda i: i % 5 == 0)


def test_hard_negatives_of_a_hot_label_with_one_vector(spark):
    rows = [(i, [0.5, 0.5], 1) for i in range(60)] + [(i, [0.45, 0.5], 2) for i in range(60, 80)] + [(i, [-0.5, 0.1], 3) for i in range(80, 90)]
    found = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, block=8, panel=3)
    assert sorted(tuple(r) for r in found.collect()) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_hard_negatives_of_nothing(spark):
    for rows in ([], BAD, [(1, [0.5], 1)]):
        found = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") == 1)
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and not found.count()


def test_scores_beyond_a_long_are_refused(spark):
    with pytest.raises(ValueError, match="long"):
        negatives.hard_negatives(frame(spark, [(1, [1e30, 1.0], 1)]), F.col("vec_id") == 1)


def test_tiles_come_back(spark):
    rng = np.random.default_rng(1)
    for top in (0, 1, 200, 70_000, 2**40, 2**62):
        x = rng.integers(-top, top + 1, (5, 7))
        assert (negatives.unpacked(negatives.packed(x)) == x).all()
    assert negatives.unpacked(negatives.packed(np.zeros((3, 0), np.int64))).shape == (3, 0)
    a, b = rng.integers(-(2**30), 2**30, (4, 3)), rng.integers(-(2**29), 2**29, (2, 3))  # beyond exact doubles
    assert (negatives.product(a, b) == np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a])).all()


# ---- 12


def test_numbers_come_back_from_control_and_data():
    rng = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 5, 1000, 300_000):
        x = rng.integers(0, 2 ** rng.integers(1, 33, n), dtype=np.uint64).astype(np.uint32)
        control, data = token_file.coded(x)
        assert (token_file.decoded(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n) == x).all()
        assert len(control) == -(-n // 4) and len(data) == sum(max(1, (int(v).bit_length() + 7) // 8) for v in x)


def test_words_come_apart_as_by_the_public_pattern_and_are_asked_once(monkeypatch):
    """Sets of characters instead of categories part the same words; the model is asked at a word's first sight only, as long as generations hold it."""
    public = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
    encoder, asked, rng = token_file.Encoder(packing.default_folder()), [], random.Random(4)
    own = encoder.known.tokenize
    monkeypatch.setattr(encoder.known, "tokenize", lambda w: asked.append(w) or own(w))
    letters = [chr(c) for c in (*range(0x80), *range(0xA0, 0x250))]
    texts = ["".join(rng.choice(letters if rng.random() < 0.5 else " 'st_a9\n.") for _ in range(rng.randrange(14))) for _ in range(5000)]
    split = [t for t in texts if encoder._split(t)]
    assert len(split) > 2000 and all(public.findall(t) == encoder._word.findall(t) for t in split)
    assert not any(encoder._split(t) for t in ("a<|b", "\x1c", "é\x1d", "½", "x²", "漢", "\x85"))
    monkeypatch.setattr(token_file, "WORDS", 4)
    for _ in range(3):
        encoder.ids(["süß der Tag", "der Tag"])
    assert len(asked) == len(set(asked)) == 4


def test_words_have_the_ids_of_the_tokenizer():
    rng = random.Random(3)
    alphabet = "abcXYZ  \n\t\r'0123456789.,;:_-#ßéÀÿŁǅʼ²³¹¼×÷ªº \x1c\x1f\x85\x00\x7f漢字 👍́ɏɐ'"
    texts = ["".join(rng.choice(alphabet if k % 2 else "ab '_9é \n.") for _ in range(rng.randrange(60))) for k in range(4000)]
    texts += ["", "<|endoftext|>", "a<|endoftext|>b", "it's we'll 'tis'd", "  x   \n\n y  ", "__init__ a_b", " " * 500, "a" * 3000]
    encoder = token_file.Encoder(packing.default_folder())
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert ids.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 0], text


TEXTS = [(7, "one two three"), (3, None), (3, ""), (5, "über 12 <|endoftext|>"), (5, "b"), (5, "a"), (None, "no id"), (9, "word " * 3000), (8, "x" * 20_000), (7, "one two three"), (2**40, "漢字"), (-4, "below zero")]


@pytest.mark.parametrize(("file_text", "block_ids"), [(1 << 26, 1 << 20), (10, 1), (500, 7)])
def test_files_hold_every_document_in_order(spark, file_text, block_ids):
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in TEXTS], "doc_id long, text string, block string, part int, _hash string")
    path = "file://" + tempfile.mkdtemp() + "/ids"
    token_file.write_ids(docs, path, file_text=file_text, block_ids=block_ids)
    found = token_file.read_ids(spark, path).orderBy("start").collect()
    encoder = token_file.Encoder(packing.default_folder())
    plain = {(i, tuple(encoder.ids([t or ""])[0])) for i, t in TEXTS}
    assert len(found) == len(TEXTS) and {(r.doc_id, tuple(np.frombuffer(bytes(r.ids), "<u4"))) for r in found} == plain
    order = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert order == sorted(order)
    assert [r.start for r in found] == [sum(f.n_tokens for f in found[:k]) for k in range(len(found))]
    assert all(r.n_tokens * 4 == len(r.ids) for r in found)


def test_empty_table_of_documents(spark):
    path = "file://" + tempfile.mkdtemp() + "/ids"
    token_file.write_ids(spark.createDataFrame([], "doc_id long, text string"), path)
    assert not token_file.read_ids(spark, path).count()


def test_changed_bytes_are_told():
    block = token_file.block_bytes(0, 0, 0, [1], [4], np.array([5, 5, 9, 0], np.uint32))
    assert [(k, n, i.tolist()) for k, n, i in token_file.block_rows(block)] == [(1, 0, [5, 5, 9, 0])]
    for broken, said in ((block[:-1] + bytes([block[-1] ^ 1]), "changed"), (block[:-1], "end"), (b"x" + block, "no block")):
        with pytest.raises(ValueError, match=said):
            list(token_file.block_rows(broken))


def test_the_mark_never_stands_in_a_block(monkeypatch):
    ids = np.array([3, 1, 2, 1, 1, 0], np.uint32)
    block = token_file.block_bytes(1, 2, 3, [4], [6], ids)
    monkeypatch.setattr(token_file, "MARK", block[-4:].decode("ascii"))  # what the data end in
    other = token_file.block_bytes(1, 2, 3, [4], [6], ids)
    assert block[-4:] not in other and token_file.head_of(other)[-1] > 0
    assert [(k, at, i.tolist()) for k, at, i in token_file.block_rows(other)] == [(4, 3, ids.tolist())]


# ---- 13


def plain_whitening(rows, k=4):
    own = [(i, plain_x(v)) for i, v, _ in rows if usable(v)]
    width = max((len(x) for _, x in own), default=0)
    fit = np.array([list(x) + [0] * (width - len(x)) for x in {tuple(x) for _, x in own}], np.int64).reshape(-1, width)
    sums, n = fit.sum(0), len(fit)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for i, x in own:
        x = np.array(list(x) + [0] * (width - len(x)), np.int64)
        for c in range(min(k, width)):
            value, axis = values[::-1][c], axes[:, ::-1][:, c]
            out[i, c + 1] = (n, int(((n * x - sums) ** 2).sum()), abs(float((x - sums / n) @ axis)) / math.sqrt(value), value / values.sum())
    return out


@pytest.mark.parametrize("width", [2, 6, 64])
def test_whitening_equals_numpy(spark, width):
    rng = random.Random(width)
    rows = [(i, [rng.gauss(0.1, 0.05 * (1 + d % 5)) for d in range(width)], 0) for i in range(300)] + BAD[:4] + [(990, [0.3] * (width - 1), 1)]
    rows += [(5000 + i, list(rows[4][1]), None) for i in range(120)]  # one vector of a third of the rows
    found = whitening.whiten(frame(spark, rows).repartition(7)).collect()
    plain = plain_whitening(rows)
    assert len(found) == len(plain) and {(r.vec_id, r.component) for r in found} == set(plain)
    for r in found:
        n, deviation, white, explained = plain[r.vec_id, r.component]
        assert (r.n, int(r.deviation)) == (n, deviation) and r.identity_error < 1e-9
        assert abs(r.whitened) == pytest.approx(white, rel=1e-6, abs=1e-9) and r.explained == pytest.approx(explained, rel=1e-9)
    signs = {(r.vec_id, r.component): r.whitened for r in found}
    assert all(signs[4, c] == signs[5000, c] for c in range(1, min(4, width) + 1))


def test_merged_moments_are_those_of_all_rows():
    rng = np.random.default_rng(4)
    x = rng.integers(-100, 100, (500, 5)) + np.array([10**9, 0, 0, 0, 5])
    for cuts in ([], [1], [250], [3, 4, 5, 499], list(range(1, 500, 7))):
        merged = whitening.Moments.none()
        for part in np.split(x, cuts):
            merged = merged.merged(whitening.Moments.of(part))
        whole = whitening.Moments.of(x)
        assert merged.n == 500 and merged.sums == whole.sums == [int(s) for s in x.sum(0)]
        assert np.allclose(merged.scatter, whole.scatter, rtol=1e-9) and np.allclose(merged.mean, x.mean(0), rtol=1e-12)


def test_whitening_without_variance_or_rows(spark):
    assert not whitening.whiten(frame(spark, [])).count() and not whitening.whiten(frame(spark, BAD[:4])).count()
    flat = whitening.whiten(frame(spark, [(1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1)])).collect()
    assert [(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in flat] == [(0.0, None, None, 0)] * 4
    line = whitening.whiten(frame(spark, [(i, [i / 8, i / 4], 1) for i in range(5)])).collect()
    assert {r.component: round(r.explained, 9) for r in line} == {1: 1.0, 2: 0.0} and all(r.identity_error < 1e-9 for r in line)
    assert not whitening.whiten(frame(spark, [(1, [], 1)])).count()


def test_deviations_beyond_a_long(spark):
    rows = [(1, [3e8, -3e8], 1), (2, [1e8, 2e8], 1), (3, [0.0, 0.0], 1)]
    x = {i: plain_x(v) for i, v, _ in rows}
    sums = [sum(v[d] for v in x.values()) for d in range(2)]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert {r.vec_id: int(r.deviation) for r in found} == {i: sum((3 * v[d] - sums[d]) ** 2 for d in range(2)) for i, v in x.items()}
    assert vectors.largest(np.array([[-(2**63)]])) == 2**63
