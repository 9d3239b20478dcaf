"""Cross-entropy difference: bigram models of a target set and of all documents, over one vocabulary.

P(w2 | w1) = (c(w1 w2) + ALPHA) / (c(w1) + ALPHA * V) for both models, V being
the size of the vocabulary of all documents (of which the target is part). The
log of it splits into one term for the bigram and one for its context, so each
n-gram can be looked up by itself, wherever its counts are.

N-grams are 64-bit hashes. Frequent ones ("heads": in at least 1 / HEAD_SHARE of
the documents, so at most HEAD_SHARE times the n-grams of a mean document) are
counted by partial sums and looked up in a broadcast table. The others are dealt
over buckets by hash; a bucket's task counts its n-grams over the whole corpus
and scores the same entries, so no model is ever held in one place. An n-gram of
one document alone adds what an n-gram without counts does, which its document
knows by itself; so a bucket only tells the differences that n-grams of several
documents make, and only of the documents that have such.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm import textvec
from factloom.llm.spread import cut, drop

ALPHA = 0.1
HEAD_SHARE = 200
#: Entries (document and n-gram) that a bucket holds, about; there are LEAST_BUCKETS at least.
BUCKET_ENTRIES = 4_000_000
LEAST_BUCKETS = 64
SLOT_BITS = 18
#: Bits of an n-gram's hash that its bucket does not tell.
KEY_BITS = 40
BROADCAST_IDS = 1_000_000

#: A count takes 7 bits; this value says that it stands whole among the large ones.
_FULL = 127

#: What rows of sums begin with; the header of a slice begins with other bytes.
_SUMS = b"sums"
_START = np.uint64(0x5851F42D4C957F2D)
_CONTEXT = np.uint64(0x14057B7EF767814F)


def entries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, rows and counts of the distinct n-grams of each row (lowest bit: 1 for a context), tokens per row, and word hashes."""
    words, rows = textvec.word_hashes(data, offsets)
    n = len(offsets) - 1
    tokens = np.bincount(rows, minlength=n).astype(np.int64)
    if not len(words):
        none = np.zeros(0, np.int64)
        return words, none, none, tokens, words
    before = np.empty_like(words)
    before[0], before[1:] = _START, words[:-1]
    before[np.concatenate([[0], np.flatnonzero(rows[1:] != rows[:-1]) + 1])] = _START
    pairs = textvec.pair_hash(before, words) & ~np.uint64(1)
    contexts = textvec.mix(before + _CONTEXT) | np.uint64(1)
    keys, owners, counts = [], [], []
    bounds = np.concatenate([[0], np.cumsum(tokens)])
    for i in np.flatnonzero(tokens):
        lo, hi = bounds[i], bounds[i + 1]
        own = np.sort(np.concatenate([pairs[lo:hi], contexts[lo:hi]]))
        first = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
        keys.append(own[first])
        counts.append(np.diff(np.append(first, len(own))))
        owners.append(np.full(len(first), i))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(counts), tokens, words


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(1)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, tokens (kinds 0 and 1) and entries by slot (2) of a partition; the distinct words of every slice (3)."""
    loads = np.zeros(1 << SLOT_BITS, np.int64)
    docs = tokens = 0
    row = lambda kind, place, n: pa.RecordBatch.from_arrays([pa.array(np.full(len(place), kind)), pa.array(place), pa.array(n)], names=["kind", "place", "n"])
    for batch in textvec.slices(batches, "_text"):
        data, offsets = textvec.text_buffers(batch.column("_text"))
        keys, _, _, own, words = entries(data, offsets)
        loads += np.bincount(_slot(keys), minlength=len(loads))
        docs += batch.num_rows
        tokens += int(own.sum())
        distinct = np.unique(words).view(np.int64)
        yield row(3, distinct, np.ones(len(distinct), np.int64))
    yield row(0, np.array([0]), np.array([docs]))
    yield row(1, np.array([0]), np.array([tokens]))
    slots = np.flatnonzero(loads)
    yield row(2, slots, loads[slots])


def _terms(keys_are_context: np.ndarray, counts: np.ndarray, own: np.ndarray, vocabulary: float) -> np.ndarray:
    """What entries add to log P: counts without the document's own, so that no document vouches for itself."""
    logs = np.log(np.maximum(counts - own, 0) + np.where(keys_are_context, ALPHA * vocabulary, ALPHA))
    return np.where(keys_are_context, -logs, logs)


def _alone(keys_are_context: np.ndarray, vocabulary: float) -> np.ndarray:
    """The same for n-grams that no other document has."""
    return np.where(keys_are_context, -np.log(ALPHA * vocabulary), np.log(ALPHA))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "target") -> DataFrame:
    """One row per input row: id, n_tokens, loss_target, loss_background, score.

    Losses are mean negative log-likelihoods of a token; score is
    loss_background - loss_target, so it is high where the target model fits
    better. `target_col` is true for documents of the target set; null is false.
    Words are runs of no white space, A-Z as a-z. Null and empty texts have no
    tokens and null losses and score. Repeated rows count each time. Ids are
    whole numbers; null ids are kept. Other columns are ignored; no rows give
    no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.coalesce(F.col(target_col), F.lit(False)).alias("_target"))
    survey = cut(rows.select("_text").mapInArrow(_survey, "kind long, place long, n long"))
    loads, totals = np.zeros(1 << SLOT_BITS, np.int64), [0, 0]
    got = survey.where("kind < 3").groupBy("kind", "place").agg(F.sum("n").alias("total")).toArrow()  # at most 2 + 2**SLOT_BITS rows
    kind, place, total = (got.column(c).to_numpy() for c in ("kind", "place", "total"))
    for k in (0, 1):
        totals[k] = int(total[kind == k].sum())
    loads[place[kind == 2]] = total[kind == 2]
    number, _ = totals
    vocabulary = survey.where("kind = 3").select("place").distinct().count() + 1
    drop(survey)
    buckets = LEAST_BUCKETS
    while buckets * BUCKET_ENTRIES < loads.sum():
        buckets *= 2
    bits = buckets.bit_length() - 1
    least = max(2, -(-number // HEAD_SHARE))
    sc = docs.sparkSession.sparkContext
    heavy = sc.broadcast(loads >= least)

    def sum_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textvec.slices(batches, "_text"):
            keys, owner, counts, _, _ = entries(*textvec.text_buffers(batch.column("_text")))
            mine = heavy.value[_slot(keys)]
            keys, owner, counts = keys[mine], owner[mine], counts[mine]
            target = batch.column("_target").to_numpy(zero_copy_only=False).astype(bool)[owner]
            order = np.argsort(keys, kind="stable")
            keys, counts, target = keys[order], counts[order], target[order]
            first = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1]) if len(keys) else np.zeros(0, np.int64)
            add = lambda x: np.add.reduceat(x, first) if len(first) else x  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[first].view(np.int64)), pa.array(np.diff(np.append(first, len(keys)))), pa.array(add(counts)), pa.array(add(counts * target))], names=["key", "docs", "all", "target"]
            )

    by_key = rows.select("_text", "_target").mapInArrow(sum_heads, "key long, docs long, all long, target long").groupBy("key").agg(*(F.sum(c).alias(c) for c in ("docs", "all", "target")))
    heads = by_key.where(F.col("docs") >= least).toArrow()  # at most HEAD_SHARE times the n-grams of a mean document
    head_keys = heads.column("key").to_numpy().view(np.uint64)
    order = np.argsort(head_keys)
    table = sc.broadcast((head_keys[order], np.stack([heads.column(c).to_numpy()[order] for c in ("target", "all")]).astype(np.int64)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per slice a header with its ids, tokens and the scores of heads, and a packed row for each bucket."""
        part, number = TaskContext.get().partitionId(), 0
        head, both = table.value
        for batch in textvec.slices(batches, "_text"):
            keys, owner, counts, tokens, _ = entries(*textvec.text_buffers(batch.column("_text")))
            target = batch.column("_target").to_numpy(zero_copy_only=False).astype(bool)
            at = np.minimum(np.searchsorted(head, keys), max(0, len(head) - 1))
            known = head[at] == keys if len(head) else np.zeros(len(keys), bool)
            sums = np.zeros((2, batch.num_rows))
            k, o, c = keys[known], owner[known], counts[known]
            context = (k & np.uint64(1)).astype(bool)
            for side in (0, 1):
                own = c if side else c * target[o]
                sums[side] = np.bincount(o, c * _terms(context, both[side][at[known]], own, vocabulary), minlength=batch.num_rows)
            keys, owner, counts = keys[~known], owner[~known], counts[~known]
            alone = np.bincount(owner, counts * _alone((keys & np.uint64(1)).astype(bool), vocabulary), minlength=batch.num_rows)
            sums += alone  # as if nobody else had these n-grams
            ids = batch.column("_id")
            header = pa.table({"id": ids, "tokens": pa.array(tokens), "t": pa.array(sums[0]), "b": pa.array(sums[1])})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, header.schema) as out:
                out.write_table(header)
            slice_id = part << 32 | number
            number += 1
            order = np.argsort(keys, kind="stable")
            keys, owner, counts = keys[order], owner[order], counts[order]
            bounds = np.searchsorted(keys, np.arange(1, buckets, dtype=np.uint64) << np.uint64(64 - bits))
            rest = keys << np.uint64(bits) >> np.uint64(64 - KEY_BITS) & ~np.uint64(1) | keys & np.uint64(1)
            low, high = rest.astype("<u4"), (rest >> np.uint64(32)).astype(np.uint8)
            large = counts >= _FULL
            flagged = (np.minimum(counts, _FULL) | target[owner].astype(np.int64) << 7).astype(np.uint8)
            wide = "<u2" if batch.num_rows <= 0xFFFF else "<u4"
            out = {"bucket": [-1 - slice_id % buckets], "slice": [slice_id], "size": [batch.num_rows], "keys": [sink.getvalue().to_pybytes()], "high": [b""], "owners": [b""], "counts": [b""], "large": [b""]}
            for b, (lo, hi) in enumerate(zip(np.append(0, bounds), np.append(bounds, len(keys)), strict=True)):
                if hi > lo:
                    for name, x in zip(out, (b, slice_id, batch.num_rows, low[lo:hi].tobytes(), high[lo:hi].tobytes(), owner[lo:hi].astype(wide).tobytes(), flagged[lo:hi].tobytes(), counts[lo:hi][large[lo:hi]].astype("<u4").tobytes()), strict=True):
                        out[name].append(x)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("bucket", pa.int64()), ("slice", pa.int64()), ("size", pa.int64()), *((n, pa.binary()) for n in ("keys", "high", "owners", "counts", "large"))]))

    def count_and_score(group: pa.Table) -> pa.Table:
        form = pa.schema([("slice", pa.int64()), ("size", pa.int64()), ("packed", pa.binary())])
        if group.column("bucket")[0].as_py() < 0:
            return pa.table([group.column("slice"), group.column("size"), group.column("keys")], schema=form)
        sizes = group.column("size").to_pylist()
        keys = [np.frombuffer(x.as_py(), "<u4").astype(np.uint64) | np.frombuffer(y.as_py(), np.uint8).astype(np.uint64) << np.uint64(32) for x, y in zip(group.column("keys"), group.column("high"), strict=True)]
        lengths = np.array([len(k) for k in keys])
        base = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.concatenate([np.frombuffer(x.as_py(), "<u2" if s <= 0xFFFF else "<u4").astype(np.int64) for x, s in zip(group.column("owners"), sizes, strict=True)]) + np.repeat(base[:-1], lengths)
        flagged = np.frombuffer(b"".join(group.column("counts").to_pylist()), np.uint8)
        keys = np.concatenate(keys)
        counts, target = (flagged & _FULL).astype(np.int64), flagged >> 7
        counts[counts == _FULL] = np.frombuffer(b"".join(group.column("large").to_pylist()), "<u4")
        order = np.argsort(keys, kind="stable")
        keys, owner, counts, target = keys[order], owner[order], counts[order], target[order]
        first = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
        times = np.diff(np.append(first, len(keys)))
        context = (keys & np.uint64(1)).astype(bool)
        shared = np.repeat(np.diff(np.append(first, len(keys))) > 1, times)  # the others add what their documents know
        owners, place = np.unique(owner[shared], return_inverse=True)
        sums = np.zeros((len(owners), 2), "<f4")
        for side in (0, 1):
            own = counts if side else counts * target
            total = np.repeat(np.add.reduceat(own, first), times)
            more = counts * (_terms(context, total, own, vocabulary) - _alone(context, vocabulary))
            sums[:, side] = np.bincount(place, more[shared], minlength=len(owners))
        bounds = np.searchsorted(owners, base)
        some = np.flatnonzero(bounds[1:] > bounds[:-1])
        packed = [_SUMS + np.uint32(bounds[i + 1] - bounds[i]).tobytes() + (owners[bounds[i] : bounds[i + 1]] - base[i]).astype("<u2" if sizes[i] <= 0xFFFF else "<u4").tobytes() + sums[bounds[i] : bounds[i + 1]].tobytes() for i in some]
        at = pa.array(some)
        return pa.table([group.column("slice").take(at), group.column("size").take(at), pa.array(packed, pa.binary())], schema=form)

    def gather(group: pa.Table) -> pa.Table:
        header, size = None, group.column("size")[0].as_py()
        sums = np.zeros((size, 2))
        for packed in group.column("packed"):
            raw = packed.as_py()
            if raw[:4] == _SUMS:
                n, wide = int(np.frombuffer(raw, "<u4", 1, 4)[0]), 2 if size <= 0xFFFF else 4
                sums[np.frombuffer(raw, f"<u{wide}", n, 8)] += np.frombuffer(raw, "<f4", 2 * n, 8 + wide * n).reshape(n, 2)
            else:
                header = pa.ipc.open_stream(raw).read_all()
        tokens = header.column("tokens").to_numpy()
        with np.errstate(divide="ignore", invalid="ignore"):
            target = -(sums[:, 0] + header.column("t").to_numpy()) / tokens
            back = -(sums[:, 1] + header.column("b").to_numpy()) / tokens
        none = tokens == 0
        value = lambda x: pa.array(x, pa.float64(), mask=none)
        return pa.table({"_id": header.column("id"), "n_tokens": pa.array(tokens), "loss_target": value(target), "loss_background": value(back), "score": value(back - target)})

    dealt = rows.mapInArrow(deal, "bucket long, slice long, size long, keys binary, high binary, owners binary, counts binary, large binary")
    parts = dealt.groupBy("bucket").applyInArrow(count_and_score, "slice long, size long, packed binary")
    out = parts.groupBy("slice").applyInArrow(gather, "_id long, n_tokens long, loss_target double, loss_background double, score double")
    return out.withColumnRenamed("_id", id_col)


def op6(spark, sf_dir: str) -> DataFrame:
    """Target: documents labelled good. A label table is small, so its ids are broadcast up to BROADCAST_IDS, beyond that joined by a shuffle."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id").distinct().withColumn("target", F.lit(True))
    if good.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    return score(docs.join(good, "doc_id", "left"))
