"""Near duplicates: MinHash signatures, an inverted join on their coordinates, links confirmed on full sets.

A signature is a set of SIZE tokens, one for each coordinate and its value. Two
documents whose sets have the similarity sought share about that part of their
tokens; those that share fewer than MATCHES are no candidates. For similarity
0.8 the chance to miss a link so is about one in a million.

Prefix: tokens stand in one global order, rarest first. Two signatures that share
MATCHES tokens share one of their first SIZE - MATCHES + 1, so only these are
posted. Documents that a token brings together are compared where its postings
are: collisions are counted by merging the inverted lists of the group. Skip: a
document that already is in the group's main component is not looked up again.
What leaves a task links each document with the least one connected with it, never
all pairs, so rows grow with the documents. What these links connect are families;
no link can leave its family.

The full texts of a family then meet in the same way, each text once for a small
family, and the exact similarity of its pairs is counted on whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm import textvec
from factloom.llm.spread import component_labels, cut, drop, skewed_join

SIZE = 64
MATCHES = 35
PREFIX = SIZE - MATCHES + 1
#: A group beyond so many rows or bytes is dealt over tasks in blocks.
BLOCK_ROWS = 4096
BLOCK_BYTES = 12 << 20
#: About so many documents of a large group meet every block of it first.
PIVOTS = 64
#: Rows or bytes of small groups that a task compares at a time, about.
TASK_ROWS = 20_000
TASK_BYTES = 6 << 20
#: Slots of the count of tokens: a crowded slot stands out at any size, as the mean grows with the rows.
SLOT_BITS = 18

_rng = np.random.Generator(np.random.PCG64(314159))
_MULTIPLY = _rng.integers(1, 2**63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, SIZE, dtype=np.uint64)
_COORDINATE = np.arange(SIZE, dtype=np.uint64) << np.uint64(32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """SIZE values of 32 bits, each the least of a hash of the shingles."""
    best = np.full(SIZE, np.uint64(2**64 - 1))
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096]
        np.minimum(best, (part[None, :] * _MULTIPLY[:, None] + _ADD[:, None]).min(1), out=best)
    return (best >> np.uint64(32)).astype("<u4")


def _signatures(words: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textvec.slices(batches, "_load"):
            sets = textvec.shingle_sets(*textvec.text_buffers(batch.column("_load")), words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_h"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["_id", "_h", "n_shingles", "_digest", "_sig"],
            )

    return make


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, SIZE)


def _tokens(signatures: np.ndarray) -> np.ndarray:
    return textvec.mix(signatures.astype(np.uint64) | _COORDINATE)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    for batch in batches:
        counts += np.bincount(_slot(_tokens(_stack(batch.column(0)))).ravel(), minlength=len(counts))
    slots = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], names=["slot", "n"])


def _postings(shared, threshold: int):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rarest tokens of each signature, those of a crowded slot marked hot."""
        counts = shared.value
        for batch in batches:
            tokens = _tokens(_stack(batch.column(1)))
            load = counts[_slot(tokens)]
            order = np.lexsort((tokens, load), axis=1)[:, :PREFIX]
            tokens, load = np.take_along_axis(tokens, order, 1).ravel(), np.take_along_axis(load, order, 1).ravel()
            ids = np.repeat(batch.column(0).to_numpy(), PREFIX)
            keep = load > 1  # a slot with one token in all holds no pair
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (load >= threshold, tokens.view(np.int64), ids)], names=["hot", "group", "node"])

    return post


def _not_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings sorted by token: those of tokens with two rows or more."""
    held, open_ = None, False
    for batch in batches:
        tokens, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(tokens):
            continue
        if held is not None:
            tokens, ids = np.append(held[0], tokens), np.append(held[1], ids)
        same = tokens[1:] == tokens[:-1]
        keep = np.r_[open_, same] | np.r_[same, False]
        # The last row waits for the next batch, which tells whether its token goes on.
        held, open_ = (tokens[-1:], ids[-1:]), bool(same[-1]) if len(same) else open_
        yield pa.RecordBatch.from_arrays([pa.array(x[:-1][keep[:-1]]) for x in (tokens, ids)], names=["group", "node"])
    if open_:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["group", "node"])


def _shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One byte of each value of a signature: as many matches or more, a quarter of the size."""
    for batch in batches:
        short = (_stack(batch.column(1)) & 0xFF).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in short], pa.binary())], names=["node", "_load"])


def connect(parts: np.ndarray, lead: int, partners: Callable[[int], np.ndarray]) -> None:
    """Gives all rows linked with each other one number in `parts`; `partners(i)` marks the rows linked with row i.

    A row in the part of `lead` is skipped: its links outward are found from outside.
    """
    for i in (lead, *range(len(parts))):
        if parts[i] == parts[lead] and i != lead:
            continue
        joined = np.unique(parts[partners(i) & (parts != parts[i])])
        if len(joined):
            parts[np.isin(parts, joined)] = parts[i]


def merge_lists(parts: np.ndarray, rows: np.ndarray, elements: np.ndarray, linked: Callable[[int, np.ndarray], np.ndarray]) -> None:
    """connect() by merging inverted lists: `rows` and `elements` are pairs (row, element), sorted by row, elements from 0.

    `linked(i, counts)` says from the number of elements that every row shares
    with row i which rows are linked with it.
    """
    n = len(parts)
    bounds = np.searchsorted(rows, np.arange(n + 1))
    order = np.argsort(elements, kind="stable")
    lists = rows[order]
    begin = np.searchsorted(elements[order], np.arange(int(elements.max()) + 2 if len(elements) else 1))
    size = np.diff(begin)
    names, number = np.unique(parts, return_counts=True)
    main = parts == names[number.argmax()] if number.max() > 1 else np.ones(n, bool)
    # The row of the main part whose elements are the commonest leads: most of a family is linked with it.
    common = np.bincount(rows, size[elements], n) / np.maximum(np.diff(bounds), 1) if len(elements) else np.zeros(n)

    def partners(i: int) -> np.ndarray:
        own = elements[bounds[i] : bounds[i + 1]]
        many = size[own]
        places = np.repeat(begin[own] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        return linked(i, np.bincount(lists[places], minlength=n))

    connect(parts, int(np.where(main, common, -1).argmax()), partners)


def _groups(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows sorted by group and node, and the bounds of the groups."""
    group, node = table.column("group").to_numpy(), table.column("node").to_numpy()
    order = np.lexsort((node, group))
    group = group[order]
    return table.take(pa.array(order)), np.append(np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(group))


def _stars(nodes: np.ndarray, bounds: np.ndarray, before: np.ndarray, after: np.ndarray) -> pa.Table:
    """Links of what is connected now to its least node; groups that share nodes so say the same links. What was connected before has one."""
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))

    def least(parts: np.ndarray) -> np.ndarray:
        order = np.lexsort((nodes, parts, group))
        new = np.ones(len(order), bool)
        new[1:] = (parts[order][1:] != parts[order][:-1]) | (group[order][1:] != group[order][:-1])
        out = np.empty_like(nodes)
        out[order] = nodes[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
        return out

    own, whole = least(before), least(after)
    ends = np.unique(np.stack([whole, own], 1)[own != whole], axis=0)
    return pa.table({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})


def _alike(table: pa.Table) -> pa.Table:
    """Groups of signatures: links that connect the pairs that share MATCHES tokens."""
    table, bounds = _groups(table)
    nodes, before = table.column("node").to_numpy(), table.column("label").to_numpy()
    tokens = np.frombuffer(b"".join(table.column("_load").to_pylist()), np.uint8).reshape(-1, SIZE)
    first, parts = np.repeat(bounds[:-1], np.diff(bounds)), before.copy()
    near = (tokens == tokens[first]).sum(1) >= MATCHES
    parts[near] = parts[first[near]]  # all groups at once; most are settled by it
    several = np.add.reduceat(~near, bounds[:-1]) * (np.diff(bounds) > 2) > 0
    for lo, hi in zip(bounds[:-1][several].tolist(), bounds[1:][several].tolist(), strict=True):
        own = parts[lo:hi]
        if hi - lo <= 48:
            enough = (tokens[lo:hi, None] == tokens[None, lo:hi]).sum(2) >= MATCHES
            connect(own, 0, enough.__getitem__)
        else:
            elements = (tokens[lo:hi] + np.arange(SIZE) * 256).ravel()
            merge_lists(own, np.repeat(np.arange(hi - lo), SIZE), elements, lambda i, counts: counts >= MATCHES)
    return _stars(nodes, bounds, before, parts)


def _same(words: int, percent: int):
    def confirm(table: pa.Table) -> pa.Table:
        """Groups of texts: links that connect the pairs whose sets have the similarity sought."""
        table, bounds = _groups(table)
        nodes, before = table.column("node").to_numpy(), table.column("label").to_numpy()
        sets, parts = textvec.shingle_sets(*textvec.text_buffers(table.column("_load")), words), before.copy()
        sizes = np.array([len(s) for s in sets], np.int64)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own, size = parts[lo:hi], sizes[lo:hi]
            if hi - lo == 2:
                short, long = sorted(sets[lo:hi], key=len)
                if len(short) and 100 * len(short) >= percent * len(long):
                    both = int((long[np.minimum(np.searchsorted(long, short), len(long) - 1)] == short).sum())
                    if 100 * both >= percent * (len(short) + len(long) - both):
                        own[1] = own[0]
                continue
            _, elements, times = np.unique(np.concatenate(sets[lo:hi]), return_inverse=True, return_counts=True)
            shared = (times > 1)[elements]  # a shingle of one text counts in the sizes only
            number = np.cumsum(times > 1) - 1
            rows = np.repeat(np.arange(hi - lo), size)[shared]
            merge_lists(own, rows, number[elements[shared]], lambda i, both, size=size: 100 * both >= np.maximum(percent * (size[i] + size - both), 1))
        return _stars(nodes, bounds, before, parts)

    return confirm


def _forest(rows: DataFrame, loads: DataFrame, task: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Links (a, b) that connect all nodes which `task` links inside a group.

    `rows` has group, node and bytes (of the node's load), `loads` node and
    _load. Small groups share tasks. A large group is dealt in blocks, each of
    which also gets the same few pivots; then the largest part of the group so
    connected has nothing to find in itself, and only blocks of the other nodes
    meet the blocks of all.
    """
    sizes = cut(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")))
    total = sizes.agg(F.sum("n"), F.sum("bytes")).first()
    tasks = max(16, (total[0] or 0) // TASK_ROWS, (total[1] or 0) // TASK_BYTES)
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK_ROWS, size / BLOCK_BYTES)).cast("long")
    compare = lambda dealt: cut(dealt.join(loads, "node").groupBy("k").applyInArrow(task, "a long, b long"))
    large = cut(sizes.withColumn("blocks", blocks(F.col("n"), F.col("bytes"))).where("blocks > 1").select("group", "n", "blocks"))
    drop(sizes)
    small = F.pmod(F.xxhash64("group"), F.lit(tasks))
    if not large.limit(1).count():
        drop(large)
        return compare(rows.select("group", "node", F.col("node").alias("label"), small.alias("k")))
    dealt = skewed_join(rows.select("group", "node"), large, "group", "left")
    pivot = F.pmod(F.xxhash64("node", F.lit(1)), F.col("n")) < PIVOTS
    home = F.when(F.col("blocks").isNull(), F.array(F.lit(-1).cast("long"))).when(pivot, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = dealt.withColumn("home", F.explode(home.otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("blocks"))))))
    links = compare(dealt.select("group", "node", F.col("node").alias("label"), F.when(F.col("home") < 0, small).otherwise(F.xxhash64("group", "home")).alias("k")))

    known = component_labels(links).withColumnRenamed("id", "node")
    split = skewed_join(rows, large.select("group"), "group").join(known, "node", "left")
    split = cut(split.select("group", "node", "bytes", F.coalesce("label", "node").alias("label")))
    plan = split.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    plan = plan.groupBy("group").agg(F.max(F.struct("n", "label", "bytes")).alias("main"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where("n > main.n")
    others = blocks(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes"))
    plan = cut(plan.select("group", F.col("main.label").alias("main"), blocks(F.col("main.n"), F.col("main.bytes")).alias("mine"), others.alias("others")))
    in_main = F.col("label") == F.col("main")
    last = F.col("others") + F.when(in_main, 0).otherwise(F.col("mine")) - 1
    meet = skewed_join(split.select("group", "node", "label"), plan, "group")
    meet = meet.withColumn("home", F.when(in_main, F.col("others") + F.pmod(F.xxhash64("node"), F.col("mine"))).otherwise(F.pmod(F.xxhash64("node"), F.col("others"))))
    meet = meet.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last))).where("home <> other")
    more = compare(meet.select("group", "node", "label", F.xxhash64("group", F.least("home", "other"), F.greatest("home", "other")).alias("k")))
    drop(large, split, plan)
    return cut(links.union(more))


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    A text's set holds its distinct shingles of `words` words (runs of no white
    space, A-Z as a-z); of fewer words it is the whole sequence; null and empty
    texts, and those of white space, have an empty set and are linked with
    nothing. Two sets are linked when their similarity is `percent` / 100 or
    more; components follow links of any length, and the smallest id of each is
    kept. Repeated rows each give a row; rows of one id count as one document.
    Ids are whole numbers; a row without one takes part in no link, its component
    is null unless an equal text has an id, and it is not kept. Other columns are
    ignored; no rows give no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_load"))
    sc = docs.sparkSession.sparkContext
    signed = cut(rows.mapInArrow(_signatures(words), "_id long, _h long, n_shingles long, _digest binary, _sig binary"))
    full = signed.where("_digest is not null")
    # A node stands for all rows with one set: their smallest id, and one text of it.
    nodes = full.where("_id is not null").groupBy("_digest").agg(F.min(F.struct("_id", "_h", "_sig")).alias("r"))
    nodes = cut(nodes.select(F.monotonically_increasing_id().alias("node"), "_digest", "r._id", "r._h", "r._sig"))

    counts = np.zeros(1 << SLOT_BITS, np.int64)
    got = nodes.select("_sig").mapInArrow(_slot_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most 2**SLOT_BITS rows
    counts[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    threshold = int(4 * counts.mean() + 256)
    postings = cut(nodes.select("node", "_sig").mapInArrow(_postings(sc.broadcast(counts), threshold), "hot boolean, group long, node long"))
    cool = postings.where("not hot").select("group", "node").repartition("group").sortWithinPartitions("group").mapInArrow(_not_alone, "group long, node long")
    posted = cut(cool.union(postings.where("hot").select("group", "node")).withColumn("bytes", F.lit(SIZE).cast("long")))
    short = cut(nodes.select("node", "_sig").mapInArrow(_shorten, "node long, _load binary"))
    families = component_labels(_forest(posted, short, _alike)).select(F.col("label").alias("group"), F.col("id").alias("node"))
    drop(postings, posted, short)

    own = nodes.select("node", "_id", "_h").join(families, "node")
    texts = cut(rows.join(own, ["_id", "_h"]).dropDuplicates(["node"]).select("group", "node", "_load"))
    links = _forest(texts.select("group", "node", F.octet_length("_load").cast("long").alias("bytes")), texts.select("node", "_load"), _same(words, percent))
    # Nodes of one id are one document.
    lead = nodes.groupBy("_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    links = links.union(nodes.select("_id", F.col("node").alias("b")).join(lead.select("_id", "a"), "_id").where("a < b").select("a", "b"))
    labels = component_labels(links)
    drop(texts)
    placed = cut(nodes.select("node", "_digest", "_id").join(labels.withColumnRenamed("id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node")))
    known = cut(skewed_join(placed.select("_digest", "label"), placed.groupBy("label").agg(F.min("_id").alias("_component")), "label").select("_digest", "_component"))
    said = skewed_join(full.select("_id", "n_shingles", "_digest"), known, "_digest", "left").select("_id", "n_shingles", "_component")
    said = said.union(signed.where("_digest is null").select("_id", "n_shingles", F.col("_id").alias("_component")))
    return said.select(F.col("_id").alias(id_col), "n_shingles", F.col("_component").alias("component_id"), F.coalesce(F.col("_id") == F.col("_component"), F.lit(False)).alias("kept"))


def op1(spark, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END)) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
ids AS (SELECT s, row_number() OVER () AS k FROM (SELECT s FROM sets GROUP BY s HAVING count(*) > 1)),
coded AS (SELECT doc_id, k FROM sets JOIN ids USING (s)),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both FROM coded x JOIN coded y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY 1, 2) p
  JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
  WHERE 100 * p.both >= 80 * (m.n + n.n - p.both)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, s.b FROM reach r JOIN sides s ON r.b = s.a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes z USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) c USING (doc_id)
"""
