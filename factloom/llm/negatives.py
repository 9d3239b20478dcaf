"""Hard negatives of embeddings: blocks of rows times panels of anchors over chunks of the dimensions, partial tiles of scores added by a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm import vectors
from factloom.llm.spread import cut, drop, scratch

#: Rows of a block, dimensions of a chunk and anchors of a panel: a tile has at most BLOCK * PANEL scores, a panel goes to all tasks.
BLOCK = 4096
CHUNK = 32
PANEL = 128
_LEAST = np.iinfo(np.int64).min

_SHARD = "block long, chunk int, part int, low long, high long, most long, ids binary, labels binary, anchors binary, before long, own long, x binary"
_ANCHOR = "number long, chunk int, id long, label long, x binary"
_TILE = "block long, chunk int, ids binary, labels binary, tile binary"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def packed(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, byte planes one after another: high planes are all alike and compress to nothing."""
    low = int(x.min(initial=0))
    off = (x.astype(np.int64) - np.int64(low)).view(np.uint64)
    width = max(1, (int(off.max(initial=0)).bit_length() + 7) // 8)
    rows, columns = x.shape
    head = np.array([rows, columns, low, width], np.int64).tobytes()
    return head + np.ascontiguousarray(off.astype("<u8").reshape(-1, 1).view(np.uint8)[:, :width].T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    rows, columns, low, width = (int(v) for v in np.frombuffer(data, np.int64, 4))
    planes = np.zeros((rows * columns, 8), np.uint8)
    planes[:, :width] = np.frombuffer(data, np.uint8, offset=32).reshape(width, rows * columns).T
    return (planes.view("<u8").ravel().view(np.int64) + np.int64(low)).reshape(rows, columns)


def product(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products: as doubles where no sum can leave their whole numbers, as longs otherwise."""
    if vectors.largest(rows) * vectors.largest(anchors) * rows.shape[1] < vectors.EXACT:
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    return rows.astype(np.int64) @ anchors.astype(np.int64).T


def shards(rows: DataFrame, block: int, chunk: int) -> DataFrame:
    """Blocks of rows in the order of label and id, each cut into chunks of dimensions.

    The range is by label and id, so a label that holds a third of the rows is
    many blocks. Repeated rows (equal id, label and vector) meet there and
    count once. A block knows how many anchors come before its own in its part.
    """
    dealt = rows.repartitionByRange("_label", "_id").sortWithinPartitions("_label", "_id", "_x")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, held, last = TaskContext.get().partitionId(), 0, 0, [], None

        def made(rows: pa.Table) -> pa.RecordBatch:
            ids, labels, anchor = (rows.column(i).to_numpy() for i in (0, 1, 3))
            x = vectors.matrix(rows.column(2).combine_chunks())
            starts = range(0, max(x.shape[1], 1), chunk)
            k = len(starts)
            numbers = ((part << 32) + number, part, labels.min(), labels.max(), min(vectors.largest(x), 2**63 - 1), before, anchor.sum())
            at, of, low, high, most, first, own = (pa.array([int(v)] * k, pa.int64()) for v in numbers)
            row_ids, row_labels, marks = (pa.array([v] * k, pa.binary()) for v in (ids.tobytes(), labels.tobytes(), np.packbits(anchor).tobytes()))
            x_parts = pa.array([packed(x[:, s : s + chunk]) for s in starts], pa.binary())
            columns = [at, pa.array(range(k), pa.int32()), of.cast(pa.int32()), low, high, most, row_ids, row_labels, marks, first, own, x_parts]
            return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _SHARD.split(", ")])

        for batch in batches:
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            fresh = np.ones(batch.num_rows, bool)
            for i in np.flatnonzero((ids[1:] == ids[:-1]) & (labels[1:] == labels[:-1])) + 1:
                fresh[i] = not batch.column(2)[i].equals(batch.column(2)[i - 1])
            if last and last == (ids[0], labels[0], batch.column(2)[0]):
                fresh[0] = False
            last = (ids[-1], labels[-1], batch.column(2)[-1])
            held.append(batch.filter(pa.array(fresh)))
            while sum(b.num_rows for b in held) >= block:
                rows = pa.Table.from_batches(held)
                out = made(rows.slice(0, block))
                yield out
                number, before, held = number + 1, before + out.column(10)[0].as_py(), rows.slice(block).to_batches()
        if sum(b.num_rows for b in held):
            yield made(pa.Table.from_batches(held))

    return dealt.mapInArrow(build, _SHARD)


def anchors_of(shards: DataFrame, starts: dict[int, int]) -> DataFrame:
    """A row for each anchor and chunk; anchors are numbered in the order of parts, blocks and rows. `starts`: anchors before each part."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
                at = np.flatnonzero(np.unpackbits(np.frombuffer(row["anchors"], np.uint8))[: len(ids)])
                x = unpacked(row["x"])[at]
                numbers = starts[row["part"]] + row["before"] + np.arange(len(at))
                columns = [pa.array(numbers), pa.array([row["chunk"]] * len(at), pa.int32()), pa.array(ids[at]), pa.array(labels[at]), pa.array([packed(x[i : i + 1]) for i in range(len(at))], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _ANCHOR.split(", ")])

    return shards.where("own > 0").select("chunk", "part", "ids", "labels", "anchors", "before", "x").mapInArrow(pick, _ANCHOR)


class Panel:
    """At most PANEL anchors: their numbers, ids and labels, and a matrix for each chunk; then the windows of their positives."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: (r.chunk, r.number))
        first = [r for r in rows if r.chunk == 0]
        self.numbers, self.ids, self.labels = (np.array([r[f] for r in first], np.int64) for f in ("number", "id", "label"))
        parts: dict[int, dict[int, np.ndarray]] = {}
        for r in rows:
            parts.setdefault(r.chunk, {})[int(np.searchsorted(self.numbers, r.number))] = unpacked(bytes(r.x))[0]
        self.chunks: dict[int, np.ndarray] = {}
        for k, own in parts.items():
            whole = self.chunks[k] = np.zeros((len(first), max(len(v) for v in own.values())), np.int64)
            for i, v in own.items():
                whole[i, : len(v)] = v
        self.windows: list[tuple[int, int, int, int]] = []  # place of the anchor, rank of its positive, least and greatest score


def partial_tiles(shards: DataFrame, panel: Panel) -> DataFrame:
    """For each block and chunk the products of its rows and the panel's anchors over the chunk's dimensions."""
    sent = shards.sparkSession.sparkContext.broadcast(panel)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                block, chunk, ids, labels, x = (batch.column(c)[i].as_py() for c in range(5))
                x = unpacked(x)
                a = p.chunks.get(chunk, np.zeros((len(p.ids), 0), np.int64))
                width = min(x.shape[1], a.shape[1])
                tile = packed(product(x[:, :width], a[:, :width]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([chunk], pa.int32()), *(pa.array([c if chunk == 0 else None], pa.binary()) for c in (ids, labels)), pa.array([tile], pa.binary())],
                    names=["block", "chunk", "ids", "labels", "tile"],
                )

    return shards.select("block", "chunk", "ids", "labels", "x").mapInArrow(multiply, _TILE)


def _summed(tiles: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and scores of one block: its partial tiles added up."""
    total = None
    for tile in tiles.column("tile"):
        own = unpacked(tile.as_py())
        total = own if total is None else total + own
    ids, labels = (next(np.frombuffer(v.as_py(), np.int64) for v in tiles.column(c) if v.is_valid) for c in ("ids", "labels"))
    return ids, labels, total


def _first(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` entries of each key: highest scores, then smallest ids."""
    order = np.lexsort((ids, -scores, keys))
    ordered = keys[order]
    rank = np.arange(len(ordered)) - np.searchsorted(ordered, ordered, side="left")
    return order[rank < most]


def best_positives(tiles: DataFrame, panel: Panel, most: int) -> DataFrame:
    """(anchor, other, score): each anchor's first rows of its label in each block, then over blocks."""
    sent = tiles.sparkSession.sparkContext.broadcast(panel)

    def reduce(group: pa.Table) -> pa.Table:
        p = sent.value
        ids, labels, scores = _summed(group)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for label in np.unique(p.labels):
            lo, hi = np.searchsorted(labels, label, side="left"), np.searchsorted(labels, label, side="right")
            columns = np.flatnonzero(p.labels == label)
            part, own = scores[lo:hi, columns], ids[lo:hi]
            other = own[:, None] != p.ids[columns]
            if len(part) > most:
                bound = np.partition(np.where(other, part, _LEAST), len(part) - most, axis=0)[len(part) - most]
                other &= part >= bound
            row, column = np.nonzero(other)
            keep = _first(columns[column], part[row, column], own[row], most)
            found.append((p.numbers[columns[column[keep]]], own[row[keep]], part[row[keep], column[keep]]))
        return pa.table({name: np.concatenate([f[i] for f in found]).astype(np.int64) for i, name in enumerate(("anchor", "other", "score"))})

    local = tiles.groupBy("block").applyInArrow(reduce, "anchor long, other long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "other"))
    return local.withColumn("rank", rank).where(F.col("rank") <= most)


def best_negatives(tiles: DataFrame, panel: Panel, most: int) -> DataFrame:
    """(anchor, q, other, score): the first rows of other labels in each window of a positive, in each block, then over blocks."""
    sent = tiles.sparkSession.sparkContext.broadcast(panel)

    def reduce(group: pa.Table) -> pa.Table:
        p = sent.value
        ids, labels, scores = _summed(group)
        a, q, low, high = (np.array([w[i] for w in p.windows], np.int64) for i in range(4))
        least, greatest = np.full(len(p.ids), np.iinfo(np.int64).max), np.full(len(p.ids), _LEAST)
        np.minimum.at(least, a, low)
        np.maximum.at(greatest, a, high)
        row, column = np.nonzero((scores >= least) & (scores <= greatest) & (labels[:, None] != p.labels))
        value = scores[row, column]
        order = np.lexsort((ids[row], -value, column))
        row, column, value = row[order], column[order], value[order]
        ends = np.searchsorted(column, np.arange(len(p.ids) + 1))
        found = []
        for w in range(len(a)):
            own = value[ends[a[w]] : ends[a[w] + 1]]
            start = int(np.searchsorted(-own, -high[w], side="left"))
            own = own[start : start + most]
            own = own[own >= low[w]]
            found.append((np.full(len(own), p.numbers[a[w]]), np.full(len(own), q[w]), ids[row[ends[a[w]] + start :][: len(own)]], own))
        columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4)]
        return pa.table({"anchor": columns[0], "q": columns[1].astype(np.int32), "other": columns[2], "score": columns[3]})

    local = tiles.groupBy("block").applyInArrow(reduce, "anchor long, q int, other long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "q").orderBy(F.desc("score"), "other"))
    return local.withColumn("rank", rank).where(F.col("rank") <= most)


def mine(shards: DataFrame, panel: Panel, positives: int, negatives: int, low: int, high: int) -> DataFrame | None:
    """The result's rows for the anchors of a panel; None where none has a positive."""
    near = shards.where((F.col("low") <= int(panel.labels.max())) & (F.col("high") >= int(panel.labels.min())))
    own = best_positives(partial_tiles(near, panel), panel, positives).collect()  # at most `positives` rows for each anchor of the panel
    if not own:
        return None
    place = {int(number): i for i, number in enumerate(panel.numbers)}
    panel.windows = [(place[r.anchor], r["rank"], -(-low * r.score // 100), high * r.score // 100) for r in own]
    said = [(r.anchor, r["rank"], int(panel.ids[place[r.anchor]]), r.other, r.score) for r in own]
    named = shards.sparkSession.createDataFrame(said, "anchor long, q int, anchor_id long, positive_id long, positive_score long")
    found = best_negatives(partial_tiles(shards, panel), panel, negatives).join(F.broadcast(named), ["anchor", "q"])
    return found.select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label_col: str | Column = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = vectors.SCALE,
    block: int = BLOCK,
    chunk: int = CHUNK,
    panel: int = PANEL,
) -> DataFrame:
    """For each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchor` says which rows are anchors. An anchor's positives are its first
    rows of equal label and other id; a positive's negatives are the first rows
    of other labels with low * positive <= 100 * score <= high * positive. First
    are higher scores, then smaller ids. Scores are exact inner products of
    floor(scale * component).

    Rows are dealt by (label, id) into blocks, blocks into chunks of dimensions.
    Anchors are taken a panel at a time, which alone is broadcast: panel * d
    numbers. A task multiplies the chunk of a block with that of the panel; the
    partial tiles of a block meet by a shuffle, are added, and hand on at most
    `positives` or `negatives` rows for each anchor or window. First come the
    blocks that have labels of the panel, for the positives, then all blocks.
    What is held at once is tiles of one panel; what is shuffled in all is rows
    times anchors times chunks, about two bytes each.

    Rows with a null id or label, or a vector that is null or has a null, NaN or
    infinite component, take no part. Repeated rows (equal id, label and vector)
    count once; rows that share an id otherwise count each, and are not each
    other's positives. Shorter vectors count as ended by zeros. Anchors without
    positives, and positives without negatives, give no rows. Ids and labels are
    whole numbers. Components so large that a score might not fit into a long
    are an error. No rows give no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    vector = F.col(f"`{vector_col}`")
    label = F.col(f"`{label_col}`") if isinstance(label_col, str) else label_col
    own = rows.where(vectors.complete(vector)).select(F.col(f"`{id_col}`").cast("long").alias("_id"), label.cast("long").alias("_label"), vectors.whole(vector, scale).alias("_x"), F.coalesce(anchor, F.lit(False)).alias("_anchor"))
    made = cut(shards(own.where("_id is not null and _label is not null"), block, chunk))
    # One row for each part of the range, of which there are as many as shuffle partitions.
    parts = made.groupBy("part").agg(F.sum(F.when(F.col("chunk") == 0, F.col("own"))).alias("own"), F.max("most").alias("most"), F.max("chunk").alias("chunk")).orderBy("part").collect()
    starts, total = {}, 0
    for r in parts:
        starts[r.part], total = total, total + r.own
    most, width = max((r.most for r in parts), default=0), chunk * (max((r.chunk for r in parts), default=0) + 1)
    if most * most * width >= 2**63:
        raise ValueError("a score of these vectors might not fit into a long; lower `scale`")
    anchors = cut(anchors_of(made, starts))
    folder = scratch(spark)
    spark.createDataFrame([], _RESULT).write.parquet(folder)
    for first in range(0, total, panel):
        found = mine(made, Panel(anchors.where((F.col("number") >= first) & (F.col("number") < first + panel)).collect()), positives, negatives, low, high)
        if found is not None:
            found.write.mode("append").parquet(folder)
    drop(made, anchors)
    return spark.read.schema(_RESULT).parquet(folder)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, label_col=label)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_sum(list_transform(generate_series(1, least(len(a.x), len(b.x))), lambda i: a.x[i] * b.x[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.other AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
