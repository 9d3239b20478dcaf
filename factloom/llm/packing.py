"""Packing documents into sequences: Martello-Toth dominance, then best fit, on the histogram of lengths.

Lengths are whole numbers up to the capacity, so a plan needs only how many
pieces have each length: its size depends on the capacity, not on the corpus.
The plan is made on the driver from at most `capacity` counts; pieces find
their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.spread import cut

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
CAPACITY = 2048
END_ID = 0


class Plan:
    """bins: (first sequence, number of sequences, lengths in order) of alike sequences."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.bins: list[tuple[int, int, list[int]]] = []
        self.sequences = 0
        left = {n: c for n, c in counts.items() if c > 0}
        self.fixed = self._dominate(left)
        self._best_fit(left)

    def _add(self, number: int, lengths: list[int]) -> None:
        self.bins.append((self.sequences, number, lengths))
        self.sequences += number

    def _dominate(self, left: dict[int, int]) -> int:
        """Fix sets that dominate every other set with the same largest piece; left keeps the rest.

        With largest piece j and room r = capacity - j, and k the largest other
        piece that fits, {j, k} dominates if k fills r, or if no two other
        pieces fit into r together with a sum over k: whatever stood with j can
        take the place of k elsewhere. {j} alone dominates if nothing fits.
        """
        fixed = 0
        for j in sorted(left, reverse=True):
            while left.get(j):
                own = left[j]
                room = self.capacity - j
                others = dict(left)
                others[j] -= 1
                sizes = [n for n in sorted(others) if others[n] and n <= room]
                if not sizes:
                    number = own if j > room else 1
                    self._add(number, [j])
                    self._take(left, j, number)
                    fixed += number
                    continue
                k = sizes[-1]
                if k != room and not self._beats_pairs(sizes, others, room, k):
                    break
                number = own // 2 if j == k else min(own, left[k])
                if not number:
                    break
                self._add(number, [j, k])
                self._take(left, j, number)
                self._take(left, k, number)
                fixed += number
        return fixed

    @staticmethod
    def _take(left: dict[int, int], length: int, number: int) -> None:
        left[length] -= number
        if not left[length]:
            del left[length]

    @staticmethod
    def _beats_pairs(sizes: list[int], counts: dict[int, int], room: int, k: int) -> bool:
        """No two or more pieces (of sizes, each <= room) fit together with a sum over k."""
        smallest = []
        for n in sizes:
            smallest += [n] * min(counts[n], 3)
            if len(smallest) >= 3:
                break
        if len(smallest) >= 2 and smallest[0] + smallest[1] > room:
            return True
        if len(smallest) >= 3 and sum(smallest[:3]) <= room:
            return False
        lo, hi = 0, len(sizes) - 1  # the best pair that fits
        best = 0
        while lo <= hi:
            total = sizes[lo] + sizes[hi]
            if total > room or (lo == hi and counts[sizes[lo]] < 2):
                hi -= 1
            else:
                best = max(best, total)
                lo += 1
        return best <= k

    def _best_fit(self, left: dict[int, int]) -> None:
        """Longest first, each into the fullest sequence that has room; alike sequences are handled together."""
        groups: dict[int, list[tuple[int, list[int]]]] = {}
        for length in sorted(left, reverse=True):
            number = left[length]
            for room in sorted(r for r in groups if r >= length):
                stack, kept = groups.pop(room), []
                each = room // length
                while stack:
                    bins, lengths = stack.pop()
                    full = min(bins, number // each)
                    if full:
                        groups.setdefault(room - each * length, []).append((full, [*lengths, *[length] * each]))
                        number -= full * each
                        bins -= full
                    if bins and number:  # fewer pieces are left than one sequence takes
                        groups.setdefault(room - number * length, []).append((1, [*lengths, *[length] * number]))
                        bins, number = bins - 1, 0
                    if bins:
                        kept.append((bins, lengths))
                if kept:
                    groups.setdefault(room, []).extend(kept)
                if not number:
                    break
            if number:
                each = self.capacity // length
                if number // each:
                    groups.setdefault(self.capacity - each * length, []).append((number // each, [length] * each))
                if number % each:
                    groups.setdefault(self.capacity - (number % each) * length, []).append((1, [length] * (number % each)))
        for stack in groups.values():
            for bins, lengths in stack:
                self._add(bins, lengths)

    def places(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per length: first ranks, first sequences and offsets of the runs of pieces that one position of alike sequences takes."""
        runs: dict[int, list[tuple[int, int, int]]] = {}
        given: dict[int, int] = {}
        for first, number, lengths in self.bins:
            offset = 0
            for n in lengths:
                runs.setdefault(n, []).append((given.get(n, 0), first, offset))
                given[n] = given.get(n, 0) + number
                offset += n
        return {n: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for n, rows in runs.items()}


@lru_cache(2)
def _encoders(folder: str):
    """The tokenizer, and the same vocabulary as ranks, which gives the same ids several times as fast."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(f"{folder}/{RANKS}", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return Tokenizer.from_file(f"{folder}/{VOCABULARY}"), tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, folder: str) -> np.ndarray:
    """The ids of the tokenizer, then the end id. Texts with a special token's string, and any the rank encoder refuses, go to the tokenizer itself."""
    tokenizer, ranks = _encoders(folder)
    ids = None
    if "<|" not in text:
        try:
            ids = ranks.encode_to_numpy(text)
        except BaseException as refused:  # its native code panics on some very long runs
            if isinstance(refused, KeyboardInterrupt | SystemExit | MemoryError):
                raise
    if ids is None:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
    return np.append(ids, np.uint32(END_ID)).astype("<u4", copy=False)


def default_folder() -> str:
    import os

    import public_tokenizers

    return os.path.dirname(public_tokenizers.path(VOCABULARY))


def pieces(docs: DataFrame, folder: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as pieces of at most `capacity` ids, with their rank among the pieces of their length in this partition."""
    kind = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, place = TaskContext.get().partitionId(), {}, folder or default_folder()  # where this worker has the files
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            for i, text in enumerate(batch.column(1)):
                ids = token_ids(text.as_py() or "", place)
                start, number = 0, 0
                stop = (len(ids) - 1) % capacity + 1
                while start < len(ids):
                    length = stop - start
                    rank = seen[length] = seen.get(length, -1) + 1
                    for out, x in zip(rows, (i, number, start, length, zlib.crc32(ids[start:stop].tobytes()), part, rank), strict=True):
                        out.append(x)
                    start, stop, number = stop, stop + capacity, number + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), *(pa.array(x, pa.int64()) for x in rows[2:])],
                names=[id_col, "piece", "start", "length", "ids_crc32", "_part", "_rank"],
            )

    return docs.select(id_col, text_col).mapInArrow(encode, f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long, _part long, _rank long")


def pack(docs: DataFrame, folder: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and an end id. Only longer ones than `capacity`
    are cut; every piece but the first then has `capacity` ids. Null and empty
    texts are the end id alone. Repeated rows are packed each by themselves;
    null ids are kept; no rows give no rows; other columns are ignored.
    """
    made = cut(pieces(docs, folder, capacity, id_col, text_col))
    parts = cut(made.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    plan = Plan(counts, capacity)
    places = made.sparkSession.sparkContext.broadcast(plan.places())  # its size depends on the capacity alone
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(parts.select("_part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    # One row for each partition and length grows with the input, so it is not left to be broadcast.
    ranked = made.join(starts.hint("shuffle_merge"), ["_part", "length"]).select(id_col, "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_rank")).alias("_rank"))
    kind = docs.schema[id_col].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = places.value
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                firsts, sequences, offsets = runs[int(n)]
                at = np.searchsorted(firsts, rank[own], side="right") - 1
                sequence[own] = sequences[at] + rank[own] - firsts[at]
                offset[own] = offsets[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op8(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
