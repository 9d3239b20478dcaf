"""Benchmark decontamination: q-gram lemma over diagonal bands, then banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.spread import cut

Q = 8
#: A passage of an item is WINDOW bytes, a shorter item one passage; passages overlap by half.
WINDOW = 160
#: Edits allowed in a passage, as a share of its length.
ERROR_RATE = 0.08
#: Shorter items than this are searched literally, as whole words.
LEAST = 40
#: Any stretch of an item of this many bytes (about 13 words) is searched, wherever it starts.
STRETCH = 80

#: Entries of the index that a text's stretches are searched with at once; one stretch may have more.
MOST_ENTRIES = 1 << 22

_GAPS = re.compile(r"[\W_]+")
#: The same for texts of Latin-1: each byte itself, or a space.
_LATIN = bytes(32 if _GAPS.match(chr(c)) else c for c in range(256))
_Q_BITS = 21


def normalise(text: str) -> str:
    """Lower case; each run of what is no letter or digit is one space."""
    low = text.lower()
    try:
        return b" ".join(low.encode("latin-1").translate(_LATIN).split()).decode("latin-1")
    except UnicodeEncodeError:
        return _GAPS.sub(" ", low).strip()


def _grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from each position as one number; Q is 8, the bytes of a uint64."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    out = np.empty(len(data) - Q + 1, "<u8")
    raw = data.tobytes()
    for k in range(Q):
        out[k::Q] = np.frombuffer(raw, "<u8", (len(data) - k) // Q, k)
    return out


def _slot(grams: np.ndarray, bits: int) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Passage:
    item: int
    start: int
    data: np.ndarray
    edits: int
    needed: int


class Index:
    """Passages of all items, their q-grams sorted, and a bitmap of the q-grams; whole items likewise, for stretches; short items by text."""

    def __init__(self, items: list[tuple[int, str]], window: int, error_rate: float):
        self.passages: list[Passage] = []
        self.items: list[tuple[int, np.ndarray]] = []
        self.short: dict[bytes, list[int]] = {}
        for item, text in items:
            data = np.frombuffer(normalise(text or "").encode(), np.uint8)
            if len(data) < LEAST:
                if len(data):
                    self.short.setdefault(data.tobytes(), []).append(item)
                continue
            if len(data) > STRETCH:  # one of STRETCH bytes is a passage itself
                self.items.append((item, data))
            starts = [0] if len(data) <= window else [*range(0, len(data) - window, window // 2), len(data) - window]
            for start in starts:
                part = data[start : start + window]
                edits = int(error_rate * len(part))
                # q-gram lemma: a match with so few edits shares at least this many q-grams
                self.passages.append(Passage(item, start, part, edits, max(1, len(part) - Q + 1 - Q * edits)))
        grams = [_grams(p.data) for p in self.passages]
        self.grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        self.owner = np.concatenate([np.full(len(g), i) for i, g in enumerate(grams)]) if grams else np.zeros(0, np.int64)
        self.place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(self.grams, kind="stable")
        self.grams, self.owner, self.place = self.grams[order], self.owner[order], self.place[order]
        whole = [_grams(data) for _, data in self.items]
        self.item_grams = np.concatenate(whole) if whole else np.zeros(0, np.uint64)
        self.item_owner = np.concatenate([np.full(len(g), i) for i, g in enumerate(whole)]) if whole else np.zeros(0, np.int64)
        self.item_place = np.concatenate([np.arange(len(g)) for g in whole]) if whole else np.zeros(0, np.int64)
        order = np.argsort(self.item_grams, kind="stable")
        self.item_grams, self.item_owner, self.item_place = self.item_grams[order], self.item_owner[order], self.item_place[order]
        # each q-gram once, with where its entries of passages and of items begin and how many they are
        self.keys = np.unique(self.grams)
        self.ranges = [(np.searchsorted(g, self.keys), np.searchsorted(g, self.keys, side="right") - np.searchsorted(g, self.keys)) for g in (self.grams, self.item_grams)]
        self.stretch_edits = int(error_rate * STRETCH)
        self.stretch_needed = max(1, STRETCH - Q + 1 - Q * self.stretch_edits)
        self.bits = max(_Q_BITS, (8 * len(self.keys)).bit_length())
        self.bitmap = np.zeros(1 << self.bits, bool)
        self.bitmap[_slot(self.grams, self.bits)] = True
        self.needed = np.array([p.needed for p in self.passages], np.int64)
        self.span = max((len(p.data) + p.edits for p in self.passages), default=0)
        # Passages of like length: the longest stretch that one can cover, and the fewest q-grams shared.
        classes: dict[int, tuple[int, int]] = {}
        for p in self.passages:
            span, needed = classes.get(len(p.data) // 8, (0, 1 << 30))
            classes[len(p.data) // 8] = (max(span, len(p.data) + p.edits), min(needed, p.needed))
        if self.items:
            classes[-1] = (STRETCH + self.stretch_edits, self.stretch_needed)
            self.span = max(self.span, STRETCH + self.stretch_edits)
        # What another, as long and with as few, marks as well need not be asked.
        told = set(classes.values())
        self.classes = sorted(c for c in told if not any(o != c and o[0] >= c[0] and o[1] <= c[1] for o in told))

    def dense(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Stretches that can hold a match (firsts, ends): those where as many q-grams of the index stand together as some passage needs; and the q-grams in them (places, grams)."""
        none = np.zeros(0, np.int64)
        grams = _grams(data)
        at = np.flatnonzero(self._outside_runs(grams, self.bitmap[_slot(grams, self.bits)])) if len(grams) else none
        marks = np.zeros(len(at), bool)
        for span, needed in self.classes:  # the last of so many, from each on, stands within the span
            if len(at) >= needed:
                marks[: len(at) - needed + 1] |= at[needed - 1 :] - at[: len(at) - needed + 1] < span
        dense = at[marks]
        if not len(dense):
            return none, none, none, grams[:0]
        breaks = np.flatnonzero(np.diff(dense) > self.span) + 1
        firsts, lasts = dense[np.append(0, breaks)], dense[np.append(breaks - 1, len(dense) - 1)]
        ends = np.minimum(lasts + self.span + Q, len(data))
        which = np.searchsorted(firsts, at, side="right") - 1
        at = at[(which >= 0) & (at + Q <= ends[which])]
        return firsts, ends, at, grams[at]

    def matches(self, data: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(item, passage start, start, end, edits) of the best match of each passage found in a normalised text, then of stretches elsewhere and of short items."""
        best: dict[int, tuple[int, int, int]] = {}
        raw = data.tobytes()
        firsts, ends, at, grams = self.dense(data)
        if len(at):
            key = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
            same = self.keys[key] == grams
            at, key = at[same], key[same]
            which = np.searchsorted(firsts, at, side="right") - 1
        for k, entry, where in self.crowded(at, key, which, 0, self.owner, self.needed) if len(at) else ():
            lo, hi = int(firsts[k]), int(ends[k])
            where = where - lo
            for p in np.unique(self.owner[entry]).tolist():  # a literal occurrence needs no alignment
                begin = raw.find(self.passages[p].data.tobytes(), lo, hi)
                if begin >= 0:
                    best[p] = (0, begin, begin + len(self.passages[p].data))
            owner, diagonal = self.owner[entry], where - self.place[entry] + self.span
            # bands of 2 * width diagonals, each overlapping the next by width: any width + 1 neighbours share one
            width = max(p.edits for p in self.passages) + 1
            for shift in (0, width):
                band = (diagonal + shift) // (2 * width)
                found, which_band = np.unique(owner.astype(np.int64) << 40 | band, return_inverse=True)
                # one place of a passage counts once in a band
                seen = np.unique(which_band.astype(np.int64) << 32 | self.place[entry])
                counts = np.bincount(seen >> 32, minlength=len(found))
                for pair, n in zip(found.tolist(), counts.tolist(), strict=True):
                    p, b = pair >> 40, pair & ((1 << 40) - 1)
                    passage = self.passages[p]
                    if n < passage.needed or best.get(p, (1 << 30,))[0] == 0:
                        continue
                    first = lo + b * 2 * width - shift - self.span
                    hit = align(passage.data, data, first, 2 * width, passage.edits)
                    if hit and hit[0] < best.get(p, (1 << 30,))[0]:
                        best[p] = hit
        out = [(self.passages[w].item, self.passages[w].start, s, e, d) for w, (d, s, e) in sorted(best.items())]
        if self.items and len(at):
            needed = np.full(len(self.items), self.stretch_needed, np.int64)
            for k, entry, where in self.crowded(at, key, which, 1, self.item_owner, needed):
                self.stretches(data, raw, int(firsts[k]), where - firsts[k], entry, out)
        return out + self.short_items(raw) if self.short else out

    def crowded(self, at: np.ndarray, key: np.ndarray, which: np.ndarray, table: int, owner: np.ndarray, needed: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each stretch the entries, with their places in the text, of the passages (0) or items (1) that have as many there as they need."""
        count = self.ranges[table][1][key]
        if count.sum() > MOST_ENTRIES and which[0] < which[-1]:  # some stretches after the others
            half = int(np.searchsorted(which, (which[0] + which[-1] + 1) // 2))
            for part in (slice(half), slice(half, None)):
                yield from self.crowded(at[part], key[part], which[part], table, owner, needed)
            return
        where, entry = self.entries(at, key, table)
        first, stretches, n = int(which[0]), int(which[-1] - which[0]) + 1, len(needed)
        pair = np.repeat(which - first, count) * n + owner[entry]
        if stretches * n <= 1 << 20:
            keep = (np.bincount(pair, minlength=stretches * n) >= np.tile(needed, stretches))[pair]
        else:
            pairs, back, counts = np.unique(pair, return_inverse=True, return_counts=True)
            keep = (counts >= needed[pairs % n])[back]
        if not keep.any():
            return
        pair, entry, where = first + pair[keep] // n, entry[keep], where[keep]
        starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(pair)], strict=True):
            yield int(pair[a]), entry[a:b], where[a:b]

    def _outside_runs(self, grams: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Hits without those deep inside a run of one character.

        What lies within the run altogether stands at its start as well, and a
        match that holds more than the run's character reaches one of its ends,
        so places further than the longest match from both ends say nothing new.
        """
        some = grams[:: self.span + Q]  # a run so long holds two of these that follow each other
        if not (some[1:] == some[:-1]).any():
            return hits
        ends = np.flatnonzero(np.append(grams[1:] != grams[:-1], True))
        starts = np.append(0, ends[:-1] + 1)
        for a, b in zip(*(x[ends - starts > 2 * (self.span + Q)].tolist() for x in (starts, ends)), strict=True):
            hits[a + self.span + Q : b - self.span - Q] = False
        return hits

    def entries(self, at: np.ndarray, key: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """The entries of passages (0) or items (1) for q-grams found, with their places."""
        left, count = (x[key] for x in self.ranges[table])
        where = np.repeat(at, count)
        return where, np.arange(len(where)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(left, count)

    def stretches(self, data: np.ndarray, raw: bytes, lo: int, where: np.ndarray, entry: np.ndarray, out: list[tuple[int, int, int, int, int]]) -> None:
        """Adds the stretches of items that do not overlap a match of the same item; entries of items stand at places counted from lo."""
        owner, place = self.item_owner[entry].astype(np.int64), self.item_place[entry]
        offset = len(max((d for _, d in self.items), key=len))
        diagonal, width, last = where - place + offset, self.stretch_edits + 1, self.stretch_needed - 1
        for shift in (0, width):
            bands, band = np.unique(owner << 40 | (diagonal + shift) // (2 * width), return_inverse=True)
            seen = np.unique(band.astype(np.int64) << 32 | place)
            # so many places of one band within a stretch
            dense = np.flatnonzero(seen[last:] - seen[: len(seen) - last] <= STRETCH - Q) if len(seen) > last else []
            if not len(dense):
                continue
            for b in np.unique(seen[dense] >> 32).tolist():
                item, text = self.items[int(bands[b]) >> 40]
                places = seen[np.searchsorted(seen, b << 32) : np.searchsorted(seen, b + 1 << 32)] & 0xFFFFFFFF
                starts = np.arange(max(0, int(places[0]) - STRETCH), min(int(places[-1]), len(text) - STRETCH) + 1)
                starts = starts[np.searchsorted(places, starts + STRETCH - Q, side="right") - np.searchsorted(places, starts) >= self.stretch_needed]
                first = lo + (int(bands[b]) & ((1 << 40) - 1)) * 2 * width - shift - offset
                clear = np.ones(len(starts), bool)
                for other, _, s, e, _ in out:
                    if other == item:
                        clear &= (starts + first + 2 * width + STRETCH <= s) | (starts + first >= e)
                starts = starts[clear]
                while len(starts):
                    hit = self.literal(text, raw, starts, first, 2 * width) or align_stretch(text, data, starts, first, 2 * width, self.stretch_edits)
                    if not hit:
                        break
                    out.append((item, *hit))
                    starts = starts[(starts + first + 2 * width + STRETCH <= hit[1]) | (starts + first >= hit[2])]

    @staticmethod
    def literal(text: np.ndarray, raw: bytes, starts: np.ndarray, first: int, width: int) -> tuple[int, int, int, int] | None:
        """(item start, start, end, 0) of a stretch that occurs literally, as long as it stays equal."""
        own = text.tobytes()
        for s in starts.tolist():
            at = raw.find(own[s : s + STRETCH], max(0, s + first), max(0, s + first + width + STRETCH))
            if at >= 0:
                end = STRETCH
                while s > 0 and at > 0 and own[s - 1] == raw[at - 1]:
                    s, at, end = s - 1, at - 1, end + 1
                while s + end < len(own) and at + end < len(raw) and own[s + end] == raw[at + end]:
                    end += 1
                return s, at, at + end, 0
        return None

    def short_items(self, raw: bytes) -> list[tuple[int, int, int, int, int]]:
        """Items under LEAST bytes that stand in the text as whole words."""
        space = np.frombuffer(b" " + raw + b" ", np.uint8) == 32
        at, out = np.flatnonzero(space), {}
        for n in {len(x) for x in self.short}:
            ends = at + n + 1
            for p in at[(ends < len(space)) & space[np.minimum(ends, len(space) - 1)]].tolist():
                if raw[p : p + n] in self.short:
                    out.setdefault(raw[p : p + n], p)
        return [(item, 0, p, p + len(x), 0) for x, p in sorted(out.items()) for item in self.short[x]]


def align_stretch(text: np.ndarray, data: np.ndarray, starts: np.ndarray, first: int, width: int, edits: int) -> tuple[int, int, int, int] | None:
    """(item start, start, end, edits) of the best of the stretches text[s : s + STRETCH], s in starts, aligned as in align() on diagonals first..first+width."""
    n, far = width + 2 * edits + 1, 1 << 20
    at = starts[:, None] + first - edits + np.arange(n)
    row = np.where((at >= np.maximum(0, starts + first)[:, None]) & (at <= np.minimum(starts + first + width, len(data))[:, None]), 0, far)
    origin, steps = at.copy(), np.arange(n)
    none = np.full((len(starts), 1), far)
    for i in range(STRETCH):
        col = at + i
        inside = (col >= 0) & (col < len(data))
        same = inside & (data[np.clip(col, 0, len(data) - 1)] == text[starts + i][:, None])
        diagonal = np.where(inside, row + ~same, far)
        down = np.hstack([row[:, 1:], none]) + 1
        take = down < diagonal
        new, new_origin = np.where(take, down, diagonal), np.where(take, np.hstack([origin[:, 1:], none]), origin)
        shifted = new - steps
        low = np.minimum.accumulate(shifted, axis=1)
        source = np.maximum.accumulate(np.where(shifted == low, steps, 0), axis=1)
        row, origin = low + steps, np.take_along_axis(new_origin, source, axis=1)
        if row.min() > edits:
            return None
    which, end = np.unravel_index(int(row.argmin()), row.shape)
    return int(starts[which]), int(origin[which, end]), int(min(at[which, end] + STRETCH, len(data))), int(row[which, end])


def align(pattern: np.ndarray, data: np.ndarray, first: int, width: int, edits: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best alignment of the whole pattern that starts on diagonals first..first+width and keeps within `edits` of them."""
    lo = first - edits
    n = width + 2 * edits + 1
    at = lo + np.arange(n)
    far = 1 << 20
    start_ok = (at >= max(0, first)) & (at <= min(first + width, len(data)))
    row = np.where(start_ok, 0, far)
    origin = at.copy()
    steps = np.arange(n)
    for i, symbol in enumerate(pattern.tolist()):
        col = at + i
        inside = (col >= 0) & (col < len(data))
        same = np.zeros(n, bool)
        same[inside] = data[col[inside]] == symbol
        diagonal = np.where(inside, row + ~same, far)
        down = np.append(row[1:], far) + 1  # the pattern's symbol has no counterpart
        down_origin = np.append(origin[1:], 0)
        take = down < diagonal
        new, new_origin = np.where(take, down, diagonal), np.where(take, down_origin, origin)
        # symbols of the text without counterpart: the least of new[j] + (k - j) over j <= k
        shifted = new - steps
        low = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == low, steps, 0))
        row, origin = low + steps, new_origin[source]
        if row.min() > edits:
            return None
    end = int(row.argmin())
    if row[end] > edits:
        return None
    return int(row[end]), int(origin[end]), int(min(at[end] + len(pattern), len(data)))


MATCH = "array<struct<item_id:long,passage_start:int,start:int,end:int,edits:int>>"


def find_benchmark(docs: DataFrame, items: list[tuple[int, str]], window: int = WINDOW, error_rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and `matches` with passages of the benchmark items.

    A document matches when a whole passage (a whole item, if short) or any
    STRETCH bytes of an item align with a stretch of it within the edit budget,
    both normalised; items under LEAST bytes match literally, as whole words.
    Stretches are listed where no match of their item stands. Positions count
    bytes of the normalised text. Whole texts are searched in one pass; every
    stretch that the q-gram lemma leaves possible is aligned, so no match within
    the budget is lost. Null and empty texts and null items match nothing;
    repeated rows and items each count; no rows give no rows; other columns are
    ignored. `items` is held by every task: benchmarks are of bounded size,
    which from_table() checks.
    """
    index = Index(items, window, error_rate)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    kind = docs.schema[id_col].dataType.simpleString()
    form = pa.list_(pa.struct([("item_id", pa.int64()), ("passage_start", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))
    names = [f.name for f in form.value_type]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            found = [[] for _ in range(batch.num_rows)]
            for i, text in enumerate(batch.column(1)):
                data = np.frombuffer(normalise(text.as_py() or "").encode(), np.uint8)
                found[i] = [dict(zip(names, m, strict=True)) for m in index.matches(data)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, form)], names=[id_col, "matches"])

    return docs.select(id_col, text_col).mapInArrow(search, f"{id_col} {kind}, matches {MATCH}")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, error_rate: float = ERROR_RATE, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that hold no passage of the benchmark; null and empty texts stay."""
    blocks = from_table(benchmark)
    docs, more = _without(docs, next(blocks), window, error_rate, text_col), next(blocks, None)
    while more is not None:  # one block's index at a time
        docs, more = _without(cut(docs), more, window, error_rate, text_col), next(blocks, None)
    return docs


def _without(docs: DataFrame, items: list[tuple[int, str]], window: int, error_rate: float, text_col: str) -> DataFrame:
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(Index(items, window, error_rate))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            clean = [not index.matches(np.frombuffer(normalise(x.as_py() or "").encode(), np.uint8)) for x in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


#: Items beyond this many bytes of text are searched in blocks of so many.
BLOCK_BYTES = 4 << 20


def from_table(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most BLOCK_BYTES of text, read one block at a time."""
    block, size, any_ = [], 0, False
    for row in items.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1].encode())
        if size >= BLOCK_BYTES:
            yield block
            block, size, any_ = [], 0, True
    if block or not any_:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document, item and best passage found: doc_id, item_id, start, end, edits, kept (false)."""
    blocks = from_table(benchmark)
    found, more = find_benchmark(docs, next(blocks)).where(F.size("matches") > 0), next(blocks, None)
    while more is not None:  # one block's index at a time
        found = cut(found)
        found, more = found.unionByName(cut(find_benchmark(docs, more).where(F.size("matches") > 0))), next(blocks, None)
    best = F.inline(F.array_distinct(F.transform("matches", lambda m: F.struct(m["item_id"].alias("item_id"), m["passage_start"].alias("passage_start"), m["start"].alias("start"), m["end"].alias("end"), m["edits"].alias("edits")))))
    return found.select("doc_id", best).withColumn("kept", F.lit(False))


def op7(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
