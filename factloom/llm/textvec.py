"""Vectorised work on Arrow string columns: bytes, words, 64-bit hashes.

Texts are handled as one run of UTF-8 bytes with offsets, in slices of bounded
size, so that no Python object is made for a word. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text in a slice; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 21

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}

#: White space of the contracts: U+0020 and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets (rows + 1, from 0)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most SLICE_BYTES of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_buffers(batch.column(column))[1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + SLICE_BYTES, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if size <= 4 * SLICE_BYTES:
            _powers[kind] = have
    return have[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] for the first i bytes, A-Z counted as a-z; a stretch [s, e) hashes to (h[e] - h[s]) / base**s."""
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", _BASE, len(data)), out=h[1:])
    return h


def stretch_hashes(prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    down = _power("down", _BASE_INVERSE, len(prefixes))
    return mix((prefixes[ends] - prefixes[starts]) * down[starts])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words (runs of bytes that are no white space) of each row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | first[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, np.flatnonzero(ends) + 1, rows


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash and row number of every word, A-Z counted as a-z."""
    starts, ends, rows = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), rows
    return stretch_hashes(prefix_hashes(data), starts, ends), rows


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + (right ^ (right >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = 2) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its shingles of so many words; with fewer words the whole sequence as one."""
    hashes, rows = word_hashes(data, offsets)
    n = len(offsets) - 1
    bounds = np.searchsorted(rows, np.arange(n + 1))
    grams = hashes
    for k in range(1, words):
        grams = pair_hash(grams[:-1], hashes[k:]) if len(grams) > 1 else grams[:0]
    out = []
    for i in range(n):
        lo, hi = bounds[i], bounds[i + 1]
        if hi - lo >= words:
            own = np.sort(grams[lo : hi - words + 1])
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif hi > lo:
            whole = hashes[lo]
            for k in range(lo + 1, hi):
                whole = pair_hash(whole[None], hashes[k : k + 1])[0] if np.ndim(whole) == 0 else whole
            out.append(mix(np.array([whole], np.uint64) + np.uint64(hi - lo)))
        else:
            out.append(hashes[:0])
    return out
