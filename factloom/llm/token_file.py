"""Token ids in binary files: blocks of whole documents, ids as frequency ranks in one to four bytes, lengths in control bytes of their own.

A file is a sequence of blocks, each followed by MARK, so that Spark's text
reader hands them out one by one and may split a file. A block:

    8 bytes   magic
    6 longs   part, number of the block in its part, ids of the part before it, documents, ids, distinct ids
    2 longs   bytes of control, bytes of data
    1 long    CRC-32 of all that follows
    1 long    mask: a byte with which all that follows is combined by exclusive or (0, but where MARK would stand in it)
    documents x (long id, long number of ids, byte: 1 where the id is null)
    distinct x 4 bytes   ids by falling frequency in the block: the rank is the place
    control   2 bits for each id, lowest first: bytes of its rank less one
    data      the ranks, lowest byte first, without leading zeros

All numbers are little-endian. A block needs no other file to be read. Files are
written by Spark's text writer, which commits whole tasks and reaches any store.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from struct import Struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.packing import END_ID, VOCABULARY, default_folder
from factloom.llm.spread import scratch

MAGIC = b"FLTOKEN1"
MARK = "\n== end of block 5d1c0e7a9b3f4286 ==\n"
HEAD = len(MAGIC) + 10 * 8
#: Ids after which a block is closed; a longer document is a block by itself.
BLOCK_IDS = 1 << 20
#: Bytes of text that a file is made of, about.
FILE_TEXT = 32 << 20
#: Words whose ids a worker remembers.
WORDS = 400_000
#: Files up to which their places in the corpus are broadcast (32 bytes each); beyond it they are joined by a shuffle.
BROADCAST_FILES = 500_000

_LENGTHS = np.array([[(c >> (2 * i) & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)

#: The letter that stands for each byte in the vocabulary: itself if it is one that can be seen, else the next of those beyond Latin-1.
_SEEN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_LETTERS = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _SEEN)}


def coded(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of whole numbers below 2^32."""
    short = (1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = short - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    at = np.cumsum(short, dtype=np.int64) - short
    data = np.empty(int(short.sum(dtype=np.int64)), np.uint8)
    data[at] = ranks & 0xFF
    longer = np.flatnonzero(short > 1)
    for k in range(1, 4):
        data[at[longer] + k] = ranks[longer] >> np.uint32(8 * k) & 0xFF
        longer = longer[short[longer] > k + 1]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decoded(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The `n` numbers back: the lowest byte of each, then the others of those that have more."""
    sizes = _LENGTHS[control].ravel()[:n]
    at = np.cumsum(sizes, dtype=np.int64) - sizes
    out = data[at].astype(np.uint32)
    longer = np.flatnonzero(sizes > 1)
    for k in range(1, 4):
        out[longer] |= data[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
        longer = longer[sizes[longer] > k + 1]
    return out


def block_bytes(part: int, number: int, before: int, keys: list, lengths: list[int], ids: np.ndarray) -> bytes:
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    distinct = np.flatnonzero(counts)
    distinct = distinct[np.lexsort((distinct, -counts[distinct]))]
    rank = np.zeros(len(counts), np.uint32)
    rank[distinct] = np.arange(len(distinct), dtype=np.uint32)
    control, data = coded(rank[ids] if len(ids) else np.zeros(0, np.uint32))
    table = np.array([0 if k is None else k for k in keys], "<i8").tobytes() + np.array(lengths, "<i8").tobytes() + bytes(k is None for k in keys)
    body = table + distinct.astype("<u4").tobytes() + control + data
    for mask in range(256):
        made = _masked(body, mask)
        block = MAGIC + np.array([part, number, before, len(keys), len(ids), len(distinct), len(control), len(data), zlib.crc32(made), mask], "<i8").tobytes() + made
        if MARK.encode() not in block:
            return block
    raise ValueError("no mask keeps the mark out of a block")


def _masked(body: bytes, mask: int) -> bytes:
    return (np.frombuffer(body, np.uint8) ^ np.uint8(mask)).tobytes() if mask else body


def head_of(block: bytes) -> list[int]:
    if block[: len(MAGIC)] != MAGIC or len(block) < HEAD:
        raise ValueError("no block of token ids")
    head = [int(v) for v in np.frombuffer(block, "<i8", 10, len(MAGIC))]
    if len(block) != HEAD + 17 * head[3] + 4 * head[5] + head[6] + head[7]:
        raise ValueError("a block has lost its end")
    return head


def block_rows(block: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, its place in the part, ids) of the documents of a block."""
    _, _, before, docs, n, distinct, controls, size, crc, mask = head_of(block)
    body = block[HEAD:]
    if zlib.crc32(body) != crc:
        raise ValueError("a block's bytes have changed since they were written")
    body = _masked(body, mask)
    keys, lengths = np.frombuffer(body, "<i8", docs), np.frombuffer(body, "<i8", docs, 8 * docs)
    null = np.frombuffer(body, np.uint8, docs, 16 * docs)
    of_rank = np.frombuffer(body, "<u4", distinct, 17 * docs)
    control = np.frombuffer(body, np.uint8, controls, 17 * docs + 4 * distinct)
    ids = of_rank[decoded(control, np.frombuffer(body, np.uint8, size, 17 * docs + 4 * distinct + controls), n)] if n else np.zeros(0, np.uint32)
    ends = np.cumsum(lengths)
    for i in range(docs):
        first = int(ends[i] - lengths[i])
        yield None if null[i] else int(keys[i]), before + first, ids[first : int(ends[i])]


class _Words(dict):
    """Ids of words, asked of the library's model at the first sight of each. Words of the last generation are moved, not asked for again."""

    def __init__(self, model):
        super().__init__()
        self.tokenize, self.before = model.tokenize, {}

    def __missing__(self, word: str) -> bytes:
        own = self.before.get(word)
        if own is None:  # the model takes a word's bytes as letters
            letters = word.replace(" ", _SPACE) if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_LETTERS)
            found = self.tokenize(letters)
            own = _one(found[0].id) if len(found) == 1 else array("I", [t.id for t in found]).tobytes()
        self[word] = own
        return own

    def age(self) -> None:
        if len(self) > WORDS // 2:
            self.before = dict(self)
            self.clear()


_SPACE = chr(_LETTERS[0x20])
_one = Struct("<I").pack


def _class(pattern: str) -> str:
    """The characters that texts split here may have and that the pattern takes, as ranges: a set of characters is searched faster than one of categories."""
    takes = [c for c in (*range(0x80), *range(0xA0, 0x250)) if re.fullmatch(pattern, chr(c))]
    firsts = [c for c in takes if c - 1 not in takes]
    lasts = [c for c in takes if c + 1 not in takes]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts, lasts, strict=True))


class Encoder:
    """Ids by the tokenizers library. Words come apart by the vocabulary's own pattern, and the library is asked once for each word.

    That is the same as asking it for whole texts, as no id spans words: but it
    takes special tokens out of a text first, and knows another set of letters
    than Python beyond Latin, so texts with either go to it whole.
    """

    _word = re.compile(rf" ?[{_class(r'[^\W\d_]')}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[{_class(r'[^\s\w]|_')}]+|\s+(?!\S)|\s+")
    _other = re.compile(r"[^\t-\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")
    _controls = "\x1c\x1d\x1e\x1f"

    def __init__(self, folder: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(f"{folder}/{VOCABULARY}")
        self.known = _Words(self.tokenizer.model)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _split(self, text: str) -> bool:
        """Whether a text may be split here."""
        if text.isascii():
            return not any(c in text for c in self._controls) and "<|" not in text
        return "<|" not in text and not self._other.search(text)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, then the end id."""
        end, words, ids = _one(END_ID), self._word.findall, self.known.__getitem__
        self.known.age()
        parts = (b"".join(map(ids, words(t))) if self._split(t) else self._whole(t) for t in texts)
        return [np.frombuffer(p + end, "<u4") for p in parts]


@lru_cache(1)
def _encoder(folder: str) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    return Encoder(folder)


def _slices(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, list[str]]]:
    """Rows of a column of texts, a few MB at a time."""
    size = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) if len(column) else np.zeros(0)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(size, (size[start - 1] if start else 0) + most, side="right")))
        yield start, column.slice(start, stop - start).to_pylist()
        start = stop


def write_ids(docs: DataFrame, path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", file_text: int = FILE_TEXT, block_ids: int = BLOCK_IDS) -> None:
    """Write every document's ids, the end id after each, to files below `path`, in ascending order of the documents' ids.

    Texts are dealt by ranges of (id, hash of the text), so rows that share an
    id are spread like others, and their order is the same in every run; null
    ids come first. A task encodes its rows in order and closes a block once it
    holds `block_ids` ids. Null texts are the end id alone. Ids are whole numbers.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text.alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    dealt = rows.withColumn("_hash", F.xxhash64("_text")).repartitionByRange(max(1, -(-size // file_text)), "_id", "_hash").sortWithinPartitions("_id", "_hash", "_text").select("_id", "_text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(folder or default_folder()), TaskContext.get().partitionId()
        number, before, held = 0, 0, 0
        keys: list = []
        ids: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            made = block_bytes(part, number, before, keys, [len(i) for i in ids], np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["block"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            for start, texts in _slices(batch.column(1)):
                for i, own in enumerate(encoder.ids(texts), start):
                    keys.append(names[i])
                    ids.append(own)
                    held += len(own)
                    if held >= block_ids:
                        yield block()
                        number, before, held, keys, ids = number + 1, before + held, 0, [], []
        if keys:
            yield block()

    # The text writer puts out a string's bytes as they are, whether or not they are UTF-8.
    dealt.mapInArrow(write, "block binary").select(F.col("block").cast("string")).write.option("compression", "none").option("lineSep", MARK).text(path)


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MARK).text(path).select(F.col("value").cast("binary").alias("block"))


def index(spark: SparkSession, path: str) -> DataFrame:
    """For each part: start (ids of all parts before it), docs, ids; from the heads of its blocks. A row a file, so a running sum is cheap."""
    files = _blocks(spark, path).select(_head_long(0).alias("part"), _head_long(3).alias("docs"), _head_long(4).alias("ids")).groupBy("part").agg(F.sum("docs").alias("docs"), F.sum("ids").alias("ids"))
    return files.withColumn("start", F.sum("ids").over(Window.orderBy("part")) - F.col("ids"))


def _head_long(k: int) -> Column:
    """Number k of a block's head: its eight bytes, the last first, in hexadecimal digits."""
    digits = F.hex(F.substring("block", len(MAGIC) + 8 * k + 1, 8))
    turned = F.concat(*[F.substring(digits, 15 - 2 * i, 2) for i in range(8)])
    return F.conv(turned, 16, 10).cast("long")


def read_ids(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """The documents of the files below `path`: id, start (ids of all documents before it), n_tokens, ids (little-endian, four bytes each)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                block = value.as_py()
                part, rows = head_of(block)[0], list(block_rows(block))
                columns = [pa.array([part] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([len(r[2]) for r in rows], pa.int64()), pa.array([r[2].tobytes() for r in rows], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["_part", "_id", "_at", "n_tokens", "ids"])

    files = index(spark, path).select(F.col("part").alias("_part"), "start").persist()
    starts = F.broadcast(files) if files.count() <= BROADCAST_FILES else files
    rows = _blocks(spark, path).mapInArrow(read, "_part long, _id long, _at long, n_tokens long, ids binary")
    return rows.join(starts, "_part").select(F.col("_id").alias(id_col), (F.col("start") + F.col("_at")).alias("start"), "n_tokens", "ids")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of what the files hold.

    Null and empty texts are the end id alone; null ids come first; rows that
    share an id come in the order of a hash of their texts, equal ones alike;
    no rows give no rows; other columns are ignored.
    """
    path = scratch(spark)
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
