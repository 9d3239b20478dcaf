"""Secret scan: Aho-Corasick keywords, anchored patterns near hits, embedded checksums."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: The base kinds, in the order of their spans.
BASE_KINDS = ("assign", "access", "hex")

_ci = lambda word: "".join(f"[{c.upper()}{c}]" if "a" <= c <= "z" else c for c in word)  # noqa: E731  ASCII letters only, unlike re.I
_ASSIGN = re.compile(
    "(?:" + "|".join(map(_ci, ("password", "passwd", "secret", "token"))) + "|" + _ci("api") + "_?" + _ci("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_VENDOR = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_RUN = re.compile(r"[A-Za-z0-9_-]+")
_JWT_REST = re.compile(r"\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
_JSON_KEY = re.compile(rb'\{"(?:[^"\\]|\\.)*(?:"\s*(?::|$)|$)')
#: The header of a JWT has this many characters at most.
LONGEST_HEAD = 4096
_KEY_BLOCK = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
_KEY_END = "-----END "

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: str) -> str:
    """The CRC-32 of a token's body in six base-62 digits, as vendors append it."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = _BASE62[digit] + digits
    return digits


class _Text:
    """A text with what earlier hits learned of it, so that no stretch is read again for each hit in it."""

    def __init__(self, text: str):
        self.text = text
        self.run = (0, None)  # end of the run of token characters read last, and the end of what makes it a JWT behind it
        self.close = 0  # the next end of a key block known, -1 if there is none

    def vendor(self, at: int) -> tuple[int, int] | None:
        found = _VENDOR.match(self.text, at)
        return (found.start(), found.end()) if found and checksum62(found[1]) == found[2] else None

    def jwt(self, at: int) -> tuple[int, int] | None:
        """Whatever starts in one run of token characters ends with it, so what follows the run is looked at once."""
        if at >= self.run[0]:
            end = _RUN.match(self.text, at).end()
            rest = _JWT_REST.match(self.text, end)
            self.run = (end, rest.end() if rest else None)
        end, stop = self.run
        if stop is None or not 11 <= end - at <= LONGEST_HEAD or not _JSON_KEY.match(base64.urlsafe_b64decode(self.text[at : at + min(64, (end - at) // 4 * 4)])):
            return None
        try:
            head = json.loads(base64.urlsafe_b64decode(self.text[at:end] + "=" * (-(end - at) % 4)))
        except (ValueError, RecursionError):  # a header nested too deep to read is no header
            return None
        return (at, stop) if isinstance(head, dict) and "alg" in head else None

    def private_key(self, at: int) -> tuple[int, int] | None:
        found = _KEY_BLOCK.match(self.text, at)
        if not found:
            return None
        if 0 <= self.close < found.end():
            self.close = self.text.find(_KEY_END, found.end())
        if self.close < 0:
            return found.span()
        tail = self.text.find("-----", self.close + len(_KEY_END))
        return (at, tail + 5 if tail >= 0 else len(self.text))


#: keyword (lower case for the base kind assign, as it stands for others) -> (kind, matcher)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_EXACT_WORDS = {"AKIA": "access", "eyJ": "jwt", "-----BEGIN ": "private_key", **{f"gh{x}_": "vendor_token" for x in "pousr"}, "npm_": "vendor_token"}
_ADDED = {"vendor_token": _Text.vendor, "jwt": _Text.jwt, "private_key": _Text.private_key}
KINDS = (*BASE_KINDS, *_ADDED)


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in _ASSIGN_WORDS:
        found.add_word(word, ("assign", len(word)))
    for word, kind in _EXACT_WORDS.items():
        # The text is searched in lower case; the anchored pattern then sees the case.
        found.add_word(word.lower(), (kind, len(word)))
    found.make_automaton()
    return found


def ascii_lower(text: str) -> str:
    """A-Z alone in lower case, so that positions stay those of the text."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def find_secrets(text: str, automaton=None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span, by start, then kind; code points, end exclusive.

    The automaton finds keywords in one pass; a pattern is tried only at a
    keyword. A run of hex digits has no keyword, so its rule is a pattern alone.
    """
    spans: list[tuple[int, int, str]] = []
    past, known = dict.fromkeys(KINDS, 0), _Text(text)
    hits = [(end + 1 - length, kind) for end, (kind, length) in (automaton or _automaton()).iter(ascii_lower(text))]
    for at, kind in sorted(hits):
        if at < past[kind]:
            continue
        if kind == "assign":
            if found := _ASSIGN.match(text, at):
                past[kind] = found.end()
                if len(found[1]) >= 8:
                    spans.append((*found.span(), kind))
        elif kind == "access":
            if found := _ACCESS.match(text, at):
                past[kind] = found.end()
                if found.end() - at >= 16:
                    spans.append((*found.span(), kind))
        elif found := _ADDED[kind](known, at):
            past[kind] = found[1]
            spans.append((*found, kind))
    spans += [(*found.span(), "hex") for found in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPAN = "array<struct<start:long,end:long,kind:string>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and `secrets`, an array of (start, end, kind) over the whole text.

    Null and empty texts give an empty array; repeated rows each give a row;
    null ids are kept; other columns are ignored; no rows give no rows. A text
    is searched in one pass, its memory a small multiple of its length.
    """
    kind = docs.schema[id_col].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        form = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in batches:
            found = []
            for text in batch.column(1):
                text = text.as_py() or ""
                found.append([{"start": s, "end": e, "kind": k} for s, e, k in find_secrets(text, automaton)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, form)], names=[id_col, "secrets"])

    return docs.select(id_col, text_col).mapInArrow(scan, f"{id_col} {kind.simpleString()}, secrets {SPAN}")


def op4(spark, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    show = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(show(F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))), 256).alias("base_sha256"),
        show(F.col("secrets")).alias("spans"),
    )


def digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans if k in BASE_KINDS).encode()).hexdigest()
