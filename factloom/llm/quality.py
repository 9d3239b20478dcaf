"""Quality classifier: heuristic labellers, their accuracies by expectation-maximisation, and a hashed linear scorer."""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm import linear

GOOD, BAD, ABSTAIN = 1, 0, 2
BITS = 16
LONGEST = 3
#: The scorer is fitted on about so many documents for each side of the posterior; the label model covers all documents.
PER_SIDE = 1500
_HASH_SPAN = 1 << 30

#: Frequent function words of four languages.
FUNCTION_WORDS = frozenset(
    "the of and to in is for that on with as are by at from be this it a an or was which le la les de des du un une et en est que qui pour dans sur par au aux avec ce pas plus der die das und ist nicht ein eine zu den dem mit von auf für sich des im auch el los las y es no por con para una se del al su lo como".split()
)
_SYMBOLS = "#$%&*<>{}[]~^|\\=_@+"
_PUNCTUATION = ".,;:!?\"'()"
_SIGN = re.compile(r"[^\w\s]")
_BARE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")

#: What the labellers look at, in the order of their votes. Each kind of junk that a crawl has (symbol noise, shouting,
#: torn tables and menus, repeated text, texts without grammar) is in sight of several of them, which do not measure
#: the same, so that their agreement carries the signal.
LABELLED = ("symbols", "letters", "word ends", "bare marks", "marks", "capitals", "lower case", "function words", "repeats", "commonest word", "compression", "word pairs")
LABELLERS = len(LABELLED)


def _vote(value: float, good: float, bad: float) -> int:
    """The vote on a value that is `good` on one side, `bad` on the other side, and unclear between."""
    if good < bad:
        return GOOD if value < good else BAD if value > bad else ABSTAIN
    return GOOD if value > good else BAD if value < bad else ABSTAIN


def _odd_end(word: str) -> bool:
    """Whether a word ends in two signs or more."""
    return len(word) > 1 and bool(_SIGN.match(word[-1])) and bool(_SIGN.match(word[-2]))


def labels(text: str) -> list[int]:
    """The votes of the labellers on a text; a short text says nothing of what needs many words."""
    words = text.split()
    n = len(words)
    if not n:
        return [BAD] * LABELLERS
    low = [w.strip(_PUNCTUATION) for w in text.lower().split()]
    some, many = n >= 4, n >= 12
    return [
        _vote(sum(map(text.count, _SYMBOLS)) / sum(map(len, words)), 0.01, 0.06),
        _vote(sum(map(str.isalpha, low)) / n, 0.9, 0.75) if some else ABSTAIN,
        _vote(sum(_odd_end(w) for w in words) / n, 0.02, 0.15),
        _vote(len(_BARE.findall(text)) / n, 0.01, 0.08),
        _vote((text.count("!") + text.count("?") + text.count("|")) / n, 0.02, 0.2),
        _vote(sum(map(str.isupper, words)) / n, 0.1, 0.3) if some else ABSTAIN,
        _vote(sum(map(str.islower, words)) / n, 0.7, 0.5) if some else ABSTAIN,
        _vote(sum(map(FUNCTION_WORDS.__contains__, low)) / n, 0.12, 0.04) if many else ABSTAIN,
        _vote(sum(map(operator.eq, low, low[1:])) / n, 0.02, 0.1) if many else ABSTAIN,
        _vote(max(Counter(low).values()) / n, 0.2, 0.3) if n >= 20 else ABSTAIN,
        _vote(len(zlib.compress(text.encode(), 1)) / len(text.encode()), 0.3, 0.2) if n >= 40 else ABSTAIN,
        _vote(len(set(zip(low, low[1:], strict=False))) / n, 0.7, 0.5) if many else ABSTAIN,
    ]


def pattern(votes: list[int]) -> int:
    code = 0
    for v in votes:
        code = code * 3 + v
    return code


def votes_of(code: int) -> list[int]:
    out = []
    for _ in range(LABELLERS):
        code, v = divmod(code, 3)
        out.append(v)
    return out[::-1]


@dataclass
class LabelModel:
    """P(good), and for each labeller P(vote | side) of its votes; to abstain says nothing of either side."""

    prior: float
    tables: np.ndarray  # labellers x 2 sides x 3 votes, 1 for ABSTAIN

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        said = np.log(self.tables)
        score = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for k in range(self.tables.shape[0]):
            score += said[k][:, votes[:, k]].T
        return linear.softmax(score)[:, 1]


def fit_labels(counts: dict[int, int], rounds: int = 500) -> LabelModel:
    """Expectation-maximisation on how many documents have each pattern of votes, at most 3**LABELLERS patterns.

    Starts from the share of good votes, which also tells which side is good.
    Every step estimates the share of good documents and of each labeller's
    votes on either side, with one vote of each kind added.
    """
    codes = sorted(counts)
    votes = np.array([votes_of(c) for c in codes], np.int64).reshape(-1, LABELLERS)
    number = np.array([counts[c] for c in codes], np.float64)
    tables = np.ones((LABELLERS, 2, 3))
    if not len(codes):
        return LabelModel(0.5, tables)
    good, bad = (votes == GOOD).sum(1), (votes == BAD).sum(1)
    p = (good + 1) / (good + bad + 2)
    for _ in range(rounds):
        weight = np.stack([number * (1 - p), number * p])
        sums = weight.sum(1) + 1
        for k in range(LABELLERS):
            for side in (BAD, GOOD):
                hits = np.bincount(votes[:, k], weight[side], minlength=3)[:2] + 1
                tables[k, side, :2] = hits / hits.sum()
        model = LabelModel(float(sums[1] / sums.sum()), tables.copy())
        new = model.posterior(votes)
        moved, p = np.abs(new - p).max(), new
        if moved < 1e-9:
            break
    return model


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [pattern(labels(x.as_py() or "")) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.int64())], names=["key", "code"])


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of the text as it is written, by their share, as a vector of length 1."""
    counts = linear.hashed_ngrams(linear.code_points(text, False), BITS, LONGEST)
    index = np.flatnonzero(counts)
    value = np.sqrt(counts[index])
    norm = np.sqrt(value @ value)
    return index, value / norm if norm else value


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for text in batch.column(1):
            index, value = features(text.as_py() or "")
            packed.append(index.astype("<u4").tobytes() + value.astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["code", "packed"])


@dataclass
class Scorer:
    labels: LabelModel
    weights: np.ndarray

    def score(self, text: str) -> float:
        index, value = features(text)
        return float(linear.softmax(value @ self.weights[index] + self.weights[-1])[1]) if len(index) else 0.0


def fit(docs: DataFrame, per_side: int = PER_SIDE, key: str = "doc_id", text_col: str = "text") -> Scorer:
    from factloom.llm.spread import cut, drop

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.xxhash64(F.col(key).cast("string"), text).alias("key"), text.alias("text"))
    voted = cut(rows.mapInArrow(_votes, "key long, code long"))
    counts = {r["code"]: r["n"] for r in voted.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 3**LABELLERS rows
    model = fit_labels(counts)
    codes = sorted(counts)
    posterior = dict(zip(codes, model.posterior(np.array([votes_of(c) for c in codes], np.int64).reshape(-1, LABELLERS)).tolist(), strict=True))
    sides = [sum(counts[c] for c in codes if (posterior[c] >= 0.5) == side) for side in (False, True)]
    limit = [int(min(1.0, per_side / max(1, n)) * _HASH_SPAN) for n in sides]
    limits = F.broadcast(docs.sparkSession.createDataFrame([(c, limit[posterior[c] >= 0.5]) for c in codes], "code long, most long"))
    chosen = voted.join(limits, "code").where(F.pmod(F.xxhash64("key"), F.lit(_HASH_SPAN)) < F.col("most")).select("key", "code")
    picked = F.broadcast(chosen.dropDuplicates(["key"]))  # about 2 * per_side rows by their choice
    sample = rows.join(picked, "key").dropDuplicates(["key"]).select("code", "text").mapInArrow(_sample, "code long, packed binary").collect()
    drop(voted)
    sample.sort(key=lambda r: (r["packed"], r["code"]))
    vectors = []
    for _, packed in sample:
        n = len(packed) // 8
        vectors.append((np.frombuffer(packed, "<u4", n).astype(np.int64), np.frombuffer(packed, "<f4", n, 4 * n).astype(np.float64)))
    soft = np.array([[1 - posterior[r["code"]], posterior[r["code"]]] for r in sample]).reshape(-1, 2)
    weights = linear.fit_ftrl(vectors, soft, 1 << BITS)
    # The sample has as many of either side; the bias is moved to how many there are.
    weights[-1] += np.log([(n + 1) / (min(n, per_side) + 1) for n in sides])
    return Scorer(model, weights.astype(np.float32))


def classify(docs: DataFrame, scorer: Scorer, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, votes (n for none, g good, b bad), posterior, score, kept.

    kept is whether the mean of the label model's posterior and the scorer's
    probability reaches the threshold. The whole text is read. Null text counts
    as empty: it scores 0 and is not kept. Repeated rows each give a row; other
    columns are ignored; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # 2**BITS weights
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column(1)]
            votes = np.array([labels(t) for t in texts], np.int64).reshape(-1, LABELLERS)
            posterior = scorer.labels.posterior(votes)
            scores = np.array([scorer.score(t) for t in texts])
            kept = ((posterior + scores) / 2 >= threshold) & (scores > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(["".join("bgn"[v] for v in row) for row in votes], pa.string()), pa.array(posterior), pa.array(scores, pa.float64()), pa.array(kept, pa.bool_())],
                names=[id_col, "votes", "posterior", "score", "kept"],
            )

    return docs.select(id_col, text_col).mapInArrow(score, f"{id_col} {kind}, votes string, posterior double, score double, kept boolean")


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify(docs, fit(docs))
