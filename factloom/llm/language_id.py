"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams, with a calibrated temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm import linear

UNKNOWN = "und"
BITS = 15
LONGEST = 3
#: Learned rows of each language: about so many, chosen by a hash of their id. The model is fitted on these; n-gram statistics cover all learnable rows.
PER_LANGUAGE = 1000
_HASH_SPAN = 1 << 30


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not any(map(str.isalpha, text)) or not self.languages:
            return UNKNOWN, 0.0
        index, value = linear.tfidf(linear.hashed_ngrams(linear.code_points(text, True), BITS, LONGEST), self.idf)
        p = linear.softmax((value @ self.weights[index] + self.weights[-1]) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(min(1.0, p[best]))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, rows = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            df += linear.hashed_ngrams(linear.code_points(text.as_py() or "", True), BITS, LONGEST) > 0
            rows += 1
    slots = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(slots, -1)), pa.array(np.append(df[slots], rows))], names=["slot", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for text in batch.column(1):
            counts = linear.hashed_ngrams(linear.code_points(text.as_py(), True), BITS, LONGEST)
            slots = np.flatnonzero(counts)
            packed.append(slots.astype("<u2").tobytes() + counts[slots].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["lang", "packed"])


def fit(docs: DataFrame, learnable: Column, per_language: int = PER_LANGUAGE, key: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows where `learnable` holds and text and lang are not null.

    Document frequencies count all of these rows. The weights are fitted on
    about `per_language` rows of each language, chosen by a hash of key and text,
    repeated rows once; a fifth of them is left out of that and sets the
    temperature.
    """
    rows = docs.where(learnable & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(key).cast("string"), F.col(text_col)).alias("key"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros(1 << BITS), np.zeros(((1 << BITS) + 1, 0)), 1.0)
    df = np.zeros(1 << BITS, np.int64)
    total = 0
    for slot, n in rows.select("text").mapInArrow(_frequencies, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        if slot < 0:
            total = n
        else:
            df[slot] = n
    idf = np.log((1 + total) / (1 + df)) + 1
    share = F.pmod("key", F.lit(_HASH_SPAN))
    limits = F.create_map(*[F.lit(x) for lang in languages for x in (lang, int(min(1.0, per_language / counts[lang]) * _HASH_SPAN))])
    chosen = rows.where(share < F.element_at(limits, F.col("lang"))).dropDuplicates(["lang", "key"]).select("lang", "text").mapInArrow(_features, "lang string, packed binary").collect()
    chosen.sort(key=lambda r: (r["packed"], r["lang"]))  # the order of tasks plays no part
    vectors, labels = [], []
    for lang, packed in chosen:
        n = len(packed) // 6
        slots, times = np.frombuffer(packed, "<u2", n).astype(np.int64), np.frombuffer(packed, "<u4", n, 2 * n)
        value = (1 + np.log(times)) * idf[slots]
        norm = np.sqrt(value @ value)
        vectors.append((slots, value / norm if norm else value))
        labels.append(languages.index(lang))
    labels = np.array(labels, np.int64)
    aside = np.arange(len(vectors)) % 5 == 4
    targets = np.eye(len(languages))[labels]
    weights = linear.fit_ftrl([v for v, a in zip(vectors, aside, strict=True) if not a], targets[~aside], 1 << BITS)
    scores = np.array([v @ weights[i] + weights[-1] for (i, v), a in zip(vectors, aside, strict=True) if a]).reshape(-1, len(languages))
    return Model(languages, idf, weights.astype(np.float32), linear.fit_temperature(scores, labels[aside]))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, the columns to carry, lang_pred, score.

    The whole text is read. Null text, and text without a letter, is `und` with
    score 0, as is everything if nothing could be learned. Repeated rows each
    give a row; ties go to the language that sorts first; other columns are
    ignored; no rows give no rows.
    """
    kept = [f for f in docs.schema if f.name in (id_col, *carry)]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS rows of weights, one column a language

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            said = [model.predict(x.as_py()) for x in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())],
                names=[*(f.name for f in kept), "lang_pred", "score"],
            )

    form = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.select(*(f.name for f in kept), F.col(text_col).alias("_text")).mapInArrow(predict, f"{form}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.4, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is known with a score of `least` or more; und never is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            said = [model.predict(x.as_py()) for x in batch.column(at)]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in said], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string")) % 4 == 2


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, ~held_out())
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
