"""Whitening of embeddings: moments of partitions by Chan's merge, eigenvectors of their covariance, a second pass as proof."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm import vectors
from factloom.llm.spread import cut

COMPONENTS = 4
#: An eigenvalue below this share of the largest, for each dimension, is rounding and not variance.
NOTHING = 4 * np.finfo(np.float64).eps


@dataclass
class Moments:
    """Count, mean and centred scatter of rows, and their exact sums where the rows are whole numbers (none otherwise)."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray
    sums: list[int]

    @staticmethod
    def none() -> Moments:
        return Moments(0, np.zeros(0), np.zeros((0, 0)), [])

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        n, width = x.shape
        if not n:
            return Moments.none()
        sums: list[int] = []
        if x.dtype == np.int64:
            small = vectors.largest(x) * n < 2**62
            sums = [int(s) for s in (x.sum(0) if small else x.astype(object).sum(0))]
            mean = np.array([s / n for s in sums])
        else:
            mean = x.mean(0)
        centred = x - mean
        return Moments(n, mean, centred.T @ centred, sums)

    def wider(self, width: int) -> Moments:
        more = width - len(self.mean)
        return self if more <= 0 else Moments(self.n, np.pad(self.mean, (0, more)), np.pad(self.scatter, (0, more)), [*self.sums, *[0] * more] if self.sums or not width - more else [])

    def merged(self, other: Moments) -> Moments:
        """Chan's formula: the scatters add, and so does that of the two means about their common one."""
        if not self.n or not other.n:
            return self if self.n else other
        width = max(len(self.mean), len(other.mean))
        a, b = self.wider(width), other.wider(width)
        n = a.n + b.n
        scatter = lambda apart: a.scatter + b.scatter + np.outer(apart, apart) * (a.n / n * b.n)
        if not a.sums:
            apart = b.mean - a.mean
            return Moments(n, a.mean + apart * (b.n / n), scatter(apart), [])
        sums = [x + y for x, y in zip(a.sums, b.sums, strict=True)]  # exact, so means far from zero lose nothing in their difference
        apart = np.array([(y * a.n - x * b.n) / (a.n * b.n) for x, y in zip(a.sums, b.sums, strict=True)])
        return Moments(n, np.array([s / n for s in sums]), scatter(apart), sums)


def moments(frame: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray] = lambda batch: vectors.matrix(batch.column(0))) -> Moments:
    """Moments of all rows: each partition merges those of its batches, the tree those of partitions. A state has d * d numbers, however many rows."""

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Moments.none()
        for batch in batches:
            own = own.merged(Moments.of(of(batch)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(own)], pa.binary())], names=["state"])

    states = frame.mapInArrow(partition, "state binary").rdd.map(lambda r: pickle.loads(bytes(r.state)))
    return states.treeReduce(lambda a, b: a.merged(b)) if states.getNumPartitions() else Moments.none()


@dataclass
class Model:
    n: int
    sums: list[int]
    mean: np.ndarray
    axes: np.ndarray  # a component a row
    values: np.ndarray  # its eigenvalue, 0 where there is no variance
    explained: list[float | None]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections over the standard deviation; those of components without variance stay 0."""
        x = np.pad(x, ((0, 0), (0, len(self.mean) - x.shape[1])))
        with np.errstate(divide="ignore"):
            over = np.where(self.values > 0, 1 / np.sqrt(self.values), 0.0)
        return (x - self.mean) @ self.axes.T * over

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S)^2, exactly; null beyond 38 digits."""
        x = np.pad(x, ((0, 0), (0, len(self.sums) - x.shape[1])))
        far = self.n * vectors.largest(x) + max((abs(s) for s in self.sums), default=0)
        if far * far * max(1, len(self.sums)) < 2**63:
            off = x * np.int64(self.n) - np.array(self.sums, np.int64)
            return pa.array((off * off).sum(1)).cast(pa.decimal128(38, 0))
        off = x.astype(object) * self.n - np.array(self.sums, object)
        return pa.array([Decimal(int(v)) if v < 10**38 else None for v in (off * off).sum(1)], pa.decimal128(38, 0))


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Model:
    """Mean and leading eigenvectors of the covariance (divisor n) of the rows of `distinct`, whose one column is the vector."""
    found = moments(distinct)
    width = len(found.mean)
    if not width:
        return Model(found.n, [], found.mean, np.zeros((0, 0)), np.zeros(0), [])
    covariance = found.scatter / found.n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components].T
    axes = axes * np.where(axes[np.arange(len(axes)), np.abs(axes).argmax(1)] < 0, -1.0, 1.0)[:, None]  # one sign for all rows, the same in every run
    trace = float(np.trace(covariance))
    real = np.where(values > max(values[0], 0) * width * NOTHING, values, 0.0)
    return Model(found.n, found.sums, np.array([s / found.n for s in found.sums]), axes, real, [float(v) / trace if trace > 0 else None for v in real])


def identity_error(distinct: DataFrame, model: Model) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over components that have variance."""
    own = model.values > 0
    if not own.any():
        return None
    found = moments(distinct, lambda batch: model.whitened(vectors.matrix(batch.column(0)))[:, own])
    return float(np.abs(found.scatter / found.n - np.eye(int(own.sum()))).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = vectors.SCALE) -> DataFrame:
    """For each row and component: id, component, n, deviation (decimal), whitened, explained, identity_error.

    Vectors become whole numbers, floor(scale * c). The model is fitted on each
    distinct one once; copies are combined before the shuffle, so a vector that
    a third of the rows have is one row from each task. Tasks hand on count,
    mean and scatter, which depend on the dimension and not on the rows. The
    distinct vectors are read again to prove that their whitened covariance is
    the identity. Rows are then read from the source, without a shuffle.

    Rows whose vector is null or has a null, NaN or infinite entry are left out.
    Shorter vectors count as ended by zeros (and as other vectors than those
    that write these zeros). With fewer dimensions than components there are
    fewer components; one without variance has whitened 0 and explained 0 (null
    if no component has any, as identity_error is). A deviation over 38 digits
    is null. Null and repeated ids are kept, a row each; no rows give no rows;
    other columns are ignored.
    """
    vector = F.col(f"`{vector_col}`")
    own = rows.where(vectors.complete(vector)).select(F.col(f"`{id_col}`").alias("_id"), vectors.whole(vector, scale).alias("_x"))
    distinct = cut(own.select("_x").distinct())
    model = fit(distinct, components)
    error = identity_error(distinct, model)
    sent = rows.sparkSession.sparkContext.broadcast(model)  # (components + 2) * dimension numbers

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        k = len(m.values)
        for batch in batches:
            x = vectors.matrix(batch.column(1))
            n = len(x)
            at = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, m.n, np.int64)),
                    m.deviations(x).take(at),
                    pa.array(m.whitened(x).ravel() if k else np.zeros(0)),
                    pa.array(m.explained * n, pa.float64()),
                    pa.array([error] * (n * k), pa.float64()),
                ],
                names=["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.schema[id_col].dataType.simpleString()
    out = own.mapInArrow(place, f"_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    return out.withColumnRenamed("_id", id_col)


def op13(spark, sf_dir: str) -> DataFrame:
    """The contract's columns; a deviation beyond the range of a long is null here and stands in full in whiten()'s rows."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
