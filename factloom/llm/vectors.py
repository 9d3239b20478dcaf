"""Vectors as whole numbers: which take part, and how a column of lists becomes one numpy matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256
#: Whole numbers up to this size are exact as doubles, so their sums may be left to floating-point matrix routines.
EXACT = 2.0**53


def complete(vector: Column) -> Column:
    """The vector is there and each of its components is a finite number; an empty vector is complete."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))))


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * component), the component as double; a long has no negative zero. Beyond the range of a long its ends stand."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists of longs as one matrix; shorter ones end in zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def largest(x: np.ndarray) -> int:
    """The largest absolute entry, as a Python number: the least long has no positive counterpart."""
    return max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
