"""Hashed character n-grams and linear models fitted by follow-the-regularised-leader."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@lru_cache(1)
def letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, or a space for what is no letter."""
    table = np.full(0x10000, 32, np.uint32)
    for code in range(0x10000):
        low = chr(code).lower()[0]
        if low.isalpha():
            table[code] = ord(low)
    return table


def code_points(text: str, letters_only: bool) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    if letters_only:
        table = letter_table()
        codes = np.where(codes < 0x10000, table[np.minimum(codes, 0xFFFF)], codes)
        space = codes == 32
        keep = np.ones(len(codes), bool)
        keep[1:] = ~(space[1:] & space[:-1])
        codes = codes[keep]
    return codes.astype(np.uint64)


def hashed_ngrams(codes: np.ndarray, bits: int, longest: int) -> np.ndarray:
    """How often each slot of 2**bits is hit by the n-grams of 1 to `longest` code points."""
    counts = np.zeros(1 << bits, np.int64)
    total = np.zeros(len(codes), np.uint64)
    for n in range(1, longest + 1):
        if len(codes) < n:
            break
        total = total[: len(codes) - n + 1] * _SALTS[0] + codes[n - 1 :] + np.uint64(n)
        slots = ((total ^ (total >> np.uint64(31))) * _SALTS[1]) >> np.uint64(64 - bits)
        counts += np.bincount(slots.astype(np.int64), minlength=1 << bits)
    return counts


def tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots hit, and 1 + log(count) times idf, as a vector of length 1."""
    index = np.flatnonzero(counts)
    value = (1 + np.log(counts[index])) * idf[index]
    norm = np.sqrt(value @ value)
    return index, value / norm if norm else value


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(-1, keepdims=True))
    return scores / scores.sum(-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, size: int, alpha: float = 2.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, passes: int = 3) -> np.ndarray:
    """Weights (size + 1, classes) of a multinomial logistic regression; the last row is the bias.

    FTRL-proximal with elastic-net penalties: a weight is zero while its
    summed gradients stay within l1. Targets are class probabilities.
    """
    classes = targets.shape[1]
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def weights(index: np.ndarray) -> np.ndarray:
        own = z[index]
        w = -(own - np.sign(own) * l1) / ((beta + np.sqrt(n[index])) / alpha + l2)
        return np.where(np.abs(own) <= l1, 0.0, w)

    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(passes):
        for i in order.permutation(len(rows)):
            index, value = np.append(rows[i][0], size), np.append(rows[i][1], 1.0)
            w = weights(index)
            gradient = value[:, None] * (softmax(value @ w) - targets[i])[None, :]
            squares = n[index] + gradient * gradient
            z[index] += gradient - (np.sqrt(squares) - np.sqrt(n[index])) / alpha * w
            n[index] = squares
    return weights(np.arange(size + 1))


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature in 0.05..20 whose softmax gives the labels the least loss, by golden section on its logarithm.

    A label counts as wrong with the chance 1 / (rows + 2), so that rows without an error don't make the model certain.
    """
    if not len(labels) or scores.shape[1] < 2:
        return 1.0
    wrong = 1 / (len(labels) + 2)
    goal = np.full(scores.shape, wrong / (scores.shape[1] - 1))
    goal[np.arange(len(labels)), labels] = 1 - wrong

    def loss(log_t: float) -> float:
        return -(goal * np.log(np.maximum(softmax(scores / np.exp(log_t)), 1e-12))).sum(1).mean()

    lo, hi, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))
