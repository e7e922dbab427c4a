"""Matching-block similarity of two texts.

Missing and equal texts are answered by built-in expressions. Other pairs run in Arrow
batches on the executors, each distinct pair of a batch once; no shuffle is needed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from codecorpus.functions.text import strip

# In a target of that length, characters that make up more than 1 % start no block.
LONG_TARGET = 200
COMMON_SHARE = 100
#: Pairs of short texts that are compared at once.
PAIRS_AT_ONCE = 1024


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def longest_block(a: np.ndarray, b: np.ndarray, rare: np.ndarray) -> tuple[int, int, int]:
    """Start in ``a``, start in ``b`` and size of the longest common block; the first in ``a``, then in ``b``."""
    best = (0, 0, 0)
    run = np.zeros(len(b) + 1, np.int32)
    for i in range(len(a)):
        run[1:] = np.where((b == a[i]) & rare, run[:-1] + 1, 0)
        size = int(run.max())
        if size > best[2]:
            best = (i - size + 1, int(run.argmax()) - size, size)
    i, j, size = best
    while i and j and a[i - 1] == b[j - 1]:
        i, j, size = i - 1, j - 1, size + 1
    while i + size < len(a) and j + size < len(b) and a[i + size] == b[j + size]:
        size += 1
    return i, j, size


def matching_length(left: str, right: str) -> int:
    """Characters in common blocks: the longest one, then those on either side of it, and so on."""
    a, b = _codes(left), _codes(right)
    rare = np.ones(len(b), bool)
    if len(b) >= LONG_TARGET:
        values, where, counts = np.unique(b, return_inverse=True, return_counts=True)
        rare = counts[where] <= len(b) // COMMON_SHARE + 1
    total, waiting = 0, [(0, len(a), 0, len(b))]
    while waiting:
        a0, a1, b0, b1 = waiting.pop()
        if a0 == a1 or b0 == b1:
            continue
        i, j, size = longest_block(a[a0:a1], b[b0:b1], rare[b0:b1])
        if size:
            total += size
            waiting += [(a0, a0 + i, b0, b0 + j), (a0 + i + size, a1, b0 + j + size, b1)]
    return total


def _percent(left: str, right: str) -> float:
    both = len(left) + len(right)
    return 2.0 * matching_length(left, right) / both * 100 if both else 100.0


def _matrix(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, empty: int) -> np.ndarray:
    """A column per text part, filled up with ``empty``."""
    places = np.arange(lengths.max())[:, None]
    inside = places < lengths
    return np.where(inside, codes[np.where(inside, starts + places, 0)], empty)


def _longest_blocks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``longest_block`` of each column of two matrices, in which every character may start a block."""
    count = a.shape[1]
    left, right, best = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count, np.int32)
    run = np.zeros((len(b) + 1, count), np.int32)
    for i in range(len(a)):
        run[1:] = np.where(b == a[i], run[:-1] + 1, 0)
        size = run.max(axis=0)
        better = np.flatnonzero(size > best)
        if len(better):
            best[better] = size[better]
            left[better] = i + 1 - size[better]
            right[better] = run[:, better].argmax(axis=0) - size[better]
    return left, right, best


def matching_lengths(pairs: list[tuple[str, str]]) -> list[int]:
    """``matching_length`` of each pair; pairs of short texts are compared many at a time."""
    found = np.zeros(len(pairs), np.int64)
    short = [k for k, (left, right) in enumerate(pairs) if max(len(left), len(right)) < LONG_TARGET]
    for k in set(range(len(pairs))).difference(short):
        found[k] = matching_length(*pairs[k])
    short.sort(key=lambda k: (len(pairs[k][0]), len(pairs[k][1])))
    for at in range(0, len(short), PAIRS_AT_ONCE):
        some = short[at : at + PAIRS_AT_ONCE]
        texts = [t for k in some for t in pairs[k]]
        codes = _codes("".join(texts)).astype(np.int64)
        ends = np.cumsum(list(map(len, texts)))
        starts = ends - list(map(len, texts))
        # parts still to compare: pair, and from where to where in either text
        parts = np.stack([np.asarray(some), starts[::2], ends[::2], starts[1::2], ends[1::2]])
        while (parts := parts[:, (parts[1] < parts[2]) & (parts[3] < parts[4])]).size:
            pair, a0, a1, b0, b1 = parts
            i, j, size = _longest_blocks(_matrix(codes, a0, a1 - a0, -1), _matrix(codes, b0, b1 - b0, -2))
            np.add.at(found, pair, size)
            i, j, hit = a0 + i, b0 + j, size > 0
            before, after = np.stack([pair, a0, i, b0, j]), np.stack([pair, i + size, a1, j + size, b1])
            parts = np.concatenate([before[:, hit], after[:, hit]], axis=1)
    return found.tolist()


@F.pandas_udf(T.DoubleType())
def _similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    pairs = list(zip(left, right))
    distinct = list({p for p in pairs if p[0] is not None and p[1] is not None})
    known: dict[tuple, float] = {}
    for (a, b), length in zip(distinct, matching_lengths(distinct), strict=True):
        known[a, b] = 2.0 * length / (len(a) + len(b)) * 100 if a or b else 100.0
    return pd.Series([known.get(p) for p in pairs], dtype="float64")


def similarity(prediction: Column, target: Column, stripped: bool = True) -> Column:
    """Ratio of matching text x 100; 0 where either side is missing.

    The test report trims both sides, the benchmark report does not. The order
    of the arguments matters.
    """
    if stripped:
        prediction, target = strip(prediction), strip(target)
    open_pair = prediction != target  # null where a side is missing
    compared = _similarity(F.when(open_pair, prediction), F.when(open_pair, target))
    return F.when(open_pair, compared).when(prediction == target, 100.0).otherwise(0.0)
