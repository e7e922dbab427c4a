"""First-n operators that hold for any n.

``orderBy(...).limit(n)`` sends n rows of every task to a single one. Here the
n-th key is found first, and the rows up to it are then a plain filter that
reaches the scan and leaves the rows where they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from codecorpus.session import Staging

SMALL = 100_000
SAMPLE = 4_000
GROWTH = 4


def at_or_before(keys: list[str], values) -> Column:
    """``keys <= values`` in order of the keys, as comparisons a scan can use."""
    last = F.col(keys[-1]) <= F.lit(values[-1])
    pairs = list(zip(keys, values))[:-1]
    return reduce(
        lambda rest, kv: (F.col(kv[0]) < F.lit(kv[1])) | ((F.col(kv[0]) == F.lit(kv[1])) & rest), reversed(pairs), last
    )


def nth_key(df: DataFrame, keys: list[str], n: int, small: int = SMALL, sample: int = SAMPLE, total: int | None = None):
    """The n-th smallest key (from 1) as a tuple; None if there are fewer rows.

    Keys must be unique and not null; a null key or one that repeats at the cut is
    an error. Each pass samples the range still in
    question, brackets the wanted rank between two sampled keys and counts both
    sides exactly, until few enough keys are left to sort. The sample decides
    how fast the range shrinks, never the answer.
    """
    rows = df.select(*keys)
    absent = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    size = rows.agg(F.count("*").alias("rows"), F.count_if(absent).alias("null_keys")).first()
    if size.null_keys:
        raise ValueError(f"{size.null_keys} rows have no key in {keys}")
    left = size.rows if total is None else total
    if n < 1 or n > left:
        return None
    seed = still = 0
    while left > max(small, sample):
        seed += 1
        drawn = rows.sample(min(1.0, sample / left), seed=seed).limit(4 * sample).collect()
        drawn = sorted(tuple(r) for r in drawn)
        if len(drawn) < 2:
            continue
        middle = n / left * len(drawn)
        margin = 4 * math.sqrt(len(drawn)) + 1
        low = drawn[int(middle - margin)] if middle - margin >= 0 else None
        high = drawn[int(middle + margin)] if middle + margin < len(drawn) else None
        if 2 * margin >= len(drawn):
            low, high = None, drawn[len(drawn) // 2 - 1]
        below = at_or_before(keys, low) if low else F.lit(False)
        inside = (at_or_before(keys, high) if high else F.lit(True)) & ~below
        before = left
        counts = rows.agg(F.count_if(below).alias("below"), F.count_if(inside).alias("inside")).first()
        if n <= counts.below:
            rows, left = rows.filter(below), counts.below
        elif n <= counts.below + counts.inside:
            rows, n, left = rows.filter(inside), n - counts.below, counts.inside
        else:
            passed = counts.below + counts.inside
            rows, n, left = rows.filter(~(below | inside)), n - passed, left - passed
        still = still + 1 if left == before else 0
        if still == 5:  # sampled brackets halve the range unless it is one repeated key
            raise ValueError(f"keys in {keys} repeat")
    found = [tuple(r) for r in rows.orderBy(*keys).offset(n - 1).limit(2).collect()]
    if len(found) == 2 and found[0] == found[1]:
        raise ValueError(f"keys in {keys} repeat: {found[0]}")
    return found[0]


def head(df: DataFrame, n: int, order: list[str], small: int = SMALL) -> DataFrame:
    """The first ``n`` rows in the order of unique keys; all rows if fewer."""
    if n < 1:
        return df.filter(F.lit(False))
    cut = nth_key(df, order, n, small)
    return df if cut is None else df.filter(at_or_before(order, cut))


def growing_cut(df: DataFrame, n: int, order: list[str], counted: Callable[[DataFrame], DataFrame], small: int = SMALL):
    """The order key at which the n-th row of ``counted`` stands; None below n.

    ``counted`` picks rows such that those of a prefix are a prefix of those of
    the whole. It runs on a prefix of 4n rows, then on longer ones until n rows
    are found, so a small cap on a large table never does the costly work on
    all of it. Finding a prefix reads the order columns alone.
    """
    total = df.count()
    staging = Staging(df.sparkSession)
    size = GROWTH * n
    while True:
        prefix = df if size >= total else head(df, size, order, small)
        keys = staging.put(counted(prefix).select(*order), f"counted-{size}")
        found = keys.count()
        if found >= n or size >= total:
            return nth_key(keys, order, n, small, total=found)
        size *= GROWTH


def first_matching(df: DataFrame, condition: Column, n: int, order: list[str], small: int = SMALL) -> DataFrame:
    """The first ``n`` rows for which the condition holds."""
    cut = growing_cut(df, n, order, lambda rows: rows.filter(condition), small)
    return (df if cut is None else df.filter(at_or_before(order, cut))).filter(condition)


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """A report of the k leading rows. For small k: each task keeps k rows."""
    return df.orderBy(*order).limit(k)
