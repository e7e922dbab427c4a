"""Seeded draws that depend on row keys only.

``rand`` changes with the partitioning; an md5 draw gives the same value on any
cluster, after a lost task, and in any other SQL engine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def digest(seed: int, *keys: Column) -> Column:
    """Hex md5 of the seed and the keys, joined by colons."""
    parts = [F.lit(str(seed)), *(k.cast("string") for k in keys)]
    return F.md5(F.concat_ws(":", *parts))


def draw(hexdigest: Column, word: int = 0) -> Column:
    """One of the four 32-bit numbers held in an md5 digest."""
    return F.conv(F.substring(hexdigest, 1 + 8 * word, 8), 16, 10).cast("bigint")


def choose(seed: int, key: Column, size: Column) -> Column:
    """A zero-based index below ``size``; null when there is nothing to choose."""
    return F.when(size > 0, F.pmod(draw(digest(seed, key)), size)).cast("int")


def below(hexdigest: Column, share: float, word: int = 0) -> Column:
    """Whether a draw, as a share of its range, is less than ``share``.

    Hex text of fixed length sorts as its number does, so none is parsed.
    """
    limit = math.ceil(share * 2**32)
    if limit >= 2**32:
        return F.lit(True)
    return F.substring(hexdigest, 1 + 8 * word, 8) < F.lit(f"{limit:08x}")
