"""Train, validation and test parts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from codecorpus.functions.draws import digest, draw
from codecorpus.operators.caps import SMALL, at_or_before, nth_key


def part_sizes(n: int, held_out: float = 0.2, test: float = 0.5) -> tuple[int, int, int]:
    """Rows for train, val and test; the held-out shares are rounded up."""
    rest = math.ceil(n * held_out)
    n_test = math.ceil(rest * test)
    return n - rest, rest - n_test, n_test


def split_dataset(df: DataFrame, key: str, seed: int = 42, exact: bool = True, small: int = SMALL) -> DataFrame:
    """Add ``split``: 80 / 10 / 10 in the order of a seeded digest of the key.

    The exact form finds the two digests at which the parts end; the split is
    then a comparison per row, without sorting or moving any row. Keys must be
    unique and not null, else an error is raised. The other form compares the draw with fixed shares, so its sizes are
    near the shares and it needs no pass of its own.
    """
    hexes = digest(seed, F.col(key))
    if not exact:
        share = F.pmod(draw(hexes), F.lit(10))
        return df.withColumn("split", F.when(share < 8, "train").when(share < 9, "val").otherwise("test"))
    keyed = df.withColumn("_digest", hexes)
    order = ["_digest", key]
    total = keyed.count()
    n_train, n_val, _ = part_sizes(total)
    split = F
    for name, rank in (("train", n_train), ("val", n_train + n_val)):
        cut = nth_key(keyed, order, rank, small, total=total)
        if cut is not None:
            split = split.when(at_or_before(order, cut), name)
    column = F.lit("test") if split is F else split.otherwise("test")
    return keyed.withColumn("split", column).drop("_digest")


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("rows"))
