"""Joins of a large table to a lookup table that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from codecorpus.session import Staging

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
SPREAD = 100_000


def fits_broadcast(table: DataFrame, rows: int, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table has no more than so many rows and bytes (as JSON text, an upper estimate)."""
    size = table.agg(F.count("*").alias("rows"), F.sum(F.length(F.to_json(F.struct("*")))).alias("bytes")).first()
    return size.rows <= rows and (size.bytes or 0) <= most_bytes


def hot_share(df: DataFrame) -> float:
    """A key is hot from about a quarter of a task's fair share of the rows on."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(0.01, max(1e-4, 1 / (4 * tasks)))


def hot_keys(df: DataFrame, on: list[str], share: float | None = None) -> DataFrame:
    """All keys that hold ``share`` of the rows or more, and perhaps some others.

    One pass with a fixed number of counters per task; the list cannot grow with
    the data. Which keys are in it changes the plan of a join, never its result.
    """
    keyed = df.select(F.struct(*on).alias("k"))
    found = keyed.freqItems(["k"], share or hot_share(df)).select(F.explode("k_freqItems").alias("k")).select("k.*")
    return df.sparkSession.createDataFrame(found.collect(), df.select(*on).schema)


def lookup_join(
    df: DataFrame, table: DataFrame, on: list[str], how: str = "left", broadcast_rows: int = BROADCAST_ROWS,
    staged: bool = False,
) -> DataFrame:
    """Attach the columns of ``table`` (unique on ``on``) to every row of ``df``.

    A table of a checked size is broadcast. A larger one is joined by a shuffle
    in which no key of ``df`` can gather its rows in one task: the table rows of
    its hot keys, few by construction, are broadcast, and rows that are served
    that way (or hold a null key) travel under a spread number instead.
    """
    if not staged:
        # Stored once: its size is checked first, then it is joined.
        table = Staging(df.sparkSession).put(table, "lookup")
    values = [c for c in table.columns if c not in on]
    if fits_broadcast(table, broadcast_rows):
        return df.join(F.broadcast(table), on, how).select(*df.columns, *values)
    hot = hot_keys(df, on)
    found = table.join(F.broadcast(hot), on, "left_semi").select(*on, F.struct(*values).alias("_near"))
    served = hot.join(found, on, "left").withColumn("_hot", F.lit(True))
    marked = df.join(F.broadcast(served), on, "left")

    alone = F.col("_hot").isNotNull()
    for c in on:
        alone = alone | F.col(c).isNull()
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))
    marked = marked.withColumns(
        {f"_key_{c}": F.when(~alone, F.col(c)) for c in on} | {"_spread": F.when(alone, spread).otherwise(F.lit(0))}
    )
    far = table.select(
        *(F.col(c).alias(f"_key_{c}") for c in on), F.lit(0).cast("bigint").alias("_spread"), F.struct(*values).alias("_far")
    )
    joined = marked.join(far, [*(f"_key_{c}" for c in on), "_spread"], "left").withColumn(
        "_row", F.coalesce("_near", "_far")
    )
    if how == "inner":
        joined = joined.filter(F.col("_row").isNotNull())
    return joined.select(*df.columns, *(F.col(f"_row.{c}").alias(c) for c in values))
