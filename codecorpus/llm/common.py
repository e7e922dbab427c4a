"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codecorpus.session import Staging

#: ``[^...]`` of the words that several operators share: every non-ASCII character,
#: digit and ASCII letter belongs to a word.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

__all__ = [
    "NOT_WORD", "Staging", "ascii_lower", "bounded_sample", "broadcast_below", "fraction_hash", "fresh", "held_out", "release_memory", "table",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def release_memory() -> None:
    """Give memory that this Python worker has freed back to the system.

    Spark reuses Python workers for later tasks and stages; without this, a worker keeps
    the peak of its largest batch while JVM-only stages run beside it.
    """
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # not glibc: nothing to trim
        pass


def fresh(columns: list[str], base: str) -> str:
    """``base``, lengthened by underscores until no column of ``columns`` has that name (in any case)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """True where the CRC-32 of the id as text falls into the part that is kept back. A null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def fraction_hash(*columns: Column) -> Column:
    """A draw in [0, 1) that depends on the values alone, for samples that any re-run repeats."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)


def broadcast_below(small: DataFrame, limit: int) -> DataFrame:
    """``small`` with a broadcast hint if its values take at most ``limit`` bytes, else as it is: Spark then shuffles both sides.

    ``small`` should be a staged table: it is counted first.
    """
    width = sum((F.octet_length(name) if kind == "string" else F.lit(8)) + F.lit(16) for name, kind in small.dtypes)
    total = small.agg(F.sum(F.coalesce(width, F.lit(16)))).first()[0] or 0
    return F.broadcast(small) if total <= limit else small


def bounded_sample(rows: DataFrame, by: str, limit: int, *key: str) -> DataFrame:
    """At most ``limit`` rows for each value of ``by``, chosen by a hash of ``key``; all rows where there are fewer.

    The number of rows is counted first, so that few more rows than are wanted reach the final ranking.
    """
    sizes = Staging(rows.sparkSession).put(rows.groupBy(by).agg(F.count("*").alias("__n")), "sizes")
    draw = rows.join(F.broadcast(sizes), by).withColumn("__draw", fraction_hash(*key))
    near = draw.filter(F.col("__draw") * F.col("__n") < 1.2 * limit + 50)
    rank = F.row_number().over(Window.partitionBy(by).orderBy("__draw", *key))
    return near.withColumn("__rank", rank).filter(F.col("__rank") <= limit).drop("__n", "__draw", "__rank")
