"""Shards of nearly equal bytes: contiguous pieces of one global order.

The order is (digest of the text, id), so equal texts stand together. It is made by
range partitioning; the parts' totals, one row each, give each part its offset, and
a running sum inside a part gives each row its place in the whole. Targets at equal
distances cut the order into shards. A cut falls on the row boundary next to its
target, or, if the target lies inside a small group of equal texts, on the nearer
end of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codecorpus.llm.common import Staging

SHARDS = 40
ROW_BYTES = 16
#: A group of equal texts of at most this share of a shard is not cut.
KEEP_TOGETHER = 0.02


def digest(text: Column) -> Column:
    """60 bits of the text's SHA-256."""
    return F.conv(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 15), 16, 10).cast("bigint")


def places(docs: DataFrame, staging: Staging, id_column: str, text_column: str) -> tuple[DataFrame, int]:
    """Rows with ``digest, doc_id, size, crc, start, rank``: bytes and rows before each row; and all bytes."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        digest(text).alias("digest"), F.col(id_column).alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
    )
    parts = staging.put(rows.repartitionByRange("digest", "doc_id").withColumn("part", F.spark_partition_id()), "parts")
    totals = parts.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    offsets = staging.put(totals.select(
        "part", "bytes", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows0")), "offsets")
    order = Window.partitionBy("part").orderBy("digest", "doc_id", "size", "crc")
    placed = parts.join(F.broadcast(offsets.drop("bytes")), "part").select(
        "digest", "doc_id", "size", "crc",
        (F.col("bytes0") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("start"),
        (F.col("rows0") + F.row_number().over(order) - 1).alias("rank"))
    return staging.put(placed, "placed"), offsets.agg(F.sum("bytes")).first()[0] or 0


def cuts(placed: DataFrame, total: int, shards: int, keep_together: float) -> list[tuple[int, int]]:
    """For each shard but the first: the bytes and rows before it. One row per shard reaches the driver."""
    crossed = placed.select(
        "digest", "start", "size", "rank",
        F.expr(f"explode(sequence(start * {shards} div {total} + 1, (start + size) * {shards} div {total}))").alias("shard"),
        F.expr(f"start * {shards} div {total} < (start + size) * {shards} div {total}").alias("crosses"),
    ).filter(f"crosses and shard < {shards}").orderBy("shard").collect()
    inside = placed.filter(F.col("digest").isin([r.digest for r in crossed])).groupBy("digest").agg(
        F.min("start").alias("start"), F.min("rank").alias("rank"), F.sum("size").alias("size"), F.count("*").alias("rows"))
    groups = {r.digest: r for r in inside.collect()} if crossed else {}
    found = []
    for row in crossed:
        group = groups[row.digest]
        start, rank, size, rows = row.start, row.rank, row.size, 1
        if group.size * shards <= keep_together * total:
            start, rank, size, rows = group.start, group.rank, group.size, group.rows
        later = 2 * (row.shard * total - start * shards) >= size * shards
        found.append((start + size, rank + rows) if later else (start, rank))
    return found


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, keep_together: float = KEEP_TOGETHER, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Rows ``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one for each row of ``docs``.

    ``size``: UTF-8 bytes and 16 (null text: 16). A null id comes first among equal texts. A shard
    differs from the target by half a row, or half a small group of equal texts, at each end;
    a row larger than a shard leaves the next shards empty. Repeated rows each take a slot.
    """
    placed, total = places(docs, Staging(docs.sparkSession), id_column, text_column)
    at = [(0, 0), *(cuts(placed, total, shards, keep_together) if total else [])]
    starts = F.array(*(F.lit(x[0]).cast("bigint") for x in at))
    ranks = F.array(*(F.lit(x[1]).cast("bigint") for x in at))
    shard = F.size(F.filter(starts, lambda x: x <= F.col("start"))) - 1
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.get(ranks, F.col("shard"))).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
