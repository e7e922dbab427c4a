"""Reports over a training log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def best_checkpoint(log: DataFrame) -> DataFrame:
    """One row: the step of the lowest evaluation loss (the first of equals), and the newest."""
    evals = log.filter("eval_loss IS NOT NULL")
    return evals.agg(
        F.min(F.struct("eval_loss", "step")).alias("best"), F.max("step").alias("newest_step")
    ).select(F.col("best.step").alias("best_step"), F.col("best.eval_loss").alias("best_eval_loss"), "newest_step")


def loss_summary(log: DataFrame) -> DataFrame:
    """One row: first, last and least training loss."""
    train = log.filter("loss IS NOT NULL")
    return train.agg(
        F.count("*").alias("entries"),
        F.min_by("loss", "step").alias("first_loss"),
        F.max_by("loss", "step").alias("last_loss"),
        F.min("loss").alias("least_loss"),
    )


def loss_by_epoch(log: DataFrame, buckets_per_epoch: int = 10) -> DataFrame:
    """Mean loss per part of an epoch."""
    part = F.floor(F.col("epoch") * buckets_per_epoch).cast("bigint")
    return (
        log.filter("loss IS NOT NULL")
        .groupBy(part.alias("bucket"))
        .agg(F.count("*").alias("entries"), F.avg("loss").alias("mean_loss"))
    )
