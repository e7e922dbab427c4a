"""Checks of a masked-token table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from codecorpus.functions.text import require_columns
from codecorpus.operators.masking import UNSCORED

SEQUENCE_LENGTH = 512


def check_pretrain(df: DataFrame, seq_len: int = SEQUENCE_LENGTH) -> DataFrame:
    """Adds ``errors``: ``list_text``, ``length`` and ``nothing_masked``.

    Lists may come as text; text that is no list leaves the other checks out.
    """
    require_columns(df, ["input_ids", "labels", "original_code_snippet"])
    kinds = dict(df.dtypes)

    def parsed(name: str):
        return F.from_json(name, "array<int>") if kinds[name] == "string" else F.col(name)

    df = df.withColumns({"_ids": parsed("input_ids"), "_labels": parsed("labels")})
    unreadable = F.col("_ids").isNull() | F.col("_labels").isNull()
    lengths = (F.size("_ids") != seq_len) | (F.size("_labels") != seq_len)
    nothing = ~F.exists("_labels", lambda x: F.coalesce(x != UNSCORED, F.lit(True)))
    errors = F.when(unreadable, F.array(F.lit("list_text"))).otherwise(
        F.array_compact(F.array(F.when(lengths, F.lit("length")), F.when(nothing, F.lit("nothing_masked"))))
    )
    return df.withColumn("errors", errors).drop("_ids", "_labels")


def validate_pretrain(df: DataFrame, seq_len: int = SEQUENCE_LENGTH) -> DataFrame:
    """One row of totals with the pass flag."""
    checked = check_pretrain(df, seq_len)
    bad = F.size("errors") > 0
    return checked.agg(
        F.count("*").alias("rows"),
        F.count_if(bad).alias("bad_rows"),
        F.count_if(F.array_contains("errors", "list_text")).alias("list_text"),
        F.count_if(F.array_contains("errors", "length")).alias("length"),
        F.count_if(F.array_contains("errors", "nothing_masked")).alias("nothing_masked"),
        (F.count_if(bad) == 0).alias("passed"),
    )


def error_examples(checked: DataFrame, key: str, k: int = 5) -> DataFrame:
    """``row_number, key, errors`` of the first k bad rows, counted from 1.

    Only the k reported rows need a number, so no row is sorted for it: each row
    is counted towards the first reported key that is not below its own.
    """
    bad = checked.filter(F.size("errors") > 0).orderBy(key).limit(k).select(key, "errors")
    keys = bad.agg(F.sort_array(F.collect_list(key)).alias("keys")).scalar()
    place = F.size(F.filter("_keys", lambda b: b < F.col(key)))
    counts = checked.select(key).withColumn("_keys", keys).groupBy(place.alias("place")).agg(F.count("*").alias("n"))
    steps = counts.agg(F.collect_list(F.struct("place", "n")).alias("steps")).scalar()
    own = F.array_position("_keys", F.col(key)) - 1
    before = F.filter("_steps", lambda s: s["place"] <= own)
    number = F.aggregate(before, F.lit(0).cast("bigint"), lambda total, s: total + s["n"])
    return bad.withColumns({"_keys": keys, "_steps": steps}).select(number.alias("row_number"), key, "errors")
