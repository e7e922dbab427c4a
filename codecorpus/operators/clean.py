"""Cleaning rules and exact dedup of function tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from codecorpus.functions.text import NOT_BLANK, nonblank_lines
from codecorpus.operators import caps

MIN_LINES = 3
MAX_LINES = 100
MAX_FUNCTIONS = 250_000


def with_reject_reason(
    df: DataFrame, code: str = "original_code", min_lines: int = MIN_LINES, max_lines: int = MAX_LINES
) -> DataFrame:
    """Adds ``reject_reason``: why a function is dropped, or null.

    The first rule that fires counts. Empty text has no line at all, so it is
    already ``short``.
    """
    start, end, lines = F.col("start_line"), F.col("end_line"), F.col("_lines")
    reason = (
        F.when(start.isNull() | end.isNull() | (start > end), "invalid")
        .when(lines < min_lines, "short")
        .when(lines > max_lines, "long")
        .when(~F.col(code).rlike(NOT_BLANK), "empty")
    )
    return df.withColumn("_lines", nonblank_lines(F.col(code))).withColumn("reject_reason", reason).drop("_lines")


def clean_functions(df: DataFrame, code: str = "original_code", **limits) -> DataFrame:
    return with_reject_reason(df, code, **limits).filter("reject_reason IS NULL").drop("reject_reason")


def text_key(col: str) -> Column:
    return F.unhex(F.sha2(F.col(col), 256))


def dedup_exact(df: DataFrame, col: str = "original_code", order: list[str] = ("path", "seq")) -> DataFrame:
    """The first row of each exact text.

    Spark limits a ``row_number() = 1`` window before its shuffle, so a task
    sends one row per text at most, however many copies it holds.
    """
    window = Window.partitionBy("_text_key").orderBy(*order)
    return (
        df.withColumn("_text_key", text_key(col))
        .withColumn("_rank", F.row_number().over(window))
        .filter("_rank = 1")
        .drop("_rank", "_text_key")
    )


def append_new(existing: DataFrame, new: DataFrame, col: str = "original_code", order: list[str] = ("path", "seq")) -> DataFrame:
    """The rows of ``new`` whose text is not in ``existing``, each text once.

    Both sides hold each text once before they meet, so no copy count matters.
    """
    known = existing.select(text_key(col).alias("_text_key")).distinct()
    fresh = dedup_exact(new, col, order).withColumn("_text_key", text_key(col))
    return fresh.join(known, "_text_key", "left_anti").drop("_text_key")


def append_rows(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Rows of successive chunks in one table, columns matched by name."""
    for chunk in more:
        first = first.unionByName(chunk)
    return first


def cap_cut(df: DataFrame, n: int = MAX_FUNCTIONS, col: str = "original_code", order: list[str] = ("path", "seq"), **limits):
    """The order key at which the n-th clean, unique row is read; None below n."""

    def kept(rows: DataFrame) -> DataFrame:
        return dedup_exact(clean_functions(rows, col, **limits).select(*order, col), col, order)

    return caps.growing_cut(df.select(*order, col, "start_line", "end_line"), n, list(order), kept)


def cap_after_clean(
    df: DataFrame, n: int = MAX_FUNCTIONS, col: str = "original_code", order: list[str] = ("path", "seq"), **limits
) -> DataFrame:
    """All rows read until n clean, unique ones exist, in ``order``.

    The filter stands on the raw rows, so counters see the same prefix as the
    rows kept. A copy never comes before its first text, so cleaning and dedup
    of the prefix give exactly the first n kept rows.
    """
    cut = cap_cut(df, n, col, order, **limits)
    return df if cut is None else df.filter(caps.at_or_before(list(order), cut))
