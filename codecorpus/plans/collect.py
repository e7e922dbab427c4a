"""From a tree of source files to the function table and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from codecorpus.operators import caps, clean, extract, repos
from codecorpus.sources import readers
from codecorpus.session import Staging


def function_counters(funcs: DataFrame, code: str = "original_code", **limits) -> DataFrame:
    """One row of counts over raw functions, in one pass.

    Copies are merged in each task before the shuffle of the distinct count.
    """
    reasons = clean.with_reject_reason(funcs, code, **limits)

    def count(reason: str) -> Column:
        return F.count_if(F.col("reject_reason") == reason)

    kept = F.when(F.col("reject_reason").isNull(), clean.text_key(code))
    return reasons.agg(
        F.count("*").alias("functions_raw"),
        count("short").alias("short_functions"),
        count("long").alias("long_functions"),
        count("empty").alias("empty_functions"),
        count("invalid").alias("invalid_lines"),
        F.countDistinct(kept).alias("functions_written"),
    )


def file_counters(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count("*").alias("files_scanned"),
        F.count_if(F.col("status") == "parsed").alias("files_parsed"),
        F.count_if(F.col("status") == "syntax_error").alias("files_syntax_error"),
        F.count_if(F.col("status") == "other_error").alias("files_other_error"),
    )


def duplicate_count() -> Column:
    """Raw rows that are neither written nor rejected. Each row ends in one bucket."""
    return (
        F.col("functions_raw")
        - F.col("functions_written")
        - F.col("short_functions")
        - F.col("long_functions")
        - F.col("empty_functions")
        - F.col("invalid_lines")
    )


def collection_counters(status: DataFrame, funcs: DataFrame, code: str = "original_code", **limits) -> DataFrame:
    """The ten counters and the duplicates, in one row."""
    counted = function_counters(funcs, code, **limits)
    names = counted.columns
    row = counted.select(F.struct(*names)).scalar()
    return (
        file_counters(status)
        .withColumn("_f", row)
        .select("*", *(F.col("_f").getField(n).alias(n) for n in names))
        .drop("_f")
        .withColumn("duplicates", duplicate_count())
    )


# The report's rows, in order, with their titles.
REPORT_ROWS = [
    ("files_scanned", "Total Python files scanned"),
    ("files_parsed", "Total Python files successfully parsed (AST)"),
    ("files_syntax_error", "Files skipped due to SyntaxError"),
    ("files_other_error", "Files skipped due to other errors"),
    ("functions_raw", "Total functions initially extracted (before cleaning)"),
    ("short_functions", "Too short (<3 lines of actual code)"),
    ("long_functions", "Too long (>100 lines of actual code)"),
    ("empty_functions", "Empty (after stripping whitespace)"),
    ("invalid_lines", "Invalid line numbers/structure"),
    ("duplicates", "Duplicates (based on code hash)"),
    ("functions_written", "Total unique, cleaned functions written"),
]


def description(counters: DataFrame) -> DataFrame:
    """``line_no, metric, value`` report rows from the counter row."""
    rows = [
        F.struct(F.lit(i).alias("line_no"), F.lit(title).alias("metric"), F.col(name).cast("bigint").alias("value"))
        for i, (name, title) in enumerate(REPORT_ROWS)
        if name in counters.columns
    ]
    return counters.select(F.inline(F.array(*rows)))


def collect_functions(
    spark: SparkSession, root: str, url_list: str, max_functions: int | None = None, exact_urls: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The whole flow: ``(function table, counter row)``; with ``max_functions`` it stops at so many kept functions.

    Every file is parsed once; the parsed rows are staged, then read by the
    cleaning, the cap and the counters.
    """
    staging = Staging(spark)
    parsed = staging.put(extract.parse_files(readers.read_source_files(spark, root)), "parsed")
    funcs = extract.functions_of(parsed)
    status = extract.status_of(parsed)
    cut = None if max_functions is None else clean.cap_cut(funcs, max_functions)
    if cut is not None:
        funcs = funcs.filter(caps.at_or_before(["path", "seq"], cut))
        # The file in which the cap is reached counts as scanned.
        status = status.filter(F.col("path") <= cut[0])
    counters = collection_counters(status, funcs)
    kept = clean.dedup_exact(clean.clean_functions(funcs))
    rows = repos.attach_repo_url(extract.function_columns(kept), readers.read_raw_lines(spark, url_list), exact=exact_urls)
    return extract.function_table(rows), counters
