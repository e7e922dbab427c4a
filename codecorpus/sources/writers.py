"""Writers. Each task writes its own files; nothing is gathered first."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from codecorpus.functions.text import require_columns
from codecorpus.sources.readers import FUNCTION_SCHEMA


def _csv_writer(df: DataFrame, mode: str, quote_all: bool = False):
    # Null is written as nothing and empty text as "", which the readers keep apart.
    return df.write.mode(mode).options(header=True, quote='"', escape='"', quoteAll=quote_all)


def write_functions(df: DataFrame, path: str, format: str = "parquet", mode: str = "append") -> None:
    """Append function rows. In CSV form every new file has its own header."""
    rows = df.select(*FUNCTION_SCHEMA.fieldNames())
    if format == "csv":
        _csv_writer(rows, mode).csv(path)
    else:
        rows.write.mode(mode).format(format).save(path)


def write_pretrain(df: DataFrame, path: str, format: str = "csv") -> None:
    """Replace the table; in CSV form lists are text and all fields are quoted."""
    require_columns(df, ["input_ids", "labels", "original_code_snippet"])
    if format != "csv":
        df.write.mode("overwrite").format(format).save(path)
        return
    as_text = {c: F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]")) for c in ("input_ids", "labels")}
    _csv_writer(df.withColumns(as_text), "overwrite", quote_all=True).csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One folder per split, all written in a single pass."""
    require_columns(df, ["split"])
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_corpus(df: DataFrame, path: str, col: str = "original_code") -> None:
    df.select(F.col(col).alias("text")).filter("text IS NOT NULL").write.mode("overwrite").text(path)


def write_url_list(df: DataFrame, path: str) -> None:
    """A list of a few files: its lines are read back in order."""
    df.select("url").coalesce(8).write.mode("overwrite").text(path)


def write_files(df: DataFrame, root: str) -> None:
    """``path, content``: one file per row below ``root``. Tasks write their own files; a repeated task writes the same again."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, top = fs.FileSystem.from_uri(root) if ":/" in root else (fs.LocalFileSystem(), root)
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                name = f"{top}/{path}"
                system.create_dir(name.rpartition("/")[0], recursive=True)
                with system.open_output_stream(name) as stream:
                    stream.write(content)
            yield frame[["path"]]

    df.select("path", "content").mapInPandas(run, "path string").write.format("noop").mode("overwrite").save()


def write_report(df: DataFrame, path: str) -> None:
    """The description rows (a dozen) as one text file of ``name: value``."""
    df.coalesce(1).sortWithinPartitions("line_no").select(
        F.concat("metric", F.lit(": "), F.col("value").cast("string")).alias("text")
    ).write.mode("overwrite").text(path)


def write_results(df: DataFrame, path: str, format: str = "csv") -> None:
    if format == "csv":
        _csv_writer(df, "overwrite").csv(path)
    else:
        df.write.mode("overwrite").format(format).save(path)


def write_loss_history(log: DataFrame, path: str, entries_per_file: int = 50_000, mode: str = "overwrite") -> None:
    """A training log as state files: one JSON document ``{"log_history": [...]}`` per file.

    ``log`` has the columns of ``LOG_ENTRY`` (missing ones are null). Rows are dealt into
    files of about ``entries_per_file`` entries by a hash of the step, and each file's
    entries are ordered by step, so no task gathers more than one file's entries.
    """
    from codecorpus.sources.readers import LOG_ENTRY

    rows = log.select(*(F.col(f.name).cast(f.dataType) if f.name in log.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in LOG_ENTRY))
    files = max(1, -(-rows.count() // entries_per_file))
    entry = F.struct(*(F.col(f.name) for f in LOG_ENTRY))
    grouped = rows.groupBy(F.pmod(F.xxhash64("step"), F.lit(files)).alias("file")).agg(
        F.array_sort(F.collect_list(entry), lambda a, b: F.when(a.step < b.step, -1).when(a.step > b.step, 1).otherwise(0)).alias("log_history")
    )
    # one document per folder ``file=k``: the reader takes each file as one JSON value
    grouped.write.mode(mode).partitionBy("file").json(path)

