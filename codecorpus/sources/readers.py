"""Readers. All take explicit schemas; none infers types from data."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from codecorpus.functions.text import require_columns

# A marker that no field holds. Without it Spark reads "" as null, and words
# such as NA or nan must stay text.
NULL_MARKER = "\u0000null\u0000"

MAX_LIST_FILES = 100
#: Bytes of file contents that a task holds before it hands them on.
FRAME_BYTES = 16 << 20

FUNCTION_SCHEMA = T.StructType(
    [
        T.StructField("repo_name", T.StringType()),
        T.StructField("repo_url", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("function_name", T.StringType()),
        T.StructField("start_line", T.IntegerType()),
        T.StructField("end_line", T.IntegerType()),
        T.StructField("signature", T.StringType()),
        T.StructField("original_code", T.StringType()),
        T.StructField("code_tokens", T.StringType()),
    ]
)

SCORED_SCHEMA = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("input_text", T.StringType()),
        T.StructField("target_text", T.StringType()),
        T.StructField("has_if", T.BooleanType()),
        T.StructField("predicted_if", T.StringType()),
        T.StructField("prediction_score", T.StringType()),
        T.StructField("perplexity", T.DoubleType()),
    ]
)

LOG_ENTRY = T.StructType(
    [
        T.StructField("epoch", T.DoubleType()),
        T.StructField("eval_loss", T.DoubleType()),
        T.StructField("grad_norm", T.DoubleType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("step", T.LongType()),
    ]
)
LOG_SCHEMA = T.StructType([T.StructField("log_history", T.ArrayType(LOG_ENTRY))])


def _csv_reader(spark: SparkSession):
    """CSV with line breaks and doubled quotes inside fields.

    A file with line breaks in its fields cannot be split, so one task reads one
    file: keep such files many and small, and use Parquet between jobs.
    """
    return spark.read.options(
        header=True, multiLine=True, quote='"', escape='"', nullValue=NULL_MARKER, emptyValue=""
    )


def read_repo_table(spark: SparkSession, path: str) -> DataFrame:
    df = _csv_reader(spark).option("inferSchema", False).csv(path)
    require_columns(df, ["name"])
    return df.select("name")


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, line`` of a text file, or of a folder's files in the order of their names.

    Numbers grow with the position; they have gaps, only their order counts. A
    list of files is read as one branch per file, since one scan of all would
    order them by size. Such lists are few files.
    """
    files = sorted(spark.read.text(path).inputFiles())
    if len(files) > MAX_LIST_FILES:
        raise ValueError(f"{path} has {len(files)} files; an ordered list may have {MAX_LIST_FILES}")
    parts = [spark.read.text(f) for f in files] or [spark.createDataFrame([], "value string")]
    lines = reduce(DataFrame.unionAll, parts)
    return lines.select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, url``; blank lines and ``#`` comments are left out."""
    from codecorpus.functions.text import strip

    return (
        read_raw_lines(spark, path)
        .select("line_no", strip(F.col("line")).alias("url"))
        .filter((F.col("url") != "") & ~F.col("url").startswith("#"))
    )


def list_files(spark: SparkSession, root: str, suffix: str) -> list[tuple[str]]:
    """URIs of all files below a folder, hidden ones included."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    names = []
    while found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(suffix):
            names.append((name,))
    return names


def _read_whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        paths, contents, held = [], [], 0
        for uri in frame["path"]:
            system, name = fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)
            with system.open_input_stream(name) as stream:
                contents.append(stream.read())
            paths.append(uri)
            held += len(contents[-1])
            if held >= FRAME_BYTES:
                yield pd.DataFrame({"path": paths, "content": contents})
                paths, contents, held = [], [], 0
        if paths:
            yield pd.DataFrame({"path": paths, "content": contents})


def _list_below(suffix: str):
    """Paths of the files below folders of a mounted file system; a path that is no folder is itself listed."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system = fs.LocalFileSystem()
        for frame in frames:
            for top in frame["path"]:
                if system.get_file_info(top).type == fs.FileType.Directory:
                    below = system.get_file_info(fs.FileSelector(top, recursive=True))
                else:
                    below = [system.get_file_info(top)]
                yield pd.DataFrame({"path": [f.path for f in below if f.type == fs.FileType.File and f.path.endswith(suffix)]}, dtype=object)

    return run


def _mounted_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """``path, content`` of a tree on a mounted file system. The driver lists the first level alone;
    tasks list what is below, and the paths are dealt out before the files are read."""
    tops = [(f.path,) for f in fs.LocalFileSystem().get_file_info(fs.FileSelector(folder))]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    listed = spark.createDataFrame(tops, "path string").repartition(tasks).mapInPandas(_list_below(suffix), "path string")
    return listed.repartition(tasks, "path").mapInPandas(_read_whole, "path string, content binary")


def read_source_files(spark: SparkSession, root: str, suffix: str = ".py") -> DataFrame:
    """``path, content``: paths relative to ``root``, content as bytes.

    A tree on a file system that is mounted everywhere is listed and read by tasks.
    Elsewhere, the scan packs files by size, which is also the cost of parsing them, so the
    content is not shuffled again. Spark's scans leave out files of zero bytes
    and names that begin with ``_`` or ``.``, such as ``__init__.py``: whatever a
    listing has and the scan has not is read in tasks of its own.
    """
    root = root.rstrip("/")
    # The scan gives full URIs; the folder may be written with or without scheme.
    folder = root.split("://", 1)[-1] if "://" in root else root
    folder = folder.removeprefix("file:")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file":
        return _below(_mounted_files(spark, folder, suffix), folder)
    scan = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(root)
    )
    listed = spark.createDataFrame(list_files(spark, root, suffix), "path string")
    plain = lambda path: F.regexp_replace(path, "^file:/+", "/")
    seen = scan.select(plain(F.col("path")).alias("path"))
    rest = listed.select(plain(F.col("path")).alias("path")).join(seen, "path", "left_anti")
    files = scan.select(plain(F.col("path")).alias("path"), "content").unionByName(
        rest.mapInPandas(_read_whole, "path string, content binary"))
    return _below(files, folder)


def _below(files: DataFrame, folder: str) -> DataFrame:
    """Paths relative to the folder."""
    start = F.locate(folder + "/", F.col("path")) + len(folder) + 1
    return files.select(F.col("path").substr(start, F.length("path")).alias("path"), "content")


def read_functions(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    if format == "csv":
        return _csv_reader(spark).schema(FUNCTION_SCHEMA).csv(path)
    return spark.read.format(format).load(path)


def read_as_strings(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """A CSV table whose named columns are all text, in the file's order."""
    df = _csv_reader(spark).option("inferSchema", False).csv(path)
    require_columns(df, cols)
    return df.select(*cols)


def parse_int_list(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text such as ``[1, 2]`` becomes a list; bad text becomes null."""
    return df.withColumns({c: F.from_json(F.col(c), "array<int>") for c in cols})


def read_scored(spark: SparkSession, path: str, schema: T.StructType = SCORED_SCHEMA) -> DataFrame:
    """A scored result table. The score stays text, for ``to_numeric``."""
    return _csv_reader(spark).schema(schema).csv(path)


def read_loss_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per logged step, in ``step, epoch, loss, eval_loss, ...`` form."""
    return (
        spark.read.schema(LOG_SCHEMA)
        .json(path, multiLine=True)
        .select(F.explode("log_history").alias("entry"))
        .select("entry.step", "entry.epoch", "entry.loss", "entry.eval_loss", "entry.grad_norm", "entry.learning_rate")
    )
