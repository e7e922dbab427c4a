"""Functions of Python source files.

Spark spreads the files and the grammar is the interpreter's own ``ast``; the
helpers below only walk one file's tree and cut texts out of it.
"""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from codecorpus.functions.text import code_tokens, default_end_line, relative_path, repo_from_path, signature
from codecorpus.sources.readers import FUNCTION_SCHEMA

PARSED_SCHEMA = (
    "path string, seq int, status string, function_name string, start_line int, end_line int, "
    "is_async boolean, original_code string"
)
PARSED_TYPES = {
    "path": pa.string(), "seq": pa.int32(), "status": pa.string(), "function_name": pa.string(), "start_line": pa.int32(),
    "end_line": pa.int32(), "is_async": pa.bool_(), "original_code": pa.string(),
}
ROWS_PER_FRAME = 2_000
#: The fields in which statements hold statements, the last one in a node first.
BLOCKS = ("cases", "finalbody", "orelse", "handlers", "body")


def decode_source(content: bytes) -> str:
    """UTF-8 without undecodable bytes, all line ends as line feeds."""
    return content.decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n")


def _definitions(tree: ast.AST) -> Iterator[ast.AST]:
    """Definitions at any depth, parents before what they hold. Only statements hold them, so no expression is visited."""
    waiting = [tree]
    while waiting:
        node = waiting.pop()
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
            yield node
        for name in BLOCKS:
            if name in node._fields:
                waiting.extend(reversed(getattr(node, name)))


def _segment(lines: list[str], node: ast.AST) -> str:
    """The text of a node. Its columns count bytes."""
    chosen = lines[node.lineno - 1 : node.end_lineno]
    chosen[-1] = chosen[-1].encode()[: node.end_col_offset].decode()
    chosen[0] = chosen[0].encode()[node.col_offset :].decode()
    return "\n".join(chosen)


def _parsed(content: bytes) -> tuple[str, str, ast.AST | None]:
    """Status, text and tree of one file."""
    try:
        text = decode_source(content)
        return "parsed", text, ast.parse(text)
    except SyntaxError:
        return "syntax_error", "", None
    except Exception:
        return "other_error", "", None


def _file_rows(path: str, content: bytes) -> list[tuple]:
    """One status row (seq -1), then one row per definition."""
    status, text, tree = _parsed(content)
    rows: list[tuple] = [(path, -1, status, None, None, None, None, None)]
    if tree is None:
        return rows
    lines = text.split("\n")
    for seq, node in enumerate(_definitions(tree)):
        try:
            code = _segment(lines, node)
        except Exception:
            code = ""
        kind = "function" if code else "segment_error"
        is_async = isinstance(node, ast.AsyncFunctionDef)
        rows.append((path, seq, kind, node.name, node.lineno, node.end_lineno, is_async, code or None))
    return rows


def parse_files(files: DataFrame) -> DataFrame:
    """``path, content`` to status and function rows, one parse per file.

    Stage the result when both kinds are wanted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for path, content in zip(batch.column(0), batch.column(1)):
                rows.extend(_file_rows(path.as_py(), content.as_py()))
                if len(rows) >= ROWS_PER_FRAME:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return files.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(run, PARSED_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), PARSED_TYPES.values())], list(PARSED_TYPES))


def functions_of(parsed: DataFrame) -> DataFrame:
    return parsed.filter("status = 'function'").drop("status")


def extract_functions(files: DataFrame) -> DataFrame:
    """One row per ``def`` or ``async def``; nested ones have their own rows too."""
    return functions_of(parse_files(files))


def status_of(parsed: DataFrame) -> DataFrame:
    return parsed.filter("seq = -1").select("path", "status")


def file_status(files: DataFrame) -> DataFrame:
    """``parsed``, ``syntax_error`` or ``other_error`` per file; no function text is cut out or sent."""

    @F.pandas_udf("string")
    def of(contents: pd.Series) -> pd.Series:
        return contents.map(lambda content: _parsed(content)[0])

    return files.select("path", of(F.col("content").cast("binary")).alias("status"))


def segment_errors(parsed: DataFrame) -> DataFrame:
    return parsed.filter("status = 'segment_error'").drop("original_code", "status")


def function_columns(funcs: DataFrame) -> DataFrame:
    """Add repository, path, signature and token columns; keep the order keys."""
    end = default_end_line(F.col("start_line"), F.col("end_line"), F.col("original_code"))
    return funcs.select(
        "path",
        "seq",
        repo_from_path(F.col("path")).alias("repo_name"),
        relative_path(F.col("path")).alias("file_path"),
        "function_name",
        "start_line",
        end.cast("int").alias("end_line"),
        signature(F.col("function_name"), F.col("is_async")).alias("signature"),
        "original_code",
        code_tokens(F.col("original_code")).alias("code_tokens"),
    )


def function_table(funcs: DataFrame) -> DataFrame:
    """The published columns, in their order."""
    return funcs.select(*FUNCTION_SCHEMA.fieldNames())
