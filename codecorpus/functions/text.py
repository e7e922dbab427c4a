"""Text rules as native column expressions.

Line breaks, blanks and the statement pattern follow Python's string methods,
which differ from Java's ``\\s`` and ``\\R``; every operator takes them from here.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Character classes in Java regex syntax, special tokens, limits.
BREAK_CHARS = r"\n\r\x0B\x0C\x1C\x1D\x1E\x85\x{2028}\x{2029}"
RARE_BREAKS = r"\r\x0B\x0C\x1C\x1D\x1E\x85\x{2028}\x{2029}"
LINE_BREAK = rf"\r\n|[{BREAK_CHARS}]"
BLANK_CHARS = r"\s\x0B\x1C-\x1F\x85\p{Z}"
BLANK = rf"[{BLANK_CHARS}]"
NOT_BLANK = rf"[^{BLANK_CHARS}]"
STATEMENT = r"if.*?:"
IF_MASK = "<if_mask>"
MASK = "<mask>"
REPO_URL_PREFIX = "https://github.com/"


def strip(col: Column) -> Column:
    """Both ends without whitespace, as Python's ``str.strip``."""
    return F.regexp_replace(col, rf"^{BLANK}+|{BLANK}+\z", "")


def lstrip(col: Column) -> Column:
    return F.regexp_replace(col, rf"^{BLANK}+", "")


def at_line_start(statement: str) -> str:
    """A regex for a statement (group 1) that only blanks precede in its line.

    For text whose only line breaks are line feeds.
    """
    return rf"(?dm)^[{BLANK_CHARS}&&[^\n]]*+({statement})"


def code_tokens(col: Column) -> Column:
    """Every whitespace run becomes one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(col, rf"{BLANK}+", " "))


def split_lines(col: Column) -> Column:
    """Lines as ``str.splitlines`` gives them: no item after a final break."""
    body = F.regexp_replace(col, rf"(?:{LINE_BREAK})\z", "")
    return F.when(col != "", F.split(body, LINE_BREAK, -1)).when(col == "", F.array().cast("array<string>"))


def unify_breaks(col: Column) -> Column:
    """Every line break as a line feed, none at the end: lines joined again.

    Text that has line feeds only, as most has, is not rewritten, and is searched for others once.
    """
    unified = F.regexp_replace(F.regexp_replace(col, LINE_BREAK, "\n"), r"\n\z", "")
    shorter = F.when(F.endswith(col, F.lit("\n")), F.left(col, F.length(col) - 1)).otherwise(col)
    return F.when(col.rlike(rf"[{RARE_BREAKS}]"), unified).otherwise(shorter)


def nonblank_lines(col: Column) -> Column:
    """Number of lines that hold more than whitespace.

    The first visible character of a line takes the rest of that line with it,
    so each such line is one match. Each match becomes one mark; what is no mark
    goes, so no array of lines is built.
    """
    marked = F.regexp_replace(F.replace(col, F.lit("\u0001"), F.lit("x")), rf"{NOT_BLANK}[^{BREAK_CHARS}]*", "\u0001")
    return F.length(marked) - F.length(F.replace(marked, F.lit("\u0001"), F.lit("")))


def newline_count(col: Column) -> Column:
    return F.length(col) - F.length(F.replace(col, F.lit("\n"), F.lit("")))


def default_end_line(start: Column, end: Column, code: Column) -> Column:
    """The parser's end line, or the start plus the line feeds in the text."""
    return F.coalesce(end, start + newline_count(code))


def signature(name: Column, is_async: Column) -> Column:
    return F.concat(F.when(is_async, "async ").otherwise(""), F.lit("def "), name, F.lit("(...)"))


def repo_url(name: Column) -> Column:
    return F.concat(F.lit(REPO_URL_PREFIX), name)


def local_repo_name(url: Column) -> Column:
    """Text after the last slash, ``.git`` removed wherever it stands."""
    return F.replace(F.element_at(F.split(url, "/", -1), -1), F.lit(".git"), F.lit(""))


def repo_from_path(path: Column) -> Column:
    return F.element_at(F.split(path, "/", -1), 1)


def relative_path(path: Column) -> Column:
    """The path inside the repository: all parts but the first."""
    parts = F.split(path, "/", -1)
    return F.array_join(F.slice(parts, F.lit(2), F.size(parts)), "/")


def append_mask(col: Column) -> Column:
    return F.concat(col, F.lit(" " + MASK))


def to_numeric(col: Column) -> Column:
    """A number, or 0 where the value is missing or is no number."""
    value = col.try_cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value)


def confidence(score: Column) -> Column:
    return F.exp(score) / (F.exp(score) + F.lit(1e-8)) * 100


def same_stripped(left: Column, right: Column) -> Column:
    """Equality after trimming both; false where either is missing."""
    return F.coalesce(strip(left) == strip(right), F.lit(False))


def require_columns(df, names) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
