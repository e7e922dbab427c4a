"""Hidden statements and hidden tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from codecorpus.functions.draws import below, choose, digest, draw
from codecorpus.functions.text import IF_MASK, STATEMENT, at_line_start, lstrip, split_lines, strip, unify_breaks

UNSCORED = -100
MASK_SHARE = 0.15


def has_statement(code: Column, statement: str = STATEMENT) -> Column:
    return unify_breaks(code).rlike(at_line_start(statement))


def find_statements(code: Column, statement: str = STATEMENT) -> Column:
    """``array<struct<text, line>>``: one match per line at most, lines from 0."""
    pattern = at_line_start(statement)
    hits = F.transform(
        split_lines(code),
        lambda line, i: F.struct(F.regexp_extract(line, pattern, 1).alias("text"), i.alias("line")),
    )
    return F.filter(hits, lambda hit: hit["text"] != "")


def statement_table(df: DataFrame, code: str = "original_code", statement: str = STATEMENT) -> DataFrame:
    """One row per match, with ``statement`` and ``line_index``."""
    return (
        df.withColumn("_hit", F.explode(find_statements(F.col(code), statement)))
        .withColumns({"statement": F.col("_hit.text"), "line_index": F.col("_hit.line")})
        .drop("_hit")
    )


def mask_statement(
    df: DataFrame,
    key: str,
    code: str = "original_code",
    seed: int = 42,
    on_missing: str = "drop",
    statement: str = STATEMENT,
    mask: str = IF_MASK,
) -> DataFrame:
    """Hide one statement per text: adds ``input_text, target_text, has_if``.

    The draw depends on the seed and the row's key. Rows without a statement are
    dropped, or with ``keep`` pass through with a null target; so do rows without
    code. The text is cut at its statements in one regex pass each for matches
    and gaps; the pieces before and after the chosen match are joined again.
    """
    if on_missing not in ("drop", "keep"):
        raise ValueError("on_missing must be 'drop' or 'keep'")
    pattern = at_line_start(statement)
    df = df.withColumn("_text", unify_breaks(F.col(code)))
    df = df.withColumns(
        {"_found": F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)), "_gaps": F.split("_text", pattern, -1)}
    )
    chosen = choose(seed, F.col(key), F.size("_found"))
    if on_missing == "drop":
        # A filter would be pushed below and search each text once more.
        chosen = F.explode(F.when(F.size("_found") > 0, F.array(chosen)))
    df = df.withColumn("_at", chosen)
    df = df.withColumn("_match", F.get("_found", F.col("_at")))
    df = df.withColumn("target_text", strip(F.col("_match")))
    indent = F.col("_match").substr(F.lit(1), F.length("_match") - F.length(lstrip(F.col("_match"))))
    at, count = F.col("_at"), F.size("_found")
    rest = count - at - 1

    def joined(left: Column, right: Column) -> Column:
        return F.concat(left, right)

    before = F.zip_with(F.slice("_gaps", F.lit(1), at), F.slice("_found", F.lit(1), at), joined)
    after = F.zip_with(F.slice("_found", at + 2, rest), F.slice("_gaps", at + 3, rest), joined)
    masked = F.concat(
        F.array_join(before, ""), F.get("_gaps", at), indent, F.lit(mask), F.get("_gaps", at + 1), F.array_join(after, "")
    )
    return df.withColumns(
        {"input_text": F.when(at.isNull(), F.col(code)).otherwise(masked), "has_if": at.isNotNull()}
    ).drop("_text", "_found", "_gaps", "_at", "_match")


def skipped_no_match(df: DataFrame, code: str = "original_code", statement: str = STATEMENT) -> DataFrame:
    """One row: texts with, without a statement, and rows without text."""
    found = has_statement(F.col(code), statement)
    return df.agg(
        F.count_if(found).alias("with_statement"),
        F.count_if(~found).alias("skipped_no_match"),
        F.count_if(F.col(code).isNull()).alias("missing_code"),
    )


def mask_tokens(
    df: DataFrame,
    key: str,
    ids: str = "input_ids",
    vocab_size: int = 40_000,
    mask_id: int = 4,
    special_ids: tuple[int, ...] = (0, 1, 2, 3, 4),
    probability: float = MASK_SHARE,
    seed: int = 42,
) -> DataFrame:
    """Hide a share of the tokens; adds ``labels`` and replaces the ids.

    Of the positions drawn, 80 % become the mask, 10 % a random id and 10 % stay.
    A label holds the true id there and -100 elsewhere. One digest per position
    gives the three draws it needs. Special ids are never drawn; the statement
    mask is an ordinary token here, as the tokenizer was not told otherwise.
    """
    special = F.array(*(F.lit(i) for i in special_ids))

    def drawn(token: Column, i: Column) -> Column:
        hexes = F.when(~F.array_contains(special, token), digest(seed, F.col(key), i))
        return F.struct(token.alias("id"), hexes.alias("hex"))

    def hide(d: Column) -> Column:
        token, hexes = d["id"], d["hex"]
        other = F.pmod(draw(hexes, 2), F.lit(vocab_size)).cast("int")
        shown = F.when(below(hexes, 0.8, 1), F.lit(mask_id)).when(below(hexes, 0.9, 1), other).otherwise(token)
        chosen = hexes.isNotNull() & below(hexes, probability)
        return F.when(chosen, F.struct(shown.alias("id"), token.alias("label"))).otherwise(
            F.struct(token.alias("id"), F.lit(UNSCORED).alias("label"))
        )

    df = df.withColumn("_masked", F.transform(F.transform(ids, drawn), hide))
    return df.withColumns({"labels": F.col("_masked.label"), ids: F.col("_masked.id")}).drop("_masked")
