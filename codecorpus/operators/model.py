"""A count-based statement predictor, in place of a trained network.

It lets prediction and scoring run on Spark without weights. Contexts are the
lines next to the hidden statement; a longer context is preferred.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from codecorpus.functions.text import IF_MASK, code_tokens, unify_breaks
from codecorpus.operators.lookup import lookup_join
from codecorpus.session import Staging

# Fixed value: a name or number, or one other visible character.
TARGET_TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ ]"
START = "<s>"
BEAMS = 10


def context(df: DataFrame, text: str = "input_text", mask: str = IF_MASK) -> DataFrame:
    """Adds ``prev_line, next_line`` around the hidden statement, '' at the ends.

    Whitespace runs count as one space. Only the lines next to the mask are cut
    out; the rest of the text is not split.
    """
    df = df.withColumn("_text", unify_breaks(F.col(text)))
    before = F.substring_index("_text", mask, 1)
    df = df.withColumn("_before", F.when(F.contains("_text", F.lit(mask)), before))
    df = df.withColumn("_after", F.col("_text").substr(F.length("_before") + len(mask) + 1, F.length("_text")))
    prev_line = F.substring_index(F.substring_index("_before", "\n", -2), "\n", 1)
    next_line = F.substring_index(F.substring_index("_after", "\n", 2), "\n", -1)
    lines = {
        "prev_line": F.when(F.contains("_before", F.lit("\n")), code_tokens(prev_line)).otherwise(""),
        "next_line": F.when(F.contains("_after", F.lit("\n")), code_tokens(next_line)).otherwise(""),
    }
    return df.withColumns(lines).drop("_text", "_before", "_after")


def fit_statement_model(train: DataFrame, text: str = "input_text", target: str = "target_text") -> DataFrame:
    """``level, prev_line, next_line, target, n``.

    Level 0 knows both lines, level 1 the line before, level 2 neither. One scan
    and one aggregation give all three.
    """
    keys = ["prev_line", "next_line", "target"]
    rows = context(train, text).select("prev_line", "next_line", F.col(target).alias("target"))
    sets = [keys, ["prev_line", "target"], ["target"]]
    counted = rows.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(
        F.grouping("prev_line").cast("int").alias("_no_prev"),
        F.grouping("next_line").cast("int").alias("_no_next"),
        F.count("target").alias("n"),
    )
    # Rows without a target count 0; only this filter stays above the aggregation.
    counted = counted.filter("n > 0")
    return counted.select((F.col("_no_prev") + F.col("_no_next")).alias("level"), *keys, "n")


def leading_candidates(model: DataFrame, k: int = BEAMS) -> DataFrame:
    """The k most frequent targets of each context, in a list.

    The rank limit is applied before the shuffle too: the context that all rows
    share sends k rows per task.
    """
    window = Window.partitionBy("level", "prev_line", "next_line").orderBy(F.desc("n"), "target")
    ranked = model.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return ranked.groupBy("level", "prev_line", "next_line").agg(
        F.sort_array(F.collect_list(F.struct("rank", "target", "n"))).alias("candidates")
    )


def predict_statements(
    model: DataFrame, df: DataFrame, k: int = BEAMS, text: str = "input_text", broadcast_rows: int | None = None
) -> DataFrame:
    """Adds ``level`` and ``candidates`` (best first) from the longest known context."""
    size = {"staged": True} if broadcast_rows is None else {"staged": True, "broadcast_rows": broadcast_rows}
    # One aggregation serves the three levels.
    lists = Staging(df.sparkSession).put(leading_candidates(model, k), "candidates")
    both = lists.filter("level = 0").select("prev_line", "next_line", F.col("candidates").alias("_both"))
    before = lists.filter("level = 1").select("prev_line", F.col("candidates").alias("_before"))
    anywhere = lists.filter("level = 2").select("candidates").scalar()
    rows = lookup_join(context(df, text), both, ["prev_line", "next_line"], **size)
    rows = lookup_join(rows, before, ["prev_line"], **size)
    level = F.when(F.col("_both").isNotNull(), 0).when(F.col("_before").isNotNull(), 1).otherwise(2)
    return rows.withColumns({"level": level, "candidates": F.coalesce("_both", "_before", anywhere)}).drop(
        "_both", "_before", "prev_line", "next_line"
    )


def best_prediction(predicted: DataFrame) -> DataFrame:
    """``predicted_if`` from the first candidate."""
    return predicted.withColumn("predicted_if", F.col("candidates")[0]["target"]).drop("candidates", "level")


def candidate_rows(predicted: DataFrame) -> DataFrame:
    """One row per candidate: ``rank, predicted_if, n``."""
    return (
        predicted.withColumn("_c", F.explode("candidates"))
        .withColumns({"rank": F.col("_c.rank"), "predicted_if": F.col("_c.target"), "n": F.col("_c.n")})
        .drop("_c", "candidates")
    )


# --- token probabilities ------------------------------------------------------------


def target_tokens(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(TARGET_TOKEN), F.lit(0))


def _bigrams(df: DataFrame, target: str, *keep: str) -> DataFrame:
    """``prev, cur`` per token. Rows without tokens explode to nothing, so no
    filter is needed that would compute the target once more further down."""
    tokens = target_tokens(F.col(target))
    before = F.slice(F.concat(F.array(F.lit(START)), tokens), F.lit(1), F.size(tokens))
    pairs = F.arrays_zip(before.alias("prev"), tokens.alias("cur"))
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.prev", "_p.cur")


def fit_token_counts(train: DataFrame, target: str = "target_text") -> DataFrame:
    """``prev, cur, n``: how often a token follows another in the targets."""
    return _bigrams(train, target).groupBy("prev", "cur").agg(F.count("*").alias("n"))


def token_logp(
    counts: DataFrame, df: DataFrame, target: str = "target_text", broadcast_rows: int | None = None
) -> DataFrame:
    """``target, prev, cur, logp`` per token of each distinct target.

    Add-one smoothing: (c(prev, cur) + 1) / (c(prev) + V), V distinct tokens.
    """
    size = {} if broadcast_rows is None else {"broadcast_rows": broadcast_rows}
    counts = Staging(df.sparkSession).put(counts, "bigrams")
    distinct = df.select(F.col(target).alias("target")).distinct()
    tokens = _bigrams(distinct, "target", "target")
    before = counts.groupBy("prev").agg(F.sum("n").alias("n_prev"))
    types = counts.agg(F.countDistinct("cur").alias("v")).scalar()
    rows = lookup_join(lookup_join(tokens, counts, ["prev", "cur"], staged=True, **size), before, ["prev"], **size)
    p = (F.coalesce("n", F.lit(0)) + 1) / (F.coalesce("n_prev", F.lit(0)) + types)
    return rows.select("target", "prev", "cur", F.log(p).alias("logp"))


def perplexity(logps: DataFrame, key: str = "target") -> DataFrame:
    """``exp(-mean log-probability)`` per key."""
    return logps.groupBy(key).agg(F.exp(-F.avg("logp")).alias("perplexity"))


def attach_perplexity(
    counts: DataFrame, df: DataFrame, target: str = "target_text", broadcast_rows: int | None = None
) -> DataFrame:
    """Adds ``perplexity``; null where there is no target. Each text is scored once."""
    size = {} if broadcast_rows is None else {"broadcast_rows": broadcast_rows}
    scored = perplexity(token_logp(counts, df, target, broadcast_rows)).withColumnRenamed("target", target)
    return lookup_join(df, scored, [target], **size)
