"""Beam search over token counts: hidden statements decoded token by token.

The next-token model conditions on the previous token and on the line before the
hidden statement. Its probability interpolates the counts in that context with the
bigram counts of all targets (add-one smoothed):
``p(cur | line, prev) = (c(line, prev, cur) + W * p(cur | prev)) / (c(line, prev) + W)``.
Targets end with ``END``. Only the ``k`` likeliest next tokens of each (line, prev) and
of each prev are kept, so a step never expands a hypothesis by more than ``k`` tokens.

What is decoded depends on the line before the hidden statement alone, so each distinct
line is decoded once and its hypotheses are then attached to the rows.

Decoding is a loop of Spark steps over a frontier table (one row per hypothesis):
live hypotheses join the next-token lists of their context (or of their previous
token alone where the context is unknown), grow by one token, and the ``k`` best of
each line by length-normalised log-probability stay, finished ones included. The
frontier is staged each step, so lineage stays short and a lost executor costs one
step. Decoding ends when the ``k`` best of every line are finished or at ``max_tokens``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codecorpus.operators.lookup import BROADCAST_ROWS, fits_broadcast, lookup_join
from codecorpus.operators.model import START, context, target_tokens
from codecorpus.session import Staging

END = "</s>"
BEAMS = 10
#: Tokens of a hypothesis at most, its end included (the reference's output length).
MAX_TOKENS = 64
#: Weight of the bigram probability in a context's counts.
CONTEXT_WEIGHT = 2.0
#: Score: log-probability / tokens ** LENGTH_PENALTY.
LENGTH_PENALTY = 1.0

CANDIDATES = "array<struct<cur:string,logp:double>>"


def _pairs(rows: DataFrame, target: str) -> DataFrame:
    tokens = F.concat(target_tokens(F.col(target)), F.array(F.lit(END)))
    before = F.concat(F.array(F.lit(START)), target_tokens(F.col(target)))
    return rows.select("line", F.explode(F.arrays_zip(before.alias("prev"), tokens.alias("cur"))).alias("p")).select("line", "p.prev", "p.cur")


def fit_next_tokens(train: DataFrame, k: int = BEAMS, text: str = "input_text", target: str = "target_text") -> DataFrame:
    """``line, prev, cands``: the ``k`` likeliest next tokens (``cur, logp``, best first; ties by token).

    ``line`` is the line before the hidden statement, null for the lists of all lines.
    Rows without a target add nothing.
    """
    rows = context(train.filter(F.col(target).isNotNull()), text).select(F.col("prev_line").alias("line"), target)
    pairs = _pairs(rows, target)
    bigram = pairs.groupBy("prev", "cur").agg(F.count("*").alias("n"))
    types = bigram.select("cur").distinct().count()
    bigram = bigram.join(bigram.groupBy("prev").agg(F.sum("n").alias("n_prev")), "prev").withColumn(
        "pg", (F.col("n") + 1) / (F.col("n_prev") + types)
    )
    ctx = pairs.groupBy("line", "prev", "cur").agg(F.count("*").alias("c"))
    ctx = ctx.join(ctx.groupBy("line", "prev").agg(F.sum("c").alias("c_prev")), ["line", "prev"]).join(bigram.select("prev", "cur", "pg"), ["prev", "cur"])
    ctx = ctx.select("line", "prev", "cur", F.log((F.col("c") + CONTEXT_WEIGHT * F.col("pg")) / (F.col("c_prev") + CONTEXT_WEIGHT)).alias("logp"))
    every = bigram.select(F.lit(None).cast("string").alias("line"), "prev", "cur", F.log("pg").alias("logp"))

    def top(scored: DataFrame, keys: list[str]) -> DataFrame:
        # the rank limit runs before the shuffle too, so a frequent context sends k rows per task
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("logp"), "cur"))
        best = scored.withColumn("r", rank).filter(F.col("r") <= k)
        return best.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("r", "cur", "logp"))).alias("c")).select(
            *keys, F.expr("transform(c, x -> named_struct('cur', x.cur, 'logp', x.logp))").alias("cands")
        )

    return top(ctx, ["line", "prev"]).unionByName(top(every, ["line", "prev"]))


def beam_search(
    lists: DataFrame, df: DataFrame, key: str, k: int = BEAMS, max_tokens: int = MAX_TOKENS, text: str = "input_text"
) -> DataFrame:
    """``key, rank, tokens, predicted_if, logp, score``: the ``k`` best hypotheses of each row of ``df``.

    ``tokens`` end with ``END`` where the hypothesis finished; ``predicted_if`` joins the
    others with spaces. Every row gets its line's hypotheses, rows of a repeated or null key
    too. An empty ``df`` or empty ``lists`` give no rows.
    """
    staging = Staging(df.sparkSession)
    # null has a name of its own, so that it can be joined; every other line begins with "="
    named = F.when(F.col("prev_line").isNotNull(), F.concat(F.lit("="), F.col("prev_line"))).otherwise("")
    rows = staging.put(context(df, text).select(key, named.alias("_line")), "beam_rows")
    lists = staging.put(lists, "beam_lists")
    in_context = lists.filter(F.col("line").isNotNull()).select(F.concat(F.lit("="), "line").alias("_line"), F.col("prev").alias("last"), F.col("cands").alias("_c"))
    anywhere = lists.filter(F.col("line").isNull()).select(F.col("prev").alias("last"), F.col("cands").alias("_g"))
    next_of = [_lookup(staging, in_context, ["_line", "last"], "beam_context"), _lookup(staging, anywhere, ["last"], "beam_anywhere")]
    frontier = staging.put(
        rows.select("_line").distinct().select("_line", F.array().cast("array<string>").alias("tokens"), F.lit(START).alias("last"),
                                               F.lit(0.0).alias("logp"), F.lit(False).alias("done")),
        "beam0",
    )
    # scores equal to 12 places tie, whatever order their sums were added in; then the tokens decide
    order = Window.partitionBy("_line").orderBy(F.round("score", 12).desc(), F.array_join("tokens", " "))
    for step in range(max_tokens):
        grown = frontier.filter(~F.col("done"))
        for attach in next_of:
            grown = attach(grown)
        grown = grown.select("*", F.explode(F.coalesce("_c", "_g", F.array().cast(CANDIDATES))).alias("x")).select(
            "_line", F.concat("tokens", F.array("x.cur")).alias("tokens"), F.col("x.cur").alias("last"),
            (F.col("logp") + F.col("x.logp")).alias("logp"), ((F.col("x.cur") == END) | (F.size("tokens") + 1 >= max_tokens)).alias("done"),
        )
        pool = frontier.filter("done").unionByName(grown)
        pool = pool.withColumn("score", F.col("logp") / F.pow(F.greatest(F.size("tokens"), F.lit(1)), LENGTH_PENALTY))
        kept = pool.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("score", "rank")
        frontier = staging.put(kept, f"beam{step % 2 + 1}")
        if frontier.filter(~F.col("done")).isEmpty():
            break
    scored = frontier.withColumn("score", F.col("logp") / F.pow(F.greatest(F.size("tokens"), F.lit(1)), LENGTH_PENALTY))
    best = scored.select("_line", F.struct(F.row_number().over(order).alias("rank"), "tokens", "logp", "score").alias("b"))
    best = staging.put(best.groupBy("_line").agg(F.sort_array(F.collect_list("b")).alias("_beams")), "beams")
    words = F.filter("b.tokens", lambda t: t != END)
    return lookup_join(rows, best, ["_line"], staged=True).select(key, F.explode("_beams").alias("b")).select(
        key, "b.rank", "b.tokens", F.array_join(words, " ").alias("predicted_if"), "b.logp", "b.score"
    )


def _lookup(staging: Staging, table: DataFrame, on: list[str], name: str) -> Callable[[DataFrame], DataFrame]:
    """A function that attaches the lists of ``table`` to a staged frontier.

    A table of a checked size is broadcast, checked once. Of a larger one each step takes only
    the lists that its hypotheses ask for, so the lists of all contexts are never shuffled.
    """
    if fits_broadcast(table, BROADCAST_ROWS):
        return lambda live: live.join(F.broadcast(table), on, "left")

    def attach(live: DataFrame) -> DataFrame:
        asked = staging.put(live.select(*on).distinct(), f"{name}_asked")
        return lookup_join(live, staging.put(table.join(asked, on), f"{name}_near"), on, staged=True)

    return attach
