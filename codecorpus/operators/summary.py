"""The report over scored predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from codecorpus.functions.text import to_numeric
from codecorpus.operators.caps import top

REPORT_COLUMNS = ["target_text", "predicted_if", "prediction_score"]


def masked_rows(df: DataFrame) -> DataFrame:
    """Rows in which a statement was hidden, with a numeric score."""
    return df.withColumn("prediction_score", to_numeric(F.col("prediction_score"))).filter("has_if")


def mean_score(df: DataFrame, score: str = "prediction_score") -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.avg(score).alias("mean_score"))


def worst_predictions(df: DataFrame, k: int = 10, score: str = "prediction_score", key: str = "row_id") -> DataFrame:
    """The k smallest scores; ties keep the order of the rows."""
    return top(df, k, F.asc(score), F.asc(key))


def best_predictions(df: DataFrame, k: int = 10, score: str = "prediction_score", key: str = "row_id") -> DataFrame:
    return top(df, k, F.desc_nulls_last(score), F.asc(key))


def score_histogram(df: DataFrame, score: str = "prediction_score", bins: int = 20) -> DataFrame:
    """``bin, lo, hi, n``: equal bins from the least to the greatest score.

    The last bin is closed. One distinct value gets the range of half a unit on
    either side. Empty bins are left out, as are rows whose score is null or NaN.
    """
    df = df.filter(F.col(score).isNotNull() & ~F.isnan(score))
    ends = df.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).select(
        F.struct(
            F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    ends = ends.scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    at = F.least(F.floor((F.col(score) - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counted = df.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    width = (hi - lo) / bins
    return counted.select(
        "bin", (lo + F.col("bin") * width).alias("lo"), (lo + (F.col("bin") + 1) * width).alias("hi"), "n"
    )


def report(df: DataFrame, k: int = 10, bins: int = 20, key: str = "row_id") -> dict[str, DataFrame]:
    """Mean score, worst and best predictions and the histogram."""
    rows = masked_rows(df)
    return {
        "mean": mean_score(rows),
        "worst": worst_predictions(rows, k, key=key).select(*REPORT_COLUMNS),
        "best": best_predictions(rows, k, key=key).select(*REPORT_COLUMNS),
        "histogram": score_histogram(rows, bins=bins),
    }
