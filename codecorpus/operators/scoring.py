"""Predictions by a user's model, and scores per row and in total."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from codecorpus.functions.similarity import similarity
from codecorpus.functions.text import same_stripped

BATCH_SIZE = 16


def score_batches(
    df: DataFrame, make_predictor: Callable[[], Callable[[list[str]], list[tuple[str, float]]]], key: str = "row_id",
    text: str = "input_text", batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """``key, predicted_if, score`` from a user's predictor.

    The predictor is built once per task and called with ``batch_size`` texts at
    most; it returns a text and a score for each.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = make_predictor()
        for frame in frames:
            results: list[tuple[str, float]] = []
            for start in range(0, len(frame), batch_size):
                batch = frame[text].iloc[start : start + batch_size].tolist()
                answers = predict(batch)
                if len(answers) != len(batch):
                    raise ValueError("the predictor must give one answer per text")
                results.extend(answers)
            yield pd.DataFrame(
                {key: frame[key], "predicted_if": [r[0] for r in results], "score": [float(r[1]) for r in results]}
            )

    rows = df.select(key, text)
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInPandas(run, f"`{key}` {kind}, predicted_if string, score double")


def attach_predictions(df: DataFrame, predictions: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows with their predictions; keys are unique on both sides."""
    return df.join(predictions, key, "left")


def score_rows(df: DataFrame, stripped: bool = True, target: str = "target_text", predicted: str = "predicted_if") -> DataFrame:
    """Adds ``prediction_score`` and ``is_correct``."""
    return df.withColumns(
        {
            "prediction_score": similarity(F.col(predicted), F.col(target), stripped),
            "is_correct": same_stripped(F.col(predicted), F.col(target)),
        }
    )


def accuracy(correct: str = "is_correct"):
    return F.avg(F.col(correct).cast("int")) * 100


def metrics(scored: DataFrame) -> DataFrame:
    """One row: size, accuracy, mean similarity, mean perplexity where known."""
    return scored.agg(
        F.count("*").alias("rows"),
        accuracy().alias("accuracy"),
        F.avg("prediction_score").alias("mean_similarity"),
        F.avg("perplexity").alias("mean_perplexity"),
    )
