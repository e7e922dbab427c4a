"""From predictions to reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from codecorpus.functions.text import append_mask, confidence
from codecorpus.operators import masking, model, scoring, summary
from codecorpus.session import Staging


def evaluate(pairs: DataFrame, predictions: DataFrame, counts: DataFrame, key: str = "row_id") -> DataFrame:
    """The test result: pairs with prediction, score, perplexity and correctness."""
    rows = scoring.attach_predictions(pairs.select(key, "input_text", "target_text"), predictions.select(key, "predicted_if"), key)
    return scoring.score_rows(model.attach_perplexity(counts, rows), stripped=True)


def evaluation_metrics(pairs: DataFrame, predictions: DataFrame, counts: DataFrame, key: str = "row_id") -> DataFrame:
    """Evaluate and reduce to one row of totals."""
    return scoring.metrics(evaluate(pairs, predictions, counts, key))


def benchmark(
    df: DataFrame, statements: DataFrame, counts: DataFrame, key: str = "row_id", code: str = "code", seed: int = 42,
) -> DataFrame:
    """Hide a statement in each text, predict it and score it untrimmed.

    Texts without a statement stay, with score 0 and no perplexity. The joins read their rows
    several times (hot keys, distinct targets, the rows themselves), so each step is staged.
    """
    staging = Staging(df.sparkSession)
    masked = staging.put(masking.mask_statement(df.select(key, code), key, code, seed, on_missing="keep"), "masked")
    predicted = staging.put(model.best_prediction(model.predict_statements(statements, masked)), "predicted")
    scored = scoring.score_rows(model.attach_perplexity(counts, predicted), stripped=False)
    return scored.select(
        key, code, "input_text", "target_text", "has_if", "predicted_if", "prediction_score", "perplexity"
    )


def generated_set(df: DataFrame, make_predictor, key: str = "row_id", code: str = "code", batch_size: int = scoring.BATCH_SIZE) -> DataFrame:
    """Predictions for texts with a mask appended, and their confidence."""
    rows = df.select(key, code, append_mask(F.col(code)).alias("input_text"))
    answers = scoring.score_batches(rows, make_predictor, key, batch_size=batch_size)
    return scoring.attach_predictions(df.select(key, code), answers, key).select(
        key, code, "predicted_if", confidence(F.col("score")).alias("confidence")
    )


summarize = summary.report
