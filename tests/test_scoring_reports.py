import difflib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from codecorpus.functions import udf
from codecorpus.functions.similarity import similarity
from codecorpus.operators import model, scoring, summary, training_log
from codecorpus.plans import evaluate
from tests.conftest import plan_of, values

PAIRS = [
    ("if x:", "if x:"), ("", ""), (None, "if x:"), ("if x:", None), (" if a > 1:\n", "if a>1:"), ("abcd", "bcde"),
    ("tide", "diet"), ("diet", "tide"), ("if " + "ab" * 120, "if " + "ba" * 130), ("if x:", "if x:"),
]


@pytest.mark.parametrize("stripped", [True, False])
def test_similarity(spark, stripped):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(PAIRS)], "i int, p string, t string").repartition(3)
    got = [r.s for r in df.select("i", similarity(F.col("p"), F.col("t"), stripped).alias("s")).orderBy("i").collect()]
    for (p, t), s in zip(PAIRS, got):
        if p is None or t is None:
            assert s == 0.0
        else:
            a, b = (p.strip(), t.strip()) if stripped else (p, t)
            assert s == difflib.SequenceMatcher(None, a, b).ratio() * 100


TRAIN = [
    ("y = x\n<if_mask>\n  y = 1", "if x > 1:"), ("y = x\n<if_mask>\n  y = 1", "if x > 1:"), ("y = x\n<if_mask>\n  y = 1", "if x < 1:"),
    ("y = x\n<if_mask>\n  z = 1", "if x:"), ("<if_mask>\n  z", "if z:"), ("<if_mask>", "if x:"), ("no mask", None),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id int, input_text string, target_text string").repartition(3)


@pytest.mark.parametrize("broadcast_rows", [None, 0])
def test_model_and_backoff(spark, broadcast_rows):
    fitted = model.fit_statement_model(frame(spark, TRAIN))
    counts = {(r.level, r.prev_line, r.next_line, r.target): r.n for r in fitted.collect()}
    assert counts[0, "y = x", "y = 1", "if x > 1:"] == 2 and counts[1, "y = x", None, "if x:"] == 1
    assert counts[2, None, None, "if x:"] == 2 and sum(n for k, n in counts.items() if k[0] == 2) == 6
    asked = [("y   =  x\n <if_mask>\n\ty = 1\n", None), ("y = x\n<if_mask>\nother", None), ("q\n<if_mask>", None)]
    got = model.predict_statements(fitted, frame(spark, asked), 2, broadcast_rows=broadcast_rows)
    rows = {r.row_id: (r.level, [c.target for c in r.candidates]) for r in got.collect()}
    assert rows == {
        0: (0, ["if x > 1:", "if x < 1:"]), 1: (1, ["if x > 1:", "if x < 1:"]), 2: (2, ["if x > 1:", "if x:"])
    }
    assert model.candidate_rows(got).count() == 6
    assert {r.predicted_if for r in model.best_prediction(got).collect()} == {"if x > 1:"}


@pytest.mark.parametrize("broadcast_rows", [None, 0])
def test_perplexity(spark, broadcast_rows):
    counts = model.fit_token_counts(frame(spark, TRAIN))
    rows = frame(spark, [("", "if x:"), ("", "if new:"), ("", None), ("", "if x:")])
    got = {r.row_id: r.perplexity for r in model.attach_perplexity(counts, rows, broadcast_rows=broadcast_rows).collect()}
    seen = {(r.prev, r.cur): r.n for r in counts.collect()}
    v = len({c for _, c in seen})

    def ppl(tokens):
        total = 0.0
        for p, c in zip(["<s>", *tokens], tokens):
            total += math.log((seen.get((p, c), 0) + 1) / (sum(n for (q, _), n in seen.items() if q == p) + v))
        return math.exp(-total / len(tokens))

    assert got[2] is None and got[0] == got[3]
    assert got[0] == pytest.approx(ppl(["if", "x", ":"])) and got[1] == pytest.approx(ppl(["if", "new", ":"]))


def test_evaluate_and_benchmark(spark):
    train = frame(spark, TRAIN)
    counts = model.fit_token_counts(train)
    fitted = model.fit_statement_model(train)
    pairs = frame(spark, [("y = x\n<if_mask>\n  y = 1", "if x > 1:"), ("y = x\n<if_mask>\n  y = 1", "if w:")])
    predictions = spark.createDataFrame([(0, " if x > 1: "), (1, "if v:")], "row_id int, predicted_if string")
    rows = {r.row_id: r for r in evaluate.evaluate(pairs, predictions, counts).collect()}
    assert rows[0].is_correct and rows[0].prediction_score == 100 and not rows[1].is_correct
    total = evaluate.evaluation_metrics(pairs, predictions, counts).first()
    assert total.rows == 2 and total.accuracy == 50 and total.mean_similarity == (100 + rows[1].prediction_score) / 2
    code = spark.createDataFrame([(0, "y = x\nif x > 1:\n  y = 1"), (1, "y = 1")], "row_id int, code string")
    got = {r.row_id: r for r in evaluate.benchmark(code, fitted, counts).collect()}
    assert got[0].prediction_score == 100 and got[0].perplexity > 1 and got[0].has_if
    assert (got[1].target_text, got[1].perplexity, got[1].prediction_score, got[1].has_if) == (None, None, 0.0, False)
    assert got[1].input_text == "y = 1"


def test_benchmark_masks_and_predicts_once(spark):
    """The joins read staged rows: neither the mask nor the search for neighbouring lines is computed again."""
    train = frame(spark, TRAIN)
    code = spark.createDataFrame([(k, f"y = x\nif x > {k % 3}:\n  y = 1") for k in range(20)], "row_id int, code string")
    found = evaluate.benchmark(code, model.fit_statement_model(train), model.fit_token_counts(train))
    plan = plan_of(found)
    assert "parquet" in plan and "regexp_extract_all" not in plan and "substring_index" not in plan
    assert found.count() == found.filter("has_if").count() == 20


def test_score_batches_builds_once_per_task(spark):
    def make_predictor():
        calls = []

        def predict(texts):
            calls.append(len(texts))
            return [(t.upper() + str(len(calls)), -1.0) for t in texts]

        return predict

    df = spark.range(40).select(F.col("id").alias("row_id"), F.lit("a").alias("input_text")).coalesce(1)
    got = [r.predicted_if for r in scoring.score_batches(df, make_predictor, batch_size=16).orderBy("row_id").collect()]
    assert got == ["A1"] * 16 + ["A2"] * 16 + ["A3"] * 8
    rows = df.withColumnRenamed("input_text", "code")
    out = evaluate.generated_set(rows, make_predictor)
    assert out.columns == ["row_id", "code", "predicted_if", "confidence"] and out.first().predicted_if.startswith("A <MASK>")


def test_user_functions(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, t string").coalesce(1)
    got = udf.map_batches(df, lambda f: f.assign(n=len(f))[["i", "n"]], "i int, n long", batch_size=1)
    assert values(got, "i", "n") == [(1, 1), (2, 1)]
    assert [r.v for r in df.select(udf.map_values(F.col("t"), lambda t: t * 2, "string").alias("v")).collect()] == ["aa", None]


def scored(spark, scores):
    rows = [(i, f"t{i}", f"p{i}", s, i % 4 != 3) for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, "row_id int, target_text string, predicted_if string, prediction_score string, has_if boolean")


def test_summary(spark):
    scores = ["5", "x", None, "1", "100", "5", "5", "0", "33.3", "5"]
    report = summary.report(scored(spark, scores), k=4)
    used = [float(s) if s and s != "x" else 0.0 for i, s in enumerate(scores) if i % 4 != 3]
    assert report["mean"].first().mean_score == pytest.approx(sum(used) / len(used))
    assert [r.target_text for r in report["worst"].collect()] == ["t1", "t2", "t0", "t5"]
    assert [r.target_text for r in report["best"].collect()] == ["t4", "t8", "t0", "t5"]
    want, edges = np.histogram(used, 20)
    got = {r.bin: r for r in report["histogram"].collect()}
    assert [got[i].n if i in got else 0 for i in range(20)] == want.tolist()
    assert all(got[i].lo == pytest.approx(edges[i]) and got[i].hi == pytest.approx(edges[i + 1]) for i in got)
    same = summary.score_histogram(spark.createDataFrame([(7.0,)] * 3, "prediction_score double")).collect()
    assert [(r.bin, r.lo, r.n) for r in same] == [(10, 7.0, 3)]


def test_training_log(spark):
    rows = [(500, 0.1, 7.0, None), (1000, 0.2, 3.0, 2.0), (1500, 0.3, 4.0, 1.0), (2000, 0.4, None, 1.0)]
    log = spark.createDataFrame(rows, "step bigint, epoch double, loss double, eval_loss double")
    assert tuple(training_log.best_checkpoint(log).first()) == (1500, 1.0, 2000)
    assert tuple(training_log.loss_summary(log).first()) == (3, 7.0, 4.0, 3.0)
    assert values(training_log.loss_by_epoch(log, 5), "bucket", "entries", "mean_loss") == [(0, 1, 7.0), (1, 2, 3.5)]


def test_histogram_leaves_out_nan(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (float("nan"),), (None,)], "prediction_score double")
    assert values(summary.score_histogram(rows, bins=2), "bin", "lo", "hi", "n") == [(0, 0.0, 0.5, 1), (1, 0.5, 1.0, 1)]


def test_short_pairs_are_compared_many_at_a_time(monkeypatch):
    import random

    from codecorpus.functions import similarity

    rng = random.Random(5)
    text = lambda: "".join(rng.choice("abé😀 ") for _ in range(rng.choice([0, 1, 4, 13, 60])))
    pairs = [(text(), text()) for _ in range(300)]
    want = [similarity.matching_length(*p) for p in pairs]

    def one_at_a_time(*_):
        raise AssertionError("a short pair was compared alone")

    monkeypatch.setattr(similarity, "matching_length", one_at_a_time)
    monkeypatch.setattr(similarity, "PAIRS_AT_ONCE", 64)
    assert similarity.matching_lengths(pairs) == want
