"""Text quality by positive-unlabelled learning.

Trusted good texts and unlabelled web texts are compared; no bad labels are used.

1. The share of good texts among the unlabelled ones (the class prior) is estimated:
   a plain classifier of trusted against unlabelled orders the texts; in any top part of
   the order the share of unlabelled over the share of trusted texts is at least the
   prior, and equals it where no bad text reaches. The least such ratio is taken.
2. A linear model minimises the non-negative unbiased risk: the prior times the loss of
   the trusted texts as good, plus the loss of the unlabelled as bad less the prior times
   that of the trusted as bad, the latter difference kept from falling below zero.

The features are statistics of the whole text: kinds of characters, repeats, lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codecorpus.llm.common import bounded_sample, held_out

#: Trusted and unlabelled texts that the model is fitted on, at most, of each.
SAMPLE = 8000
ROUNDS = 400
RATE = 0.05
RIDGE = 1e-3
GOOD = 0.7

#: Kinds of bytes: lower case, upper case, digits, white space, plain punctuation, other ASCII, all others.
KINDS = 7
_kind = np.full(256, 6, np.uint8)
_kind[:128] = 5
for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\r", ".,;:'\"?()-")):
    _kind[list(chars.encode())] = k

FEATURES = [
    "log_words", "upper", "digits", "white", "punctuation", "symbols", "other", "exclamations", "word_length", "longest_word",
    "distinct_words", "repeated_next", "line_words", "repeated_lines", "symbol_words",
]


def features_of(text: bytes | None) -> list[float]:
    """The statistics named by ``FEATURES``; zeros without words."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    counts = np.bincount(_kind[np.frombuffer(text, np.uint8)], minlength=KINDS) / chars
    lengths = list(map(len, words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = sum(map(bytes.__eq__, words, words[1:])) / max(1, n - 1)
    symbols = sum(w[-1] in b"*#$&%@|~^<>{}[]\\/_=+" for w in words) / n
    return [
        np.log1p(n), *counts[1:], text.count(b"!") / n, min(sum(lengths) / n, 50), np.log1p(max(lengths)), len(set(words)) / n,
        repeated, np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines), symbols,
    ]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def descend(gradient, size: int, rounds: int = ROUNDS, rate: float = RATE) -> np.ndarray:
    """Adam from zero with full gradients."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for k in range(1, rounds + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return w


def class_prior(good: np.ndarray, unlabelled: np.ndarray, least_share: float = 0.2) -> float:
    """The share of good rows among ``unlabelled``, from scores: the least ratio of the shares above a threshold."""
    cuts = np.quantile(good, np.linspace(0, 1 - least_share, 50))
    above = lambda s: np.array([(s >= c).mean() for c in cuts])
    margin = np.sqrt(1 / len(unlabelled))
    return float(np.clip(((above(unlabelled) + margin) / above(good)).min(), 0.05, 0.99))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.scale, -10, 10)
        return np.column_stack((x, np.ones(len(x))))

    def score(self, text: Column) -> Column:
        """The probability that a text is good."""

        @F.pandas_udf("double")
        def of(texts: pd.Series) -> pd.Series:
            rows = np.array([features_of(t) for t in texts], float).reshape(-1, len(FEATURES))
            return pd.Series(sigmoid(self.inputs(rows) @ self.weights))

        return of(text.cast("binary"))


def fit(good: np.ndarray, unlabelled: np.ndarray) -> Model:
    """A model from rows of features."""
    if not len(good) or not len(unlabelled):
        return Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES) + 1), 0.5)
    both = np.concatenate((good, unlabelled))
    # scaled by the good texts: what is rare among them stands out
    start = Model(both.mean(axis=0), np.maximum(good.std(axis=0), 0.02), np.zeros(len(FEATURES) + 1), 0.5)
    p, u = start.inputs(good), start.inputs(unlabelled)
    shrink = np.append(np.full(len(FEATURES), RIDGE), 0)

    def plain(w: np.ndarray) -> np.ndarray:
        return (p.T @ (sigmoid(p @ w) - 1)) / len(p) + u.T @ sigmoid(u @ w) / len(u) + shrink * w

    w = descend(plain, len(shrink))
    prior = class_prior(p @ w, u @ w)

    def risk(w: np.ndarray) -> np.ndarray:
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        as_bad = np.logaddexp(0, u @ w).mean() - prior * np.logaddexp(0, p @ w).mean()
        bad = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        good_part = prior * (p.T @ (sp - 1)) / len(p)
        return (good_part + bad if as_bad >= 0 else -bad) + shrink * w

    return Model(start.mean, start.scale, descend(risk, len(shrink)), prior)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """From texts labelled good, and texts without any label, that are not held out."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = docs.filter(~held_out(F.col("doc_id"), 4, 2)).select("doc_id").distinct().join(known, "doc_id", "left")
    group = F.when(F.col("quality").isNull(), "unlabelled").when(F.col("quality") == 1, "good")
    chosen = bounded_sample(ids.select("doc_id", group.alias("part")).filter("part is not null"), "part", sample, "doc_id")

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([list(map(float, features_of(t))) for t in texts])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "part", measured(F.col("text").cast("binary")).alias("x"))
    got = rows.toPandas().sort_values("doc_id")
    part = lambda name: np.array(got["x"][got["part"] == name].tolist(), float).reshape(-1, len(FEATURES))
    return fit(part("good"), part("unlabelled"))


def quality(docs: DataFrame, labels: DataFrame, good: float = GOOD) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, held_out, score, predicted``. A text without words is judged by zeros;
    without any labels all scores are 0.5."""
    found = docs.select("doc_id", train(docs, labels).score(F.col("text")).alias("score"))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= good).cast("int").alias("predicted"))
