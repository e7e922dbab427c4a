"""Toxicity by a chain of linear classifiers.

The categories are predicted one after another. The model of a category sees the
text's features and the probabilities of the categories before it. For training,
those probabilities are out-of-fold: predicted by models that have not seen the row,
as they will be for new texts.

Features are words in lower case and their first letters, each as present or absent.
The models are fitted on a bounded sample of labelled rows; only features that are
significantly bound to a label there are used, so that long texts gather no noise.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codecorpus.llm.common import Staging, bounded_sample, fresh, release_memory

#: Labelled rows that the chain is fitted on, at most, for each value of the last label.
SAMPLE = 6000
FOLDS = 5
PREFIXES = (3, 4, 5, 6)
#: A feature's standard score in the comparison of labelled and other texts.
LEAST_Z = 4.5
MAX_FEATURES = 256
RIDGE = 0.1
#: The cutoff is where this share of the clean training rows would be rejected, and 0.5 at most.
FALSE_SHARE = 0.001
WORD = re.compile(r"\w+")

#: Words that split the labelled texts into kinds. A kind is a weak label: toxic, and one of the words.
KINDS = {
    "insult": ("idiot", "moron", "loser", "clown", "scum"),
    "contempt": ("stupid", "pathetic", "worthless", "disgusting", "trash"),
}
CHAIN = [*KINDS, "toxic"]


def features_of(text: str | None) -> set[str]:
    """Words, and prefixes marked by a ``*``."""
    words = set(WORD.findall((text or "").lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in PREFIXES))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> np.ndarray:
    """Weights (the last is the intercept) by Newton's method with a ridge penalty."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = sigmoid(x @ w)
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w


def select_features(rows: DataFrame, least_z: float = LEAST_Z, most: int = MAX_FEATURES) -> list[str]:
    """``rows``: ``text`` and a 0/1 ``label``. The features whose share among label 1 differs from that among
    label 0 by ``least_z`` standard errors, most significant first; those in fewer than three texts are left out."""

    @F.pandas_udf("array<string>")
    def of(texts: pd.Series) -> pd.Series:
        found = pd.Series([sorted(features_of(t)) for t in texts], dtype=object)
        release_memory()
        return found

    ones, n = (x or 0 for x in rows.agg(F.sum("label"), F.count("*")).first())
    counts = rows.select("label", F.explode(of(F.col("text"))).alias("feature")).groupBy("feature").agg(
        F.sum("label").alias("one"), F.count("*").alias("all"))
    n1, n2 = max(1, ones), max(1, n - ones)
    share = F.col("all") / (n1 + n2)
    z = F.abs(F.col("one") / n1 - (F.col("all") - F.col("one")) / n2) / F.sqrt(F.greatest(share * (1 - share) * (1 / n1 + 1 / n2), F.lit(1e-24)))
    found = counts.withColumn("z", z).filter((F.col("all") >= 3) & (F.col("z") >= least_z))
    return [r.feature for r in found.orderBy(F.desc("z"), "feature").limit(most).collect()]


@dataclass(frozen=True)
class Chain:
    """``weights``: for each category those of the features, of the probabilities before it, and the intercept."""

    categories: list[str]
    features: list[str]
    weights: list[np.ndarray]
    threshold: float = 0.5

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text, a column for each category."""
        place = {f: k for k, f in enumerate(self.features)}
        found = np.zeros((len(texts), len(self.categories)))
        for row, text in enumerate(texts):
            at = [place[f] for f in features_of(text) if f in place]
            for c, w in enumerate(self.weights):
                found[row, c] = w[at].sum() + w[len(place) : len(place) + c] @ found[row, :c] + w[-1]
                found[row, c] = sigmoid(found[row, c])
        return found

    def predict(self, text: Column) -> Column:
        """A struct with a probability for each category, and ``rejected``, by that of the last one."""
        fields = ", ".join(f"{c} double" for c in self.categories)

        @F.pandas_udf(f"{fields}, rejected boolean")
        def of(texts: pd.Series) -> pd.DataFrame:
            found = pd.DataFrame(self.probabilities(texts.tolist()), columns=self.categories)
            release_memory()
            return found.assign(rejected=found[self.categories[-1]] >= self.threshold)

        return of(text)


def fit_chain(x: np.ndarray, labels: np.ndarray, folds: np.ndarray, categories: list[str], names: list[str]) -> Chain:
    """``x``: 0/1, a row for each text, a column for each feature of ``names``. ``labels``: a column for each
    category. ``folds``: each row's fold."""
    before = np.zeros((len(x), 0))
    weights = []
    for c in range(len(categories)):
        seen, y = np.column_stack((x, before)), labels[:, c].astype(float)
        weights.append(fit_logistic(seen, y))
        outside = np.zeros(len(y))
        for fold in np.unique(folds):
            there = folds == fold
            # a single fold leaves nothing to train on
            w = weights[-1] if there.all() else fit_logistic(seen[~there], y[~there])
            outside[there] = sigmoid(seen[there] @ w[:-1] + w[-1])
        before = np.column_stack((before, outside))
    if not labels[:, -1].any():
        return Chain(categories, names, weights, np.inf)  # nothing was ever called toxic
    clean = before[labels[:, -1] == 0, -1]
    threshold = min(0.5, float(np.quantile(clean, 1 - FALSE_SHARE)) + 1e-9) if len(clean) else 0.5
    return Chain(categories, names, weights, max(threshold, 0.05))


def labelled_kinds(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``doc_id, text, toxic`` and a 0/1 column for each of ``KINDS``; of documents with a label alone."""
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}_]+")
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    kinds = {k: (F.arrays_overlap(words, F.array(*map(F.lit, v))) & (F.col("toxic") == 1)).cast("int") for k, v in KINDS.items()}
    return docs.select("doc_id", "text").join(known, "doc_id").withColumns(kinds)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """A chain fitted on at most ``sample`` rows of each value of ``labels.toxic``.

    Features are counted and looked up in tasks; the driver gets the places of the chosen ones in each row.
    """
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = bounded_sample(known, "toxic", sample, "doc_id")
    rows = labelled_kinds(docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi"), chosen)
    rows = Staging(docs.sparkSession).put(rows, "sample").repartition("doc_id")
    names = select_features(rows.select("text", F.greatest(*CHAIN).alias("label")))
    place = {f: k for k, f in enumerate(names)}

    @F.pandas_udf("array<int>")
    def places(texts: pd.Series) -> pd.Series:
        found = pd.Series([np.array(sorted(place[f] for f in features_of(t) if f in place), np.int32) for t in texts], dtype=object)
        release_memory()
        return found

    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold")
    got = rows.select("doc_id", fold, *CHAIN, places(F.col("text")).alias("at")).toPandas().sort_values("doc_id", kind="stable")
    x = np.zeros((len(got), len(names)))
    for row, at in enumerate(got["at"]):
        x[row, at] = 1
    return fit_chain(x, got[CHAIN].to_numpy(), got["fold"].to_numpy(), CHAIN, names)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, a probability for each category, ``rejected``.

    A null or empty text has no features and the models' base rates. Without labels nothing is rejected.
    """
    found = docs.select("doc_id", train(docs, labels).predict(F.col("text")).alias("x"))
    return found.select("doc_id", *(F.col(f"x.{c}") for c in CHAIN), "x.rejected")


def acceptable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns."""
    x = fresh(docs.columns, "__x")
    return docs.withColumn(x, train(docs, labels).predict(F.col("text"))).filter(~F.col(x).rejected).drop(x)
