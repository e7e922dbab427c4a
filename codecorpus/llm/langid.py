"""Language of a text by nearest centroids of TF-IDF vectors of character trigrams.

Trigrams of letters (runs of anything else count as one space) are hashed into
``DIMENSIONS`` places; a vector is (1 + ln count) x idf, of length one. Document
frequencies come from all training documents. The training vectors of each language,
from a bounded sample, are clustered by spherical k-means, one task per language. A
text gets the language of the centroid with the greatest cosine. It is rejected if
that cosine is below the centroid's cutoff, a part of what its own members reach.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codecorpus.llm.common import bounded_sample, fresh, held_out, release_memory

DIMENSIONS = 1 << 12
#: Training documents of each language that the centroids are fitted on, at most.
SAMPLE = 1500
CENTROIDS = 4
ROUNDS = 10
#: A centroid rejects below this part of the cosine that all but 0.1 % of its members reach.
CUTOFF = 0.25
UNKNOWN = "und"
PIECE = 1 << 20
BATCH = 256


@functools.cache
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(x).isalpha() for x in range(0x110000)), bool, 0x110000)


def trigram_counts(text: str | None) -> np.ndarray | None:
    """How often each hashed trigram occurs in the whole text; None without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32)
    keep = letter | np.concatenate(([False], letter[:-1]))
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint32)
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(codes) - 2, PIECE):
        c = codes[at : at + PIECE + 2]
        mixed = (c[:-2] * np.uint32(0x9E3779B1)) ^ (c[1:-1] * np.uint32(0x85EBCA77)) ^ (c[2:] * np.uint32(0xC2B2AE3D))
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x27D4EB2F)
        counts += np.bincount(mixed >> np.uint32(20), minlength=DIMENSIONS)
    return counts


def vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, one row per text, and whether a text has letters."""
    rows = np.zeros((len(texts), DIMENSIONS), np.float32)
    known = np.zeros(len(texts), bool)
    for k, text in enumerate(texts):
        counts = trigram_counts(text)
        if counts is not None:
            there = np.flatnonzero(counts)
            value = (1 + np.log(counts[there])) * idf[there]
            rows[k, there] = value / np.sqrt((value * value).sum())
            known[k] = True
    return rows, known


def cluster(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids by spherical k-means, and each row's cosine to its own. The first centroid is the mean;
    each further one starts at the row farthest from those before it."""
    mean = rows.mean(axis=0)
    centres = [mean / max(np.linalg.norm(mean), 1e-12)]
    while len(centres) < min(k, len(rows)):
        centres.append(rows[np.argmin((rows @ np.array(centres).T).max(axis=1))])
    centres = np.array(centres)
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                total = rows[own == c].sum(axis=0)
                centres[c] = total / max(np.linalg.norm(total), 1e-12)
    cosine = rows @ centres.T
    return centres, np.column_stack((cosine.argmax(axis=1), cosine.max(axis=1)))


def document_frequencies(docs: DataFrame, text_column: str) -> tuple[np.ndarray, int]:
    """In how many texts each hashed trigram occurs, over all rows, and how many texts have letters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            for text in batch["text"]:
                counts = trigram_counts(text.as_py())
                if counts is not None:
                    found[:-1] += counts > 0
                    found[-1] += 1
        release_memory()
        yield pa.record_batch({"place": np.arange(DIMENSIONS + 1), "n": found})

    sums = docs.select(F.col(text_column).alias("text")).mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    total = np.zeros(DIMENSIONS + 1, np.int64)
    for row in sums.collect():  # a row for each place
        total[row.place] = row.n
    return total[:-1], int(total[-1])


@dataclass(frozen=True)
class Model:
    languages: list[str]
    centroids: np.ndarray
    cutoffs: np.ndarray
    idf: np.ndarray

    def predict(self, text: Column) -> Column:
        """``lang``, ``score`` (the cosine) and ``rejected`` of a text. Without letters: ``und``, 0, rejected."""

        @F.pandas_udf("lang string, score double, rejected boolean")
        def of(texts: pd.Series) -> pd.DataFrame:
            parts = []
            for at in range(0, len(texts), BATCH):
                rows, known = vectors(texts.iloc[at : at + BATCH].tolist(), self.idf)
                if not self.languages:
                    known[:] = False
                cosine = rows @ self.centroids.T if self.languages else np.zeros((len(rows), 1))
                best = cosine.argmax(axis=1)
                score = np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0.0).astype(float)
                cutoff = self.cutoffs[best] if self.languages else np.zeros(len(rows))
                names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                parts.append(pd.DataFrame({"lang": names, "score": score, "rejected": ~known | (score < cutoff)}))
            release_memory()
            return pd.concat(parts) if parts else pd.DataFrame({"lang": [], "score": [], "rejected": []})

        return of(text)


def fit(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id",
        sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """A model of the languages in ``docs``. Rows without a language, or without letters, teach nothing."""
    rows = docs.filter(F.col(lang_column).isNotNull()).select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
    df, n = document_frequencies(rows, "text")
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def fit_one(group: pd.DataFrame) -> pd.DataFrame:
        found, known = vectors(group["text"].tolist(), idf)
        if not known.any():
            return pd.DataFrame({"lang": [], "centroid": [], "cutoff": []}, dtype=object)
        centres, own = cluster(found[known], centroids)
        least = [np.quantile(own[own[:, 0] == c, 1], 0.001) if (own[:, 0] == c).any() else 2.0 for c in range(len(centres))]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": centres.astype(float).tolist(), "cutoff": CUTOFF * np.array(least)})

    chosen = bounded_sample(rows, "lang", sample, "doc_id")
    fitted = chosen.groupBy("lang").applyInPandas(fit_one, "lang string, centroid array<double>, cutoff double")
    got = sorted(fitted.collect(), key=lambda r: (r.lang, r.centroid))  # a few rows for each language
    return Model([r.lang for r in got], np.array([r.centroid for r in got], np.float32), np.array([r.cutoff for r in got]), idf)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id"), 5, 0))


def languages(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, held_out, lang_pred, score, rejected``."""
    found = docs.select("doc_id", fit(training_rows(docs)).predict(F.col("text")).alias("x"))
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), F.col("x.lang").alias("lang_pred"), "x.score", "x.rejected")


def recognised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns."""
    x = fresh(docs.columns, "__lang")
    return docs.withColumn(x, fit(training_rows(docs)).predict(F.col("text"))).filter(~F.col(x).rejected).drop(x)
