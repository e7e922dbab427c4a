"""A corpus through toxicity, language, near-duplicates, benchmark passages and encoding.

Each stage takes the documents that the one before has kept. A row stays out if it is
toxic, if its language is not recognised, if it is a later copy in its group of
near-duplicates, or if it holds a benchmark passage; what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codecorpus.llm import decontaminate, langid, sentencepieces, simhash, toxicity
from codecorpus.llm.common import Staging, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The chain is trained on the labelled rows of ``docs``."""
    return toxicity.acceptable(docs, table(spark, sf_dir, "labels"))


def drop_unrecognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters or far from every language's centroids go."""
    return langid.recognised(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The SimHash operator with its own contract: four-word shingles, links at four or fewer differing bits.

    The first document of each component stays (least id, null ids last, then text hash).
    """
    return simhash.one_of_each(docs, words=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_of(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unrecognised),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: SQL has no classifiers, no SimHash of XXH64 and no lattice search; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each reads what the one before has written to the shared folder."""
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staging.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
