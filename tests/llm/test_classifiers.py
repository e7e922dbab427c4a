import zlib

import pytest
from pyspark.sql import functions as F

from codecorpus.llm import langid, quality, queries, toxicity

MIDDLE = "/root/testdata/sf0.01"


def held(doc_id, parts, part):
    return zlib.crc32(str(doc_id).encode()) % parts == part


def test_toxicity_catches_toxic_and_keeps_clean(spark):
    bad = ["idiot", "scum", "trash", "zorkoma", "zorkobe"]
    rows = [(i, f"some words of text {i % 17} " + (f"you {bad[i % 5]} there " * 2 if i % 4 == 0 else "are all fine ") + "and more") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 300)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(found[i].rejected == (i % 4 == 0) for i in range(400))
    assert all(0 <= r[c] <= 1 for r in found.values() for c in toxicity.CHAIN)
    assert found[0].insult > 0.5 > found[3].insult
    unseen = spark.createDataFrame([(1, "zorkoxx is new")], "doc_id long, text string")
    chain = toxicity.train(docs, labels)
    assert unseen.select(chain.predict(F.col("text")).alias("x")).first().x.rejected  # known by its first letters


def test_toxicity_of_odd_rows(spark, odd_docs, odd_rows, labels):
    assert toxicity.toxicity(odd_docs, labels).count() == len(odd_rows)
    no_labels = labels.filter("false")
    kept = toxicity.acceptable(odd_docs, no_labels)
    assert kept.count() == len(odd_rows) and kept.columns == odd_docs.columns
    assert toxicity.toxicity(odd_docs.filter("false"), labels).count() == 0


def test_quality_on_held_out_rows(spark):
    found = queries.op7_quality(spark, MIDDLE)
    known = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = found.join(known, "doc_id").filter("held_out and quality is not null").collect()
    assert all(r.held_out == held(r.doc_id, 4, 2) and r.predicted == (r.score >= 0.7) for r in rows)
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95 and sum(g >= 0.7 for g in good) / len(good) > 0.95


def test_quality_of_odd_rows(spark, odd_docs, odd_rows, labels):
    rows = quality.quality(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.quality(odd_docs, labels.filter("false")).collect()} == {0.5}
    assert quality.quality(odd_docs.filter("false"), labels).count() == 0


def test_language_on_held_out_rows(spark):
    found = queries.op10_language(spark, MIDDLE)
    rows = found.join(spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, 5, 0) for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97
    assert sum(r.rejected for r in rows) / len(rows) < 0.005


def test_language_of_odd_rows(spark, odd_docs, odd_rows):
    rows = langid.languages(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    text = {(r[0], r[1]) for r in odd_rows}
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {i for i, t in text if not any(c.isalpha() for c in t or "")}
    kept = langid.recognised(odd_docs)
    assert kept.columns == odd_docs.columns and kept.filter("doc_id in (2, 3, 4, 8)").count() == 0
    assert langid.languages(odd_docs.filter("false")).count() == 0
    assert {r.lang_pred for r in langid.languages(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


@pytest.mark.parametrize("text,counted", [("Ab", 2), ("a1b", 3), ("!!", None), (None, None)])
def test_trigrams(text, counted):
    counts = langid.trigram_counts(text)
    assert (None if counts is None else counts.sum()) == counted
