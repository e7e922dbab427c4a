"""Document fingerprints by consistent weighted sampling.

A text is a set of words weighted by their counts. For sample i every word draws
r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1) from a hash of the word and i. With weight w

    t = floor(ln w / r + b),   ln a = ln c - r (t - b + 1)

and the word (with its t) of the least ln a is the sample. Two texts draw the same
sample with a probability equal to their generalised Jaccard similarity: the sum of
the lesser weights over the sum of the greater weights. As ln a depends on word, t
and i alone, equal samples are equal values of ln a, so the sample is a plain minimum
and a hash of it goes into the fingerprint.

Everything is built-in expressions. The one shuffle of texts deals the documents out
by ranges of the id (``neighbours``); words are counted and samples taken inside
those parts without another one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codecorpus.llm.common import ascii_lower

SAMPLES = 32
#: Ranges of ids for each shuffle partition.
RANGES = 8
WHITE = " \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)


def _uniform(bits: Column, width: int) -> Column:
    return (bits + 0.5) * 2.0**-width


def _bits(digest: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(digest, at).bitwiseAND(F.lit((1 << width) - 1))


def log_a(word: Column, log_weight: Column, sample: int) -> Column:
    """ln a of a word (given as a ``bigint`` hash) for one sample."""
    first, second = F.xxhash64(word, F.lit(2 * sample)), F.xxhash64(word, F.lit(2 * sample + 1))
    r = -F.log(_uniform(_bits(first, 0, 32), 32) * _uniform(_bits(first, 32, 32), 32))
    c = -F.log(_uniform(_bits(second, 40, 24), 24) * _uniform(_bits(second, 16, 24), 24))
    b = _uniform(_bits(second, 0, 16), 16)
    return F.log(c) - r * (F.floor(log_weight / r + b) - b + 1)


def signatures(words: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``words``: rows with ``keys`` and ``word``, repeats included. One row for each key: ``sig``, an array of 16-bit samples."""
    counted = words.groupBy(*keys, "word").agg(F.log(F.count("*").cast("double")).alias("log_weight"))
    least = counted.groupBy(*keys).agg(
        *(F.min(log_a(F.col("word"), F.col("log_weight"), k)).alias(f"s{k}") for k in range(samples)))
    sig = F.array(*(F.xxhash64(F.col(f"s{k}")).bitwiseAND(F.lit(0xFFFF)).cast("int") for k in range(samples)))
    return least.select(*keys, sig.alias("sig"))


def words_of(text: Column) -> Column:
    """Hashes of the words, one row each; a text without words has one empty word."""
    return F.explode(F.split(F.btrim(ascii_lower(text), F.lit(WHITE)), r"[\x20\x09-\x0D]+"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    same = [F.when(F.get(a, F.lit(k)) == F.get(b, F.lit(k)), 1).otherwise(0) for k in range(samples)]
    return sum(same[1:], same[0]) / samples


def text_form(sig: Column, samples: int = SAMPLES) -> Column:
    return F.concat(*(F.lpad(F.lower(F.hex(F.get(sig, F.lit(k)))), 4, "0") for k in range(samples)))


def fingerprint(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Rows ``doc_id, text_hash, fingerprint``: one for each different (id, text). A null text is empty."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    keys = [F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("text_hash")]
    once = docs.select(*keys, text.alias("text")).dropDuplicates(["doc_id", "text_hash"])
    words = once.select("doc_id", "text_hash", words_of(F.col("text")).alias("word")).withColumn("word", F.xxhash64("word"))
    found = signatures(words, ["doc_id", "text_hash"], samples)
    return found.select("doc_id", "text_hash", text_form(F.col("sig"), samples).alias("fingerprint"))


def neighbours(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranges: int | None = None) -> DataFrame:
    """Rows ``bucket, place, halo, no_id, key, text, next_text``: each row with the text of the next one by descending id.

    The row after the last is the first. Ids fall into ranges whose upper ends are ids of
    the table; the row at a range's end is copied into the range before it (``halo``), so each
    range is complete in itself. Null ids come last; equal ids are ordered by their text's hash.
    """
    spark = docs.sparkSession
    ranges = ranges or RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_column).isNull().alias("no_id"), F.coalesce(F.col(id_column).cast("bigint"), F.lit(NO_ID)).alias("key"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    levels = [k / ranges for k in range(1, ranges + 1)]
    ends = rows.agg(F.percentile_approx("key", levels, 10 * ranges), F.max("key")).first()
    ends = sorted({*(ends[0] or []), *([] if ends[1] is None else [ends[1]])}, reverse=True)
    step = max(1, math.isqrt(len(ends)))
    longs = lambda x: F.from_json(F.lit(str(x)), "array<bigint>")
    at_least = lambda values: F.size(F.filter(values, lambda x: x >= F.col("key")))
    block = at_least(longs(ends[::step])) - 1
    within = F.slice(longs(ends), block * step + 1, F.lit(step))
    placed = rows.withColumn("block", block).withColumn("range", F.col("block") * step + at_least(within) - 1)
    is_end = F.get(longs(ends), F.col("range")) == F.col("key")
    before = F.pmod(F.col("range") - 1, F.lit(max(1, len(ends)))).cast("int")
    copies = F.array_compact(F.array(
        F.struct(F.col("range").alias("bucket"), F.lit(False).alias("halo")),
        F.when(is_end, F.struct(before.alias("bucket"), F.lit(True).alias("halo")))))
    dealt = placed.withColumn("copy", F.explode(copies)).select("copy.bucket", "copy.halo", "no_id", "key", "text")
    order = Window.partitionBy("bucket").orderBy("halo", "no_id", F.desc("key"), F.xxhash64("text"))
    return dealt.select(
        "bucket", F.row_number().over(order).alias("place"), "halo", "no_id", "key", "text", F.lead("text").over(order).alias("next_text"))


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES, ranges: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: its fingerprint, that of its text with the second half replaced by the
    start of the next text, and the likeness of the first to the second and to the next text's.

    A null text is empty; all texts without words are alike. A table of one row is its own next row.
    """
    rows = neighbours(docs, ranges=ranges)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.coalesce(F.substring("next_text", F.lit(1), half), F.lit("")))
    both = rows.select("bucket", "place", "halo", "no_id", "key", "text", edited.alias("edited"))
    facts = both.filter("not halo").select(
        "bucket", "place", F.when(~F.col("no_id"), F.col("key")).alias("doc_id"), F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"))
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))))
    words = both.select("bucket", "place", kinds.alias("x")).select("bucket", "place", "x.kind", words_of(F.col("x.text")).alias("word"))
    found = signatures(words.withColumn("word", F.xxhash64("word")), ["bucket", "place", "kind"], samples)
    line = Window.partitionBy("bucket").orderBy("place", "kind")
    pairs = found.select("bucket", "place", "kind", "sig", F.lead("sig", 1).over(line).alias("own"), F.lead("sig", 2).over(line).alias("next"))
    pairs = pairs.filter("kind = 0").drop("kind")
    return facts.join(pairs, ["bucket", "place"]).select(
        "doc_id", "n_chars", "edited_sha256", text_form(F.col("sig"), samples).alias("fingerprint"),
        text_form(F.col("own"), samples).alias("edited_fingerprint"), likeness(F.col("sig"), F.col("own"), samples).alias("near_edited"),
        likeness(F.col("sig"), F.col("next"), samples).alias("near_next"))
