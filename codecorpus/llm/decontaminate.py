"""Benchmark passages in documents, found in a positional inverted index.

1. The index: one posting (document, position, term) for each document word that is
   a benchmark word, written to the shared folder. A task writes the postings of its
   own documents, so building the index shuffles nothing.
2. For each window of consecutive item words the two rarest terms, by their number of
   postings. The rarest term's postings are moved back by the term's place in the
   item, which gives the places where the item would have to begin; those places are
   intersected with the second term's postings, moved back in the same way.
3. What is left is compared word by word: the item's remaining words are looked up
   at their places, and runs of at least a window's length are matches.

A document is known by its id and its text's hash, so rows that share an id do not mix.
The tables of benchmark words and windows are broadcast if they are below
``BROADCAST_BYTES``; beyond that, Spark shuffles both sides of the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codecorpus.llm.common import NOT_WORD, Staging, ascii_lower, broadcast_below, fresh

WINDOW = 10
BROADCAST_BYTES = 16 << 20
#: Stands for a null id inside the index.
NO_ID = -(1 << 63)
DOC = ["doc", "text_hash"]


def spaced(text: Column) -> Column:
    """The words of a text with one space between them."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, " "))


def words(text: Column) -> Column:
    clean = spaced(text)
    return F.when(clean != "", F.split(clean, " ")).otherwise(F.array().cast("array<string>"))


def count_words(text: Column) -> Column:
    clean = spaced(text)
    return F.when(clean == "", 0).otherwise(F.length(clean) - F.length(F.replace(clean, F.lit(" "), F.lit(""))) + 1).cast("long")


def doc_key(id_column: str, text_column: str) -> list[Column]:
    return [F.coalesce(F.col(id_column).cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_column).alias("text_hash")]


class PhraseIndex:
    """Postings of the words of ``items`` in ``docs``, staged, and searches in them.

    Items are known by ``item_id`` as text (null: the empty string) and their text.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, staging: Staging, id_column: str = "doc_id", text_column: str = "text"):
        self.staging = staging
        places = items.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.xxhash64("text").alias("item_hash"),
            F.posexplode(words(F.col("text"))).alias("place", "term"),
        ).distinct()
        self.places = staging.put(places.withColumn("term_id", F.xxhash64("term")), "places")
        terms = staging.put(self.places.select("term", "term_id").distinct(), "terms")
        rows = docs.select(*doc_key(id_column, text_column), F.posexplode(words(F.col(text_column))).alias("pos", "term"))
        found = rows.join(broadcast_below(terms, BROADCAST_BYTES), "term").select(*DOC, "pos", "term_id")
        self.postings = staging.put(found, "postings")
        self.counts = staging.put(self.postings.groupBy("term_id").agg(F.count("*").alias("rows")), "counts")

    def windows(self, size: int) -> DataFrame:
        """Rarest and second rarest term, with places, of each window all of whose terms have postings."""
        ahead = Window.partitionBy("item", "item_hash").orderBy("place").rowsBetween(0, size - 1)
        whole = Window.partitionBy("item", "item_hash")
        ranked = self.places.join(self.counts, "term_id", "left").select(
            "item", "item_hash", "place", F.sort_array(F.collect_list(F.struct("rows", "place", "term_id")).over(ahead)).alias("by_rows"),
            F.min(F.coalesce("rows", F.lit(0))).over(ahead).alias("least"), F.count("*").over(whole).alias("n"),
        )
        length = F.least(F.lit(size), "n")
        first, second = F.col("by_rows")[0], F.get("by_rows", F.least(F.lit(1), F.size("by_rows") - 1))
        return ranked.filter((F.size("by_rows") == length) & (F.col("place") <= F.col("n") - length) & (F.col("least") > 0)).select(
            "item", "item_hash", length.alias("length"), first.term_id.alias("term1"), first.place.alias("place1"),
            second.term_id.alias("term2"), second.place.alias("place2"),
        ).distinct()

    def begins(self, size: int = WINDOW) -> DataFrame:
        """Documents and the places where an item would begin, for which both rarest terms of a window stand right."""
        windows = self.staging.put(self.windows(size), "windows")
        one = self.postings.join(broadcast_below(windows, BROADCAST_BYTES), F.col("term_id") == F.col("term1")).select(
            *DOC, "item", "item_hash", "length", (F.col("pos") - F.col("place1")).alias("begin"), "term2",
            (F.col("pos") - F.col("place1") + F.col("place2")).alias("pos2"),
        ).distinct()
        seconds = self.staging.put(windows.select(F.col("term2").alias("term_id")).distinct(), "seconds")
        two = self.postings.join(broadcast_below(seconds, BROADCAST_BYTES), "term_id", "left_semi").select(
            *DOC, F.col("pos").alias("pos2"), F.col("term_id").alias("term2"))
        return one.join(two, [*DOC, "pos2", "term2"], "left_semi").select(*DOC, "item", "item_hash", "length", "begin").distinct()

    def phrases(self, size: int = WINDOW) -> DataFrame:
        """Rows ``doc, text_hash, item, pos``: document words inside an exact occurrence of a window of the item."""
        begins = self.staging.put(self.begins(size), "begins")
        expected = begins.join(broadcast_below(self.places, BROADCAST_BYTES), ["item", "item_hash"]).select(
            *DOC, "item", "item_hash", "length", "begin", (F.col("begin") + F.col("place")).alias("pos"), "term_id")
        where = broadcast_below(self.staging.put(begins.select(*DOC).distinct(), "found"), BROADCAST_BYTES)
        there = self.postings.join(where, DOC, "left_semi")
        line = ["item", "item_hash", "begin", *DOC]
        met = expected.join(there, [*DOC, "pos", "term_id"]).select(*line, "length", "pos").distinct()
        island = F.col("pos") - F.row_number().over(Window.partitionBy(*line).orderBy("pos"))
        runs = met.withColumn("island", island)
        runs = runs.withColumn("run", F.count("*").over(Window.partitionBy(*line, "island")))
        return runs.filter("run >= length").select(*DOC, "item", "pos")

    def near(self, slop: int = 20, terms: int = 3) -> DataFrame:
        """Rows ``doc, text_hash, item, first_pos, last_pos``: places where the item's ``terms`` rarest words
        all stand within ``slop`` words, in any order. Items with a word that no document has are left out."""
        by_rows = Window.partitionBy("item", "item_hash").orderBy("rows", "term_id")
        distinct = self.places.select("item", "item_hash", "term_id").distinct().join(self.counts, "term_id", "left")
        rarest = distinct.select(
            "item", "item_hash", "term_id", "rows", F.row_number().over(by_rows).alias("k"),
            F.min(F.coalesce("rows", F.lit(0))).over(Window.partitionBy("item", "item_hash")).alias("least"))
        rarest = rarest.filter((F.col("k") <= terms) & (F.col("least") > 0))
        rarest = rarest.withColumn("of", F.count("*").over(Window.partitionBy("item", "item_hash")))
        rarest = self.staging.put(rarest.select("item", "item_hash", "term_id", "of"), "rarest")
        span = Window.partitionBy("item", "item_hash", *DOC).orderBy("pos").rangeBetween(0, slop)
        found = self.postings.join(broadcast_below(rarest, BROADCAST_BYTES), "term_id").select(
            *DOC, "item", "of", F.col("pos").alias("first_pos"), F.size(F.collect_set("term_id").over(span)).alias("kinds"),
            F.max("pos").over(span).alias("last_pos"))
        return found.filter(F.col("kinds") == F.col("of")).select(*DOC, "item", "first_pos", "last_pos").distinct()


def benchmark_hits(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows ``doc, text_hash, n_hit, items`` for the documents that hold a window of an item.

    ``items``: the item ids as text, sorted, distinct. Words are ``NOT_WORD``'s complement after
    A-Z became lower case; an item with fewer words than ``size`` is one window; without words it is
    none. Null texts have no words. Repeated rows give the same result as one row.
    """
    found = PhraseIndex(docs, items, Staging(docs.sparkSession), id_column, text_column).phrases(size)
    return found.groupBy(*DOC).agg(
        F.count_distinct("pos").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    hits = Staging(docs.sparkSession).put(benchmark_hits(docs, items, size), "hits")
    rows = docs.select("doc_id", *doc_key("doc_id", "text"), count_words(F.col("text")).alias("n_words"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(hits, DOC, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean_of(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, with their columns."""
    staging = Staging(docs.sparkSession)
    doc_, hash_ = fresh(docs.columns, "__doc"), fresh(docs.columns, "__hash")
    bad = staging.put(benchmark_hits(docs, items, size).select(F.col("doc").alias(doc_), F.col("text_hash").alias(hash_)), "bad")
    same = (F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)) == F.col(doc_)) & (F.xxhash64("text") == F.col(hash_))
    return docs.join(broadcast_below(bad, BROADCAST_BYTES), same, "left_anti")
