"""Phrases whose words occur together far more often than alone, per language.

Texts are lower-cased in A-Z only, cut into pieces at ``.,;:!?`` and line ends, and the
pieces into words at spaces and tabs. A phrase is 2 or 3 consecutive words of a piece.

Counting, inside each task (direct-address tiling):

1. The words of a batch get ids ranked by their frequency in the batch, 0 the most
   frequent. A pair of neighbours is a cell (first id, second id) of a square of
   tiles. The leading tile, where both ids are below ``DENSE`` (frequent words, most
   of all pairs by Zipf's law), is counted by one dense ``numpy.bincount`` over
   ``first * DENSE + second``; the remaining tiles are sparse and are counted as sorted
   coordinates (``numpy.unique`` of ``first * width + second``).
2. Recursion: the pairs are ranked by their counts and become items themselves; a
   phrase of three words is the cell (pair id, third word id), counted the same way.

Over all tasks, in two passes over the texts, as most phrases are too rare to matter:

1. A batch sends a 56-bit hash and a count (up to 255) for each distinct cell, dealt into
   ``BUCKETS`` by the hash. A bucket adds them up and keeps the hashes that reach the least
   count. They set the bits of a map of at most ``MOST_BITS``.
2. A batch sends (language, words, phrase, count) for each cell whose bit is set. Spark adds
   these up by the phrase itself. Equal hashes or bits only let further phrases through, whose
   exact sums are then too low; none that reaches the least count is lost.

The rest are Spark joins on the counted table: the parts of each cut, the longer
phrases that hold a shorter one, and the first ``top`` rows per language, which Spark
limits in each task before the shuffle (no task sorts a whole language). Scores are
computed in 38-digit decimals and divided exactly.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codecorpus.llm.common import Staging

# Fixed values of the contract: the characters that end a piece, the words of a piece,
# the language of a null, the least count of a phrase, the share of a longer phrase that
# hides a shorter one (in percent), the number of phrases per language and the score's scale.
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
WORD = r"[^\x20\x09]+"
NO_LANG = "und"
MIN_COUNT = 10
HIDDEN_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
LONGEST = 3

#: Ids below this form the dense tile of each level.
DENSE = 1024
#: Bytes of text counted together before their phrases are sent; Spark's partial sum combines the batches of a task.
BATCH_BYTES = 6 << 20
#: Parts that the hashes are dealt into, by their first bits.
BUCKETS = 1 << 11
#: Bits of the map per hash that reaches the least count, and in all.
BITS_EACH, MOST_BITS = 32, 1 << 28
#: Counts that travel with a hash end here.
MOST_SENT = 255

COUNTS = "lang string, n_words int, phrase string, c long"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[list[str]]:
    """The pieces of a text, each a list of its words; a null text has none."""
    pieces = re.split(PIECE_ENDS, (text or "").translate(_LOWER))
    return [w for w in (re.findall(WORD, p) for p in pieces) if w]


def tile_count(first: np.ndarray, second: np.ndarray, width: int, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells ``first * width + second`` (sorted) and their counts.

    Cells with both ids below ``dense`` are counted in one dense tile; the others as
    sorted coordinates.
    """
    lead = (first < dense) & (second < dense)
    cells = np.bincount(first[lead] * dense + second[lead], minlength=dense * dense) if lead.any() else np.zeros(0, np.int64)
    hit = np.flatnonzero(cells)
    dense_codes = (hit // dense) * width + hit % dense
    sparse_codes, sparse_counts = np.unique(first[~lead].astype(np.int64) * width + second[~lead], return_counts=True)
    codes = np.concatenate([dense_codes, sparse_codes])
    counts = np.concatenate([cells[hit], sparse_counts]).astype(np.int64)
    order = np.argsort(codes, kind="stable")
    return codes[order], counts[order]


def ranked(counts: np.ndarray) -> np.ndarray:
    """The rank of each item by count, most frequent 0; ties by the item's number."""
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    return rank


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two (splitmix64)."""
    h = left * np.uint64(0x9E3779B97F4A7C15) + right
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def cells(
    items: np.ndarray, linked: np.ndarray, own: np.ndarray, passed: Callable[[np.ndarray], np.ndarray] | None = None
) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """For 1, 2 and 3 words: the items of each distinct phrase (an array per word), its count and its hash.

    ``items``: the item at each place; ``linked``: whether a place and the next share a piece; ``own``: each item's hash.
    ``passed`` says by the hashes which phrases are wanted; a phrase that holds an unwanted one is not wanted either.
    """
    counts = np.bincount(items, minlength=len(own))
    hit = np.arange(len(own)) if passed is None else np.flatnonzero(passed(own))
    yield [hit], counts[hit], own[hit]
    rank = ranked(counts)
    by_rank = np.argsort(rank)
    x, width = rank[items], len(own)
    joined = np.flatnonzero(linked)  # position p: words p and p + 1 share a piece
    if not len(joined):
        return
    codes, counts = tile_count(x[joined], x[joined + 1], width)
    first, second = by_rank[codes // width], by_rank[codes % width]
    hashes = _mixed(own[first], own[second])
    if passed is not None:
        hit = np.flatnonzero(passed(hashes))
        codes, counts, first, second, hashes = codes[hit], counts[hit], first[hit], second[hit], hashes[hit]
    yield [first, second], counts, hashes
    if not len(codes):
        return
    # the pairs, ranked by count, are items of the next level
    pair_rank = ranked(counts)
    cell = x[joined] * width + x[joined + 1]
    at = np.minimum(np.searchsorted(codes, cell), len(codes) - 1)
    pair_of = np.full(len(x), -1, np.int64)
    pair_of[joined] = np.where(codes[at] == cell, pair_rank[at], -1)
    three = joined[:-1][np.diff(joined) == 1]
    three = three[(pair_of[three] >= 0) & (pair_of[three + 1] >= 0)]
    if not len(three):
        return
    pairs_by_rank = np.argsort(pair_rank)
    width3 = max(width, len(pair_rank))
    codes3, counts3 = tile_count(pair_of[three], x[three + 2], width3)
    lead = pairs_by_rank[codes3 // width3]
    third = by_rank[codes3 % width3]
    hashes3 = _mixed(hashes[lead], own[third])
    hit = np.arange(len(codes3)) if passed is None else np.flatnonzero(passed(hashes3))
    yield [first[lead[hit]], second[lead[hit]], third[hit]], counts3[hit], hashes3[hit]


def _rows(langs: pa.Array, phrases: list[pa.Array], counts: np.ndarray) -> pa.RecordBatch:
    phrase = pc.binary_join_element_wise(*phrases, " ") if phrases else pa.array([""] * len(counts))
    return pa.RecordBatch.from_arrays(
        [langs, pa.array(np.full(len(counts), len(phrases), np.int32)), phrase, pa.array(counts.astype(np.int64))],
        names=["lang", "n_words", "phrase", "c"],
    )


def count_batch(lang: str, pieces: list[list[str]]) -> Iterator[pa.RecordBatch]:
    """Batches ``lang, n_words, phrase, c``: counts of the words and of the 2- and 3-word phrases of ``pieces``."""
    words = pa.array([w for p in pieces for w in p], pa.string()).dictionary_encode()
    if not len(words):
        return
    piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    own = np.zeros(len(words.dictionary), np.uint64)
    for parts, counts, _ in cells(words.indices.to_numpy().astype(np.int64), piece[:-1] == piece[1:], own):
        yield _rows(pa.array([lang] * len(counts), pa.string()), [words.dictionary.take(pa.array(x)) for x in parts], counts)


#: 0: in a word, 1: between words, 2: end of a piece. All of these characters are single bytes in UTF-8.
_KIND = np.array([2 if re.match(PIECE_ENDS, chr(b)) else 1 if b < 128 and not re.match(WORD, chr(b)) else 0 for b in range(256)], np.uint8)
_LOWER_BYTE = np.array([ord(chr(b).translate(_LOWER)) for b in range(256)], np.uint8)


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts in turn, whether each but the last shares a piece with the next, and its text's number."""
    ended = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.string()), ""), "", "\n")  # a text ends its last piece
    _, offsets, data = ended.buffers()
    ends = np.frombuffer(offsets, np.int32, len(ended) + 1)
    data = np.frombuffer(data, np.uint8, ends[-1])
    kind = _KIND[data]
    inside = kind == 0
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    start, stop = edges[::2], edges[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[start]
    places = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(places), pa.py_buffer(_LOWER_BYTE[data[inside]]))
    return words, piece[:-1] == piece[1:], np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, ends)))


class Items:
    """The words of a batch of texts; an item is a word in a language."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        words, self.linked, row = words_in(texts)
        words, langs = words.dictionary_encode(), langs.cast(pa.string()).dictionary_encode()
        width = max(len(words.dictionary), 1)
        code = langs.indices.to_numpy().astype(np.int64)[row] * width + words.indices.to_numpy()
        self.places, distinct = pd.factorize(code)
        self.lang, self.word = distinct // width, distinct % width
        self.langs, self.words = langs.dictionary, words.dictionary

    def hashes(self) -> np.ndarray:
        of = lambda names: pd.util.hash_array(names.to_numpy(zero_copy_only=False), categorize=False)
        return _mixed(of(self.langs)[self.lang], of(self.words)[self.word])

    def cells(self, passed: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        return cells(self.places, self.linked, self.hashes(), passed) if len(self.places) else iter(())

    def rows(self, passed: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
        """``lang, n_words, phrase, c`` of the phrases; with n_words 0 the number of all words."""
        total = np.bincount(self.lang[self.places], minlength=len(self.langs))
        yield _rows(self.langs, [], total)
        for parts, counts, _ in self.cells(passed):
            yield _rows(self.langs.take(pa.array(self.lang[parts[0]])), [self.words.take(pa.array(self.word[x])) for x in parts], counts)


def _held(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Items]:
    """Rows ``text, lang`` put together or cut apart to about ``most`` bytes of text; a row is never cut."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(batch):
            n = max(1, int(np.searchsorted(np.cumsum(lengths[at:]), most - size)))
            held.append(batch.slice(at, n))
            size += int(lengths[at : at + n].sum())
            at += n
            if size >= most or at < len(batch):
                yield _items(held)
                held, size = [], 0
    if held:
        yield _items(held)


def _items(held: list[pa.RecordBatch]) -> Items:
    return Items(*(pa.concat_arrays([b.column(k) for b in held]) for k in (0, 1)))


def _packed(items: Items) -> pa.RecordBatch:
    """``bucket, cells``: the distinct cells in order, the count in a hash's last 8 bits."""
    sent = [h >> np.uint64(8) << np.uint64(8) | np.minimum(c, MOST_SENT).astype(np.uint64) for _, c, h in items.cells()]
    packed = np.sort(np.concatenate(sent or [np.zeros(0, np.uint64)]))
    bucket = np.arange(BUCKETS)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    ends = np.append(np.searchsorted(packed, bucket.astype(np.uint64) << shift), len(packed))
    data = pa.BinaryArray.from_buffers(pa.binary(), BUCKETS, [None, pa.py_buffer((ends * 8).astype(np.int32)), pa.py_buffer(packed)])
    full = pa.array(np.diff(ends) > 0)
    return pa.record_batch({"bucket": pa.array(bucket.astype(np.int32)), "cells": data}).filter(full)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x.as_buffer(), np.uint64) for x in column)])


def frequent_cells(rows: DataFrame, min_count: int) -> DataFrame:
    """``bucket, cells``: the hashes (8 bytes each, in order) of all phrases of rows ``text, lang`` with that count, and perhaps some others."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(_packed, _held(batches, BATCH_BYTES))

    def add(sent: pa.Table) -> pa.Table:
        packed = np.sort(_numbers(sent["cells"]))
        hashes = packed >> np.uint64(8)
        starts = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
        total = np.add.reduceat((packed & np.uint64(MOST_SENT)).astype(np.int64), starts)
        found = hashes[starts][total >= min(min_count, MOST_SENT)] << np.uint64(8)
        return pa.table({"bucket": sent["bucket"][:1], "cells": pa.array([found.tobytes()], pa.binary())})

    return rows.mapInArrow(send, "bucket int, cells binary").groupBy("bucket").applyInArrow(add, "bucket int, cells binary")


def bit_map(found: DataFrame) -> tuple[np.ndarray, int]:
    """A map with a bit for the first bits of each hash in ``found`` (staged), and the number of those bits."""
    n = (found.agg(F.sum(F.octet_length("cells"))).first()[0] or 0) // 8
    bits = max(BUCKETS.bit_length() + 2, min(MOST_BITS, max(1, n * BITS_EACH)).bit_length() - 1)
    part = 1 << bits - (BUCKETS.bit_length() - 1)  # bits of a bucket

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for cells_of in batch.column(1):
                marked = np.zeros(part, bool)
                marked[((np.frombuffer(cells_of.as_buffer(), np.uint64) >> np.uint64(64 - bits)) & np.uint64(part - 1)).astype(np.int64)] = True
                marks.append(np.packbits(marked, bitorder="little").tobytes())
            yield pa.record_batch({"bucket": batch.column(0), "marks": pa.array(marks, pa.binary())})

    marks = np.zeros((BUCKETS, part // 8), np.uint8)
    for row in found.filter(F.octet_length("cells") > 0).mapInArrow(mark, "bucket int, marks binary").toLocalIterator():
        marks[row.bucket] = np.frombuffer(row.marks, np.uint8)
    return marks.ravel(), bits


def _marked(marks: np.ndarray, bits: int) -> Callable[[np.ndarray], np.ndarray]:
    def passed(hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - bits)
        return (marks[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    return passed


def phrase_counts(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", min_count: int = 1) -> DataFrame:
    """``lang, n_words, phrase, f``: counts over all rows of the words (n_words 1) and phrases of 2 and 3 words that
    occur ``min_count`` times or more, and, with n_words 0 and an empty phrase, of all words of a language."""
    rows = docs.select(F.col(text_column).cast("string").alias("text"), F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANG)).alias("lang"))
    known = None
    if min_count > 1:
        spark = docs.sparkSession
        known = spark.sparkContext.broadcast(bit_map(Staging(spark).put(frequent_cells(rows, min_count), "frequent_cells")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = known and _marked(*known.value)
        for items in _held(batches, BATCH_BYTES):
            yield from items.rows(passed)

    sums = rows.mapInArrow(counted, COUNTS).groupBy("lang", "n_words", "phrase").agg(F.sum("c").alias("f"))
    return sums.filter((F.col("n_words") == 0) | (F.col("f") >= min_count))


def collocations(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", min_count: int = MIN_COUNT, top: int = TOP
) -> DataFrame:
    """Rows ``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language.

    ``n``: all words of the language; ``a``: the phrase's count; the cut after the first k words
    with the lowest ``score = floor(SCALE * a * a / (l * r))`` counts (ties: smallest k), ``l`` and
    ``r`` the counts of its parts. A 2-word phrase goes if a 3-word candidate holds it with a
    count of at least half its own. Order: score, a (both descending), phrase (UTF-8 bytes).
    A null text has no words, a null language is ``und``; repeated rows count again. An
    empty table gives no rows. Other columns are not read.
    """
    staging = Staging(docs.sparkSession)
    counts = staging.put(phrase_counts(docs, text_column, lang_column, min_count), "phrase_counts")
    n = counts.filter("n_words = 0").select("lang", F.col("f").alias("n"))
    parts = counts.filter("n_words > 0").select("lang", "phrase", "f")
    cand = counts.filter("n_words >= 2").select(
        "lang", "phrase", "n_words", F.col("f").alias("a"), F.split("phrase", " ").alias("w")
    )
    cuts = cand.select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")).select(
        "lang", "phrase", "n_words", "a", "w", "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, LONGEST), " ").alias("right"),
    )
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]
    )
    big = "CAST(a AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * CAST({scale} AS DECIMAL(38,0))".format(scale=SCALE)
    cuts = cuts.withColumn("score", F.expr(f"({big}) div (CAST(l AS DECIMAL(38,0)) * CAST(r AS DECIMAL(38,0)))").cast("long"))
    best = cuts.groupBy("lang", "phrase", "n_words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select(
        "lang", "phrase", "n_words", "a", "m.score", "m.l", "m.r"
    )
    longer = cand.filter(F.col("n_words") == LONGEST)
    holders = longer.select("lang", F.array_join(F.slice("w", 1, 2), " ").alias("phrase"), "a").unionByName(
        longer.select("lang", F.array_join(F.slice("w", 2, 2), " ").alias("phrase"), "a")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = best.join(holders, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * HIDDEN_PERCENT)
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").cast("binary"))
    top_rows = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return top_rows.join(n, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", F.col("a").cast("long"), F.col("l").cast("long"),
        F.col("r").cast("long"), F.col("n").cast("long"), "score",
    )
