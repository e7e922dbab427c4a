"""Byte-level subword vocabulary: learning, encoding, decoding.

The data-sized steps (splitting texts into words, counting words, pairs and
segments, applying merges) are Spark jobs. The driver holds the vocabulary,
whose size is a parameter, and a bounded summary per round.
"""

from __future__ import annotations

import heapq
import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from codecorpus.functions.text import IF_MASK
from codecorpus.session import Staging, spread

# Special tokens in id order, the word pattern, sizes.
SPECIAL_TOKENS = ["<s>", "<pad>", "</s>", "<unk>", "<mask>", IF_MASK]
PAD_ID = 1
UNKNOWN_ID = 3
MASK_ID = 4
WORD = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCAB_SIZE = 40_000
MIN_FREQUENCY = 3
MAX_LENGTH = 512
TARGET_LENGTH = 64

MAX_VOCAB_ROWS = 1_000_000
FIRST_PAIRS = 512
MAX_PAIRS = 16_384
#: Symbols of a round's segments, in all, that the driver may hold.
MAX_SYMBOLS = 100_000
CACHED_WORDS = 500_000
#: Rows that a Python task encodes or decodes at once.
ROWS_AT_ONCE = 256


def byte_characters() -> list[str]:
    """The public printable character of each byte value.

    Visible Latin-1 bytes stand for themselves; the others follow from U+0100 on.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


# --- words and pairs ------------------------------------------------------------


def pretokenize(text: Column) -> Column:
    """Words of a text; a space belongs to the word after it."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_frequencies(df: DataFrame, col: str = "text", by_line: bool = False) -> DataFrame:
    """``word, n`` over the corpus, counted in each task before the shuffle.

    Training reads the corpus file line by line, each line with its line feed,
    so a whitespace run never crosses a line there: ``by_line``.
    """
    text = F.col(col)
    if by_line:
        text = F.explode(F.regexp_extract_all(text, F.lit(r"[^\n]*\n|[^\n]+"), F.lit(0)))
    lines = df.select(text.alias("_text"))
    return lines.select(F.explode(pretokenize(F.col("_text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def pair_counts(words: DataFrame, symbols: str = "symbols", n: str = "n") -> DataFrame:
    """``left, right, n``: neighbouring symbols, weighted by the word count."""
    if words.schema[symbols].dataType == T.ArrayType(T.IntegerType()):
        ids = words.select(symbols, F.col(n).cast("bigint")).mapInArrow(_pairs_of_batches, "left int, right int, n bigint")
        return ids.groupBy("left", "right").agg(F.sum("n").alias("n"))
    s = F.col(symbols)
    pairs = F.arrays_zip(
        F.slice(s, F.lit(1), F.size(s) - 1).alias("left"), F.slice(s, F.lit(2), F.size(s) - 1).alias("right")
    )
    return (
        words.filter(F.size(symbols) > 1)
        .select(F.explode(pairs).alias("p"), F.col(n).alias("_n"))
        .groupBy("p.left", "p.right")
        .agg(F.sum("_n").alias("n"))
    )


# --- the vocabulary -------------------------------------------------------------


@dataclass
class Vocabulary:
    """Tokens by id and the merges in order; bounded by the vocabulary size."""

    tokens: list[str]
    merges: list[tuple[int, int, int]]
    special: list[str] = field(default_factory=lambda: list(SPECIAL_TOKENS))

    def __post_init__(self):
        self.ids = {t: i for i, t in enumerate(self.tokens)}
        self.ranks = {(left, right): (rank, new) for rank, (left, right, new) in enumerate(self.merges)}
        self.byte_ids = [self.ids.get(c, UNKNOWN_ID) for c in byte_characters()]

    def tokens_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.tokens)), "id int, token string").select("token", "id")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(r, self.tokens[a], self.tokens[b]) for r, (a, b, _) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string")

    @classmethod
    def from_tables(cls, tokens: DataFrame, merges: DataFrame, limit: int = MAX_VOCAB_ROWS) -> Vocabulary:
        """Read the two tables back. They go to every task, so their size is checked."""
        rows = tokens.select("token", "id").orderBy("id").limit(limit + 1).collect()
        pairs = merges.select("rank", "left", "right").orderBy("rank").limit(limit + 1).collect()
        if max(len(rows), len(pairs)) > limit:
            raise ValueError(f"a vocabulary of more than {limit} rows is too large to send to tasks")
        names = [r.token for r in rows]
        ids = {t: i for i, t in enumerate(names)}
        return cls(names, [(ids[m.left], ids[m.right], ids[m.left + m.right]) for m in pairs])


def merge_symbols(symbols: list[int], ranks: dict) -> list[int]:
    """Apply merges to one word, lowest rank first."""
    while len(symbols) > 1:
        found = min((ranks[p] for p in zip(symbols, symbols[1:]) if p in ranks), default=None)
        if found is None:
            break
        merged: list[int] = []
        i = 0
        while i < len(symbols):
            if i + 1 < len(symbols) and ranks.get((symbols[i], symbols[i + 1])) == found:
                merged.append(found[1])
                i += 2
            else:
                merged.append(symbols[i])
                i += 1
        symbols = merged
    return symbols


# --- learning -------------------------------------------------------------------


def _byte_words(words: DataFrame, byte_ids: dict[int, int]) -> DataFrame:
    """Words of two or more bytes as symbol lists."""
    ids = np.zeros(256, dtype=np.int32)
    for byte, i in byte_ids.items():
        ids[byte] = i

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(0).cast(pa.binary())
            data = np.frombuffer(b"".join(raw.to_pylist()), dtype=np.uint8)
            symbols = _lists(pc.binary_length(raw).to_numpy(), ids[data])
            yield pa.RecordBatch.from_arrays([symbols, batch.column(1)], ["symbols", "n"])

    return words.filter(F.octet_length("word") > 1).select("word", "n").mapInArrow(run, "symbols array<int>, n bigint")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words of a batch in one array, the word of each, and the counts; words without symbols or count add nothing."""
    lists = batch.column(0)
    lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    symbols = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    counts = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
    return symbols, np.repeat(np.arange(len(lengths)), lengths), counts


def _codes(symbols: np.ndarray) -> np.ndarray:
    """One number for each pair of neighbours."""
    return (symbols[:-1] << 32) | symbols[1:]


def _summed(index: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    sums = np.zeros(size, np.int64)
    np.add.at(sums, index, counts)
    return sums


def _pairs_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        symbols, word, counts = _flat(batch)
        at = np.flatnonzero(word[:-1] == word[1:])
        pairs, index = np.unique(_codes(symbols)[at], return_inverse=True)
        sums = _summed(index, counts[word[at]], len(pairs))
        yield pa.RecordBatch.from_arrays(
            [pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(sums)], ["left", "right", "n"])


def _lists(lengths: np.ndarray, symbols: np.ndarray) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(symbols.astype(np.int32)))


def _segments(words: DataFrame, pairs: set) -> DataFrame:
    """Counts of the stretches of words in which every neighbouring pair is listed."""
    listed = np.array(sorted((left << 32) | right for left, right in pairs), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, word, counts = _flat(batch)
            if not len(symbols):
                continue
            linked = (word[:-1] == word[1:]) & np.isin(_codes(symbols), listed)
            starts = np.flatnonzero(np.concatenate(([True], ~linked)))
            lengths = np.diff(np.append(starts, len(symbols)))
            long = lengths > 1
            held = symbols[np.repeat(long, lengths)].astype(np.int32)
            # equal segments of the batch are counted once, as byte strings
            ends = np.concatenate(([0], np.cumsum(lengths[long] * 4))).astype(np.int32)
            texts = pa.Array.from_buffers(pa.binary(), int(long.sum()), [None, pa.py_buffer(ends), pa.py_buffer(held)])
            found = texts.dictionary_encode()
            distinct = found.dictionary.to_pylist()
            sums = _summed(found.indices.to_numpy(), counts[word[starts[long]]], len(distinct))
            sizes = np.array([len(x) // 4 for x in distinct], np.int64)
            yield pa.RecordBatch.from_arrays([_lists(sizes, np.frombuffer(b"".join(distinct), np.int32)), pa.array(sums)], ["segment", "n"])

    parts = words.mapInArrow(run, "segment array<int>, n bigint")
    return parts.groupBy("segment").agg(F.sum("n").alias("n"))


def _alternate(hits: np.ndarray) -> np.ndarray:
    """The places at which a pair of equal symbols is merged: in a run every second one, from the left."""
    first = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
    run_start = np.repeat(hits[first], np.diff(np.append(first, len(hits))))
    return hits[(hits - run_start) % 2 == 0]


def _merged(symbols: np.ndarray, word: np.ndarray, ranks: dict) -> tuple[np.ndarray, np.ndarray]:
    """``merge_symbols`` for many words at once, by rank: again from the first one if a merge has made an earlier pair."""
    order = sorted(((rank, pair, new) for pair, (rank, new) in ranks.items()))
    listed = np.array(sorted((left << 32) | right for left, right in ranks), np.int64)
    while np.any((word[:-1] == word[1:]) & np.isin(_codes(symbols), listed)):
        for _, (left, right), new in order:
            hits = np.flatnonzero((symbols[:-1] == left) & (symbols[1:] == right) & (word[:-1] == word[1:]))
            if len(hits):
                hits = _within(hits, word) if left == right else hits
                symbols[hits] = new
                keep = np.ones(len(symbols), bool)
                keep[hits + 1] = False
                symbols, word = symbols[keep], word[keep]
    return symbols, word


def _within(hits: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Merged places of a pair of equal symbols; a run ends with its word."""
    shifted = hits + word[hits]  # a gap between the words, so that runs of neighbouring words stay apart
    kept = _alternate(shifted)
    return hits[np.isin(shifted, kept)]


def _merge_words(words: DataFrame, ranks: dict) -> DataFrame:
    """Apply one round's merges; words of a single symbol have no pairs left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, word, counts = _flat(batch)
            symbols, word = _merged(symbols, word, ranks)
            lengths = np.bincount(word, minlength=len(counts))
            left = lengths > 1
            yield pa.RecordBatch.from_arrays([_lists(lengths[left], symbols[left[word]]), pa.array(counts[left])], ["symbols", "n"])

    return words.mapInArrow(run, "symbols array<int>, n bigint")


class _Round:
    """The merges that a round's segments decide exactly.

    All segments lie in one array, -1 between them, with a weight per place. A
    pair is known by the place of its left symbol and by one number.
    """

    def __init__(self, segments: list[tuple[list[int], int]]):
        self.symbols = np.array([-1] + [x for s, _ in segments for x in (*s, -1)], dtype=np.int64)
        self.weights = np.array([0] + [n for s, n in segments for _ in range(len(s) + 1)], dtype=np.int64)
        self.counts: dict[int, int] = defaultdict(int)
        self.heap: list[tuple[int, int]] = []
        self._count(np.arange(len(self.symbols) - 1), 1)
        self._push(self.counts)

    def _count(self, places: np.ndarray, sign: int) -> set[int]:
        """Add or take the pairs at these places; gives the pairs."""
        places = places[(self.symbols[places] >= 0) & (self.symbols[places + 1] >= 0)]
        pairs, index = np.unique((self.symbols[places] << 32) | self.symbols[places + 1], return_inverse=True)
        sums = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(sums, index, self.weights[places])
        for pair, n in zip(pairs.tolist(), sums.tolist()):
            self.counts[pair] += sign * n
        return set(pairs.tolist())

    def _push(self, pairs) -> None:
        for pair in pairs:
            if self.counts[pair] > 0:
                heapq.heappush(self.heap, (-self.counts[pair], pair))

    def best(self):
        """The count and the pair that come first, or None."""
        while self.heap:
            n, pair = self.heap[0]
            if n and -n == self.counts[pair]:
                return -n, (pair >> 32, pair & 0xFFFFFFFF)
            heapq.heappop(self.heap)
        return None

    def merge(self, pair: tuple[int, int], new: int) -> None:
        hits = np.flatnonzero((self.symbols[:-1] == pair[0]) & (self.symbols[1:] == pair[1]))
        if pair[0] == pair[1]:
            # In a run of equal symbols every second place is taken, from the left.
            hits = _alternate(hits)
        changed = self._count(np.unique(np.concatenate([hits - 1, hits, hits + 1])), -1)
        self.symbols[hits] = new
        keep = np.ones(len(self.symbols), dtype=bool)
        keep[hits + 1] = False
        self.symbols, self.weights = self.symbols[keep], self.weights[keep]
        hits = hits - np.arange(len(hits))
        changed |= self._count(np.unique(np.concatenate([hits - 1, hits])), 1)
        self._push(changed)


def learn_merges(
    df: DataFrame,
    col: str = "text",
    vocab_size: int = VOCAB_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    special: list[str] = SPECIAL_TOKENS,
    by_line: bool = True,
    first_pairs: int = FIRST_PAIRS,
    max_symbols: int = MAX_SYMBOLS,
) -> Vocabulary:
    """Learn a vocabulary: the most frequent pair is merged, again and again.

    Ties go to the lower left id, then the lower right id. Many merges are found
    per round, with the same outcome as one at a time. A round lists the leading
    pairs; let t be the count of the first pair that is not listed. An unlisted
    pair, and any pair that a merge makes out of one, counts t at most, so while
    the best listed count is above t it is the best of all. All occurrences of
    listed pairs lie in segments whose every pair is listed; their counts are a
    short table that decides the round. Its symbols are counted first: beyond
    ``max_symbols`` fewer pairs are listed, and if even those of the first pair
    (runs of any length, say) are too many, the round is the first pair alone,
    which needs no segments. The vocabulary is the same for all limits.
    """
    spark = df.sparkSession
    staging = Staging(spark)
    counted = spread(staging.put(word_frequencies(df, col, by_line), "words"))
    alphabet = counted.select(
        F.explode(F.array_distinct(F.regexp_extract_all(F.hex(F.encode("word", "UTF-8")), F.lit(".."), F.lit(0)))).alias("b")
    ).distinct()
    characters = byte_characters()
    seen = sorted((characters[int(r.b, 16)], int(r.b, 16)) for r in alphabet.collect())
    tokens = list(special)
    ids = {t: i for i, t in enumerate(tokens)}
    for character, _ in seen:
        if character not in ids:
            ids[character] = len(tokens)
            tokens.append(character)
    merges: list[tuple[int, int, int]] = []
    words = staging.put(_byte_words(counted, {b: ids[c] for c, b in seen}), "symbols-0")
    listed = first_pairs
    turn = 0
    while len(tokens) < vocab_size:
        leading = (
            pair_counts(words).orderBy(F.desc("n"), "left", "right").limit(MAX_PAIRS + 1).collect()
        )
        if not leading or leading[0].n < min_frequency:
            break
        while True:
            pairs = {(p.left, p.right) for p in leading[:listed]}
            table = staging.put(_segments(words, pairs), "segments")
            held = table.agg(F.sum(F.size("segment") + 1)).first()[0] or 0
            if held <= max_symbols or listed == 1:
                break
            listed = max(1, listed // 4)
        rest = leading[listed] if len(leading) > listed else None
        first_new = len(tokens)
        simulated = _Round([(list(s.segment), s.n) for s in table.collect()]) if held <= max_symbols else None
        ranks: dict = {}
        while len(tokens) < vocab_size:
            best = simulated.best() if simulated else (leading[0].n, (leading[0].left, leading[0].right))
            if best is None or best[0] < min_frequency:
                break
            n, pair = best
            if ranks and rest is not None:
                # At a tie with unlisted pairs only old symbols, listed first, are safe.
                ahead = pair < (rest.left, rest.right) and max(pair) < first_new
                if n < rest.n or (n == rest.n and not ahead):
                    break
            token = tokens[pair[0]] + tokens[pair[1]]
            known = token in ids
            if not known:
                ids[token] = len(tokens)
                tokens.append(token)
            new = ids[token]
            ranks[pair] = (len(merges), new)
            merges.append((*pair, new))
            if known or not simulated:
                # Older occurrences of this symbol are outside the segments.
                break
            simulated.merge(pair, new)
        turn += 1
        words = staging.put(_merge_words(words, ranks), f"symbols-{turn % 2}")
        if held < max_symbols // 4:
            listed = min(listed * 2, MAX_PAIRS)
    return Vocabulary(tokens, merges, list(special))


def build_vocabulary(vocab: Vocabulary, spark: SparkSession) -> DataFrame:
    """``token, id``: special tokens, sorted base symbols, then merges in order."""
    return vocab.tokens_df(spark)


# --- encoding and decoding --------------------------------------------------------


def encode_column(col: Column, vocab: Vocabulary) -> Column:
    """Ids of a whole text, specials kept whole, no begin or end tokens.

    Splitting is native; only the merge of a word runs in Python, once per word
    and task. No word leaves its row, so there is no shuffle and no hot word.
    """
    special = [t for t in vocab.special if t in vocab.ids]
    words = pretokenize(col)
    if special:
        literal = "|".join("\\Q" + t + "\\E" for t in special)
        # A text with n special tokens has n + 1 gaps; the last gap has none after it.
        both = F.zip_with(
            F.split(col, literal, -1),
            F.regexp_extract_all(col, F.lit(literal), F.lit(0)),
            lambda gap, token: F.concat(pretokenize(gap), F.when(token.isNull(), F.array()).otherwise(F.array(token))),
        )
        words = F.when(col.rlike(literal), F.flatten(both)).otherwise(words)
    ranks, byte_ids = vocab.ranks, vocab.byte_ids
    fixed = {t: [vocab.ids[t]] for t in special}

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, list[int]] = dict(fixed)

        def of(word: str) -> list[int]:
            found = known.get(word)
            if found is None:
                found = merge_symbols([byte_ids[b] for b in word.encode()], ranks)
                if len(known) < CACHED_WORDS:
                    known[word] = found
            return found

        for batch in batches:
            # few rows at once: a text's words take several times the room of the text
            parts = [_encoded(batch.slice(at, ROWS_AT_ONCE), of) for at in range(0, len(batch), ROWS_AT_ONCE)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return run(words)


def _encoded(rows: pa.ListArray, of: Callable[[str], list[int]]) -> pa.ListArray:
    """The ids of rows of words. Each distinct word is looked up once, and no word of a row becomes a Python object."""
    words = rows.flatten().dictionary_encode()
    table = [of(word) for word in words.dictionary.to_pylist()]
    sizes = np.fromiter(map(len, table), np.int64, len(table))
    ids = np.fromiter(itertools.chain.from_iterable(table), np.int32, int(sizes.sum()))
    places = words.indices.to_numpy()
    lengths = sizes[places]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    # the ids of word w stand from starts[w] on in the table, those of the i-th word from ends[i] on in the result
    starts = np.cumsum(sizes) - sizes
    out = ids[np.repeat(starts[places] - ends[:-1], lengths) + np.arange(ends[-1])]
    row_words = pc.list_value_length(rows).fill_null(0).to_numpy(zero_copy_only=False)
    row_ends = ends[np.concatenate(([0], np.cumsum(row_words))).astype(np.int64)]
    absent = rows.is_null() if rows.null_count else None
    return pa.ListArray.from_arrays(pa.array(row_ends.astype(np.int32)), pa.array(out), mask=absent)


def fit_length(ids: Column, max_len: int | None, pad: bool, truncate: bool, pad_id: int = PAD_ID) -> Column:
    if max_len is None:
        return ids
    if truncate:
        ids = F.slice(ids, 1, max_len)
    if pad:
        ids = F.concat(ids, F.array_repeat(F.lit(pad_id), F.greatest(F.lit(max_len) - F.size(ids), F.lit(0))))
    return ids


def encode(
    df: DataFrame, vocab: Vocabulary, col: str = "text", out: str = "input_ids", max_len: int | None = None,
    pad: bool = True, truncate: bool = True,
) -> DataFrame:
    """Adds the ids of the whole text; with ``max_len`` cut or padded to that length."""
    df = df.withColumn("_ids", encode_column(F.col(col), vocab))
    return df.withColumn(out, fit_length(F.col("_ids"), max_len, pad, truncate)).drop("_ids")


def encode_windows(
    df: DataFrame, vocab: Vocabulary, col: str = "text", out: str = "input_ids", max_len: int = MAX_LENGTH, pad_id: int = PAD_ID
) -> DataFrame:
    """The whole text in successive windows: one row per window with ``window`` (from 0) and padded ids.

    An empty or null text has one window of pads.
    """
    ids = F.coalesce(F.col("_ids"), F.array().cast("array<int>"))
    starts = F.sequence(F.lit(0), F.greatest(F.size(ids) - 1, F.lit(0)), F.lit(max_len))
    pieces = F.transform(starts, lambda s: F.slice(ids, s + 1, F.lit(max_len)))
    cut = df.withColumn("_ids", encode_column(F.col(col), vocab)).select(*df.columns, F.posexplode(pieces).alias("window", out))
    return cut.withColumn(out, fit_length(F.col(out), max_len, True, False, pad_id))


def without_pads(ids: Column, pad_id: int = PAD_ID) -> Column:
    """The ids up to the last one that is no pad."""
    return F.filter(ids, lambda x: x != pad_id)


def attention_mask(ids: Column, pad_id: int = PAD_ID) -> Column:
    return F.transform(ids, lambda x: (x != pad_id).cast("int"))


def decode_column(ids: Column, vocab: Vocabulary, skip_special: bool = False) -> Column:
    """Text of an id list; bytes are joined before they are read as UTF-8."""
    values = {c: bytes([b]) for b, c in enumerate(byte_characters())}
    special = set(vocab.special)
    pieces = []
    for token in vocab.tokens:
        if token in special:
            pieces.append(b"" if skip_special else token.encode())
        else:
            pieces.append(b"".join(values[c] for c in token))

    table = pa.array(pieces, pa.binary())

    def texts(rows: pa.ListArray) -> pa.Array:
        lengths = pc.list_value_length(rows).fill_null(0).to_numpy(zero_copy_only=False)
        ends = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
        # an id that is null fails, as it has no piece
        flat = table.take(rows.flatten())
        if flat.null_count:
            raise ValueError("an id list holds a null")
        absent = rows.is_null() if rows.null_count else None
        joined = pc.binary_join(pa.ListArray.from_arrays(ends, flat, mask=absent), b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:  # some text is no UTF-8
            return pa.array([None if x is None else x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        return pa.concat_arrays([texts(batch.slice(at, ROWS_AT_ONCE)) for at in range(0, len(batch), ROWS_AT_ONCE)] or [pa.array([], pa.string())])

    return run(ids)


def decode(df: DataFrame, vocab: Vocabulary, ids: str = "input_ids", out: str = "decoded", skip_special: bool = False) -> DataFrame:
    return df.withColumn(out, decode_column(F.col(ids), vocab, skip_special))


def prepare_pairs(
    df: DataFrame, vocab: Vocabulary, input_len: int = MAX_LENGTH, target_len: int = TARGET_LENGTH
) -> DataFrame:
    """Adds ``input_ids, attention_mask, labels``; labels keep the pad id."""
    df = encode(df, vocab, "input_text", "input_ids", input_len)
    df = df.withColumn("attention_mask", attention_mask(F.col("input_ids")))
    return encode(df, vocab, "target_text", "labels", target_len)


def check_tokenizer(df: DataFrame, vocab: Vocabulary, col: str = "text") -> DataFrame:
    """Per row: are ``def``, ``if`` and the statement mask single tokens where the
    text holds them, and does decoding give the text back?"""

    def has(*tokens: str) -> Column:
        ids = [vocab.ids[t] for t in tokens if t in vocab.ids]
        return F.arrays_overlap("_ids", F.array(*(F.lit(i) for i in ids))) if ids else F.lit(False)

    space = byte_characters()[32]
    return (
        df.withColumn("_ids", encode_column(F.col(col), vocab))
        .withColumns(
            {
                "has_def": has("def", space + "def"),
                "has_if": has("if", space + "if"),
                "has_mask": has(IF_MASK),
                "round_trip": decode_column(F.col("_ids"), vocab) == F.col(col),
            }
        )
        .drop("_ids")
    )


def validate_tokenizer(df: DataFrame, vocab: Vocabulary, col: str = "text") -> DataFrame:
    """One row of totals over any corpus."""
    return check_tokenizer(df, vocab, col).agg(
        F.count("*").alias("texts"),
        F.count_if("has_def").alias("with_def_token"),
        F.count_if("has_if").alias("with_if_token"),
        F.count_if("has_mask").alias("with_mask_token"),
        F.count_if("round_trip").alias("round_trips"),
    )


def corpus(df: DataFrame, col: str = "original_code") -> DataFrame:
    """The training texts: the code column alone, rows without code left out."""
    return df.select(F.col(col).alias("text")).filter("text IS NOT NULL")
