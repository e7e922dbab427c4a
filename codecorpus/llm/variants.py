"""Spelling variants: words one edit apart, grouped under their most frequent spelling.

Words are the runs of letters ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lower-cased; a run
whose CRC-32 (of ``<doc_id>:<run>``) is divisible by 199 loses one letter, so the
corpus holds real misspellings. A word counts if it has at least ``MIN_LENGTH``
code points and ``MIN_COUNT`` occurrences. All of that is built-in Spark.

Candidates by a variable-length gram index (VGRAM):

1. Dictionary: every 2-gram of the words is counted; one that makes up at least
   ``1 / GRAM_SHARE`` of all 2-gram occurrences is frequent and is extended by its
   next letter, so every gram is a 2-gram or a 3-gram. At most (letters)^2 2-grams
   exist, so the set of frequent ones has a bound that no input can raise.
2. Decomposition: the gram at position i is ``w[i:i+2]``, or ``w[i:i+3]`` if that
   2-gram is frequent and a letter follows. The gram depends on the letters it
   covers and, where the word's end stopped it, on that end.
3. Affected grams: a substitution or deletion at p changes only the grams at i with
   ``i <= p < i + len``, an insertion only those it falls inside, or at the word's end
   those that reach it. NAG, their
   largest number over p, bounds what one edit destroys, so two words one edit apart
   share at least ``|G(w)| - NAG(w)`` grams as multisets. With grams of at most 3
   letters and words of at least 6, that bound is at least 1 for every word.
4. List merging: grams are tokens (gram, occurrence) ordered by their list length in
   the whole index, rarest first. A word enters the lists of its first
   ``NAG + 1`` tokens only; two words that share at least ``|G| - NAG`` tokens share
   one of these (prefix filter), so no near pair is lost. Lists are keyed by (token,
   word length) and a word is also filed one length down, so only words whose lengths
   differ by at most one meet.
5. Verification: Spark's ``levenshtein`` with threshold 1.

Forms and roots are joins; a chain of forms is followed by pointer jumping, which
ends because a form is at least five times as frequent as its word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codecorpus.llm.common import Staging, ascii_lower

# Fixed values of the contract: letters of a run, the divisor that picks a run to lose
# a letter, the least length and count of a word, and the ratio of a form's count.
RUN = "[A-Za-zÀ-ÿ]+"
DROP_EVERY = 199
MIN_LENGTH = 6
MIN_COUNT = 5
FORM_RATIO = 5

#: A 2-gram that makes up this share (1 / GRAM_SHARE) of all 2-gram occurrences is extended by a letter.
GRAM_SHARE = 400
Q_MIN, Q_MAX = 2, 3

TOKENS = "word string, n_len int, token string, rank_in int"


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n``: the words of all rows with at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences.

    A null text has no runs; a null id is written as ''. Repeated rows count again.
    """
    runs = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col(text_column).cast("string"), F.lit("")), F.lit(RUN), 0)).alias("run"),
    ).select(ascii_lower(F.col("run")).alias("run"), F.crc32(F.concat_ws(":", "id", ascii_lower(F.col("run"))).cast("binary")).alias("h"))
    dropped = F.concat(F.expr("substring(run, 1, cast(h % length(run) as int))"), F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    words = runs.select(F.when(F.col("h") % DROP_EVERY == 0, dropped).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).filter((F.length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


def frequent_grams(words: DataFrame) -> set[str]:
    """The 2-grams that make up at least 1 / GRAM_SHARE of all 2-gram occurrences of ``words``; at most (letters)^2 of them."""
    grams = words.select(F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))")).alias("g"))
    counted = grams.groupBy("g").count()
    total = counted.agg(F.sum("count")).first()[0] or 0
    return {r.g for r in counted.filter(F.col("count") * GRAM_SHARE >= total).collect()}


def decompose(word: str, frequent: set[str]) -> list[str]:
    """The grams of ``word``, one per position up to ``len - Q_MIN``."""
    out = []
    for i in range(len(word) - Q_MIN + 1):
        size = Q_MIN
        while size < Q_MAX and i + size < len(word) and word[i : i + size] in frequent:
            size += 1
        out.append(word[i : i + size])
    return out


def affected(grams: list[str], length: int) -> int:
    """NAG: the most grams that one edit can change.

    The gram at i of L letters depends on those letters and, where the word's end stopped
    it, on that end. A substitution or deletion at p changes it if ``i <= p < i + L``; an
    insertion before p if ``i < p < i + L``, or at the end (p = length) if the gram reaches it.
    """
    remove = [0] * (length + 1)
    insert = [0] * (length + 1)
    at_end = 0
    for i, g in enumerate(grams):
        remove[i] += 1
        remove[i + len(g)] -= 1
        if len(g) > 1:
            insert[i + 1] += 1
            insert[i + len(g)] -= 1
        at_end += i + len(g) == length
    most, run_remove, run_insert = at_end, 0, 0
    for p in range(length):
        run_remove += remove[p]
        run_insert += insert[p]
        most = max(most, run_remove, run_insert)
    return most


def gram_tokens(words: DataFrame, frequent: set[str]) -> DataFrame:
    """``word, n_len, token, rank_in``: each word's gram tokens ``gram#k`` (k-th occurrence), with NAG + 1 as ``rank_in`` on all of them."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"word": [], "n_len": [], "token": [], "rank_in": []}
            for word in batch.column(0).to_pylist():
                grams = decompose(word, frequent)
                keep = affected(grams, len(word)) + 1
                seen = Counter()
                for g in grams:
                    seen[g] += 1
                    out["word"].append(word)
                    out["n_len"].append(len(word))
                    out["token"].append(f"{g}#{seen[g]}")
                    out["rank_in"].append(keep)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("word", pa.string()), ("n_len", pa.int32()), ("token", pa.string()), ("rank_in", pa.int32())]))

    return words.select("word").mapInArrow(tokens, TOKENS)


def near_pairs(words: DataFrame, staging: Staging) -> DataFrame:
    """``a, b``: each unordered pair of distinct words one insertion, deletion or substitution apart, once."""
    frequent = frequent_grams(words)
    toks = staging.put(gram_tokens(words, frequent), "tokens")
    sizes = toks.groupBy("token").agg(F.count("*").alias("list"))
    ranked = toks.join(sizes, "token").withColumn("r", F.row_number().over(Window.partitionBy("word").orderBy("list", "token")))
    prefix = staging.put(ranked.filter(F.col("r") <= F.col("rank_in")).select("word", "n_len", "token"), "prefix")
    left = prefix.select(F.col("word").alias("a"), "n_len", "token")
    right = prefix.select(F.col("word").alias("b"), F.explode(F.array(F.col("n_len"), F.col("n_len") - 1)).alias("n_len"), "token")
    # each candidate is verified where the join makes it, so only true pairs reach the shuffle of the distinct;
    # words of equal length meet from both sides, and the smaller one's side is kept
    found = left.join(right, ["token", "n_len"]).filter(
        ((F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    )
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows ``word, form, root, n, n_near, form_n``, one per word.

    ``form``: the near word of largest count (ties: smallest in code-point order) if that count
    is at least ``FORM_RATIO`` times the word's, else null; ``root``: the last of the chain of
    forms, the word itself if it has none; ``n_near``: how many words are one edit away. An empty
    table or one without words gives no rows. Columns other than id and text are not read.
    """
    staging = Staging(docs.sparkSession)
    words = staging.put(word_counts(docs, id_column, text_column), "words")
    pairs = staging.put(near_pairs(words, staging), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.max("near_n").alias("near_n"))
    # the largest count first, then the smallest word (strings compare by UTF-8 bytes: code-point order)
    first = counted.join(best, ["word", "near_n"]).groupBy("word", "near_n", "n_near").agg(F.min("near").alias("top"))
    rows = words.join(first, "word", "left")
    strong = F.col("near_n") >= FORM_RATIO * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("top")).alias("form"), F.when(strong, F.col("near_n")).cast("long").alias("form_n"),
    )
    rows = staging.put(rows, "forms")
    step = rows.select("word", F.coalesce("form", "word").alias("up"))
    rounds = 0
    while True:
        jumped = step.alias("s").join(step.alias("t"), F.col("s.up") == F.col("t.word")).select(F.col("s.word"), F.col("t.up").alias("up"))
        jumped = staging.put(jumped, f"roots{rounds % 2}")
        rounds += 1
        if jumped.join(step, ["word", "up"], "left_anti").isEmpty():
            break
        step = jumped
    return rows.join(step.withColumnRenamed("up", "root"), "word").select(
        "word", "form", "root", F.col("n").cast("long"), "n_near", "form_n"
    )
