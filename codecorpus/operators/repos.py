"""Repository names, URL lists and their lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from codecorpus.functions.text import local_repo_name, repo_url, strip
from codecorpus.operators.lookup import lookup_join
from codecorpus.session import Staging

UNKNOWN_URL = "https://github.com/unknown/unknown"
#: Bytes of names that one automaton holds at most; more names are dealt into buckets.
AUTOMATON_BYTES = 64 << 20


def repo_urls(df: DataFrame, col: str = "name") -> DataFrame:
    """One URL per distinct repository name."""
    return df.select(F.col(col).alias("name")).distinct().select(repo_url(F.col("name")).alias("url"))


def dedup_repo_names(urls: DataFrame) -> DataFrame:
    """``repo_name, line_no, url``: of two owners with one name the first stays."""
    return (
        urls.groupBy(local_repo_name(F.col("url")).alias("repo_name"))
        .agg(F.min(F.struct("line_no", "url")).alias("first"))
        .select("repo_name", "first.line_no", "first.url")
    )


def first_line_containing(
    names: DataFrame, lines: DataFrame, name: str = "repo_name", line: str = "line", most_bytes: int = AUTOMATON_BYTES
) -> DataFrame:
    """``name, url``: the first list line that holds the name, trimmed.

    An Aho-Corasick automaton of the distinct names finds every name in a line in one
    pass over its characters, so the work is linear in the lines (plus the matches).
    The names are broadcast and each task builds the automaton once. Their bytes are
    counted first: beyond ``most_bytes`` they are dealt into buckets by a hash, one
    automaton and one pass over the lines per bucket, so no task holds more than that.
    A line sends one row per name it holds, and the first line per name is taken before
    the shuffle. The empty name is in every line. Null lines hold no name.
    """
    spark = names.sparkSession
    distinct = names.select(F.col(name).alias("_name")).filter("_name IS NOT NULL").distinct()
    distinct = Staging(spark).put(distinct, "names")
    size = distinct.agg(F.sum(F.octet_length("_name") + 64).alias("b")).first().b or 0
    buckets = max(1, -(-size // most_bytes))
    rows = lines.select(F.col("line_no").cast("long").alias("line_no"), F.col(line).cast("string").alias("_line"))
    held = []
    for bucket in range(buckets):
        part = distinct if buckets == 1 else distinct.filter(F.pmod(F.xxhash64("_name"), F.lit(buckets)) == bucket)
        listed = sorted(r._name for r in part.collect())  # at most ``most_bytes``, by the count above
        shared = spark.sparkContext.broadcast(listed)
        held.append(rows.mapInArrow(_matches(shared, f"{id(shared)}:{bucket}"), "_name string, line_no long"))
    found = held[0]
    for more in held[1:]:
        found = found.unionByName(more)
    firsts = found.groupBy("_name").agg(F.min("line_no").alias("line_no"))
    joined = firsts.join(lines.select(F.col("line_no").cast("long").alias("line_no"), line), "line_no")
    return joined.select(F.col("_name").alias(name), strip(F.col(line)).alias("url"))


_automata: dict[str, tuple] = {}


def _matches(shared, key: str):
    def run(batches):
        import ahocorasick
        import pyarrow as pa

        if key not in _automata:
            _automata.clear()
            automaton = ahocorasick.Automaton()
            listed = shared.value
            for at, word in enumerate(listed):
                if word:
                    automaton.add_word(word, at)
            if len(automaton):
                automaton.make_automaton()
            _automata[key] = (automaton, listed, "" in listed)
        automaton, listed, empty = _automata[key]
        for batch in batches:
            got_names, got_lines = [], []
            for no, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text is None:
                    continue
                hits = {listed[at] for _, at in automaton.iter(text)} if len(automaton) else set()
                if empty:
                    hits.add("")
                got_names.extend(hits)
                got_lines.extend([no] * len(hits))
            yield pa.RecordBatch.from_arrays([pa.array(got_names, pa.string()), pa.array(got_lines, pa.int64())], names=["_name", "line_no"])

    return run


def attach_repo_url(
    files: DataFrame, lines: DataFrame, name: str = "repo_name", line: str = "line", exact: bool = False,
    placeholder: str = UNKNOWN_URL,
) -> DataFrame:
    """Add ``repo_url`` to every row, the placeholder where no line fits.

    ``lines`` holds the raw list (``line_no``, text), comments included, as the
    lookup reads them all. By default any line that contains the name fits, so
    ``foo`` may meet ``foobar``; ``exact`` compares the local repository name.
    """
    if exact:
        urls = lines.select("line_no", strip(F.col(line)).alias("url")).filter("url != '' AND url NOT LIKE '#%'")
        found = dedup_repo_names(urls).select(F.col("repo_name").alias(name), "url")
    else:
        found = first_line_containing(files, lines, name, line)
    joined = lookup_join(files, found.withColumnRenamed("url", "repo_url"), [name])
    return joined.withColumn("repo_url", F.coalesce("repo_url", F.lit(placeholder)))
