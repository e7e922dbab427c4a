"""Near copies: texts whose sets of word shingles have a Jaccard similarity of at least a limit.

The search is exact. At a similarity of 0.8 two 64-bit SimHashes differ in about 10 bits and
often in 17; blocks for such a limit are 3 or 4 bits wide, so that search would compare nearly
all pairs. Here the sets themselves are searched, by their prefixes:

1. Shingles have one order for all texts: by their hash, those that a sample finds common
   last. Of two sets with similarity s or more, the first |x| - ceil(s |x|) + 1 shingles of
   each have one in common. Sets that share such a shingle are a bucket; equal buckets are one.
2. In each bucket every set is compared with the first one and the one before it, by exact
   Jaccard similarity. Links that hold are joined to components.
3. Then all pairs of a bucket are compared that lie in different components and whose sizes
   allow the similarity. So a large group of near copies costs two comparisons a member and
   bucket, and no pair is left out.

The order decides how much is compared, never what is found. Sets are known by a hash of
their shingles, so texts with equal sets are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codecorpus.llm import simhash
from codecorpus.llm.common import Staging

WORDS = 5
SIMILARITY = 0.8
#: Texts of the sample that finds common shingles, about; how often a common one is there; how many are known, at most.
SAMPLE = 20_000
COMMON = 4
MOST_COMMON = 1 << 16
#: Pairs of one output batch.
PAIRS_AT_ONCE = 1 << 16


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a UTF-8 text's shingles; a shorter text is one shingle, one without words has none."""
    parts = text.lower().split() if text else []
    if not parts:
        return np.zeros(0, np.int64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = (starts[: 1 - words or None], ends[words - 1 :]) if len(parts) > words else (starts[:1], ends[-1:])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends.tolist(), strict=True)
    return np.unique(np.fromiter((digest(joined[s:e], simhash.SEED) for s, e in spans), np.uint64, len(starts)).view(np.int64))


def needed(size: int | np.ndarray, similarity: float):
    """The least overlap with a set of ``size`` that allows the similarity. Rounding errors never raise it."""
    return np.ceil(np.asarray(size) * similarity - 1e-9).astype(np.int64)


def prefix(found: np.ndarray, common: np.ndarray, rank: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a sorted set: ``common`` ones (sorted, with their ``rank``) come last."""
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        found = found[np.argsort(np.where(common[at] == found, rank[at] + 1, 0), kind="stable")]
    return found[: len(found) - int(needed(len(found), similarity)) + 1]


def node_of(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), simhash.SEED)).view(np.int64))


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """``texts``: ``node, text``. Rows ``node, shingles``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = [shingles(x.as_py(), words) for x in part["text"]]
                yield pa.record_batch({"node": part["node"], "shingles": pa.array(found, pa.list_(pa.int64()))})

    return texts.select("node", F.col("text").cast("binary").alias("text")).mapInArrow(run, "node bigint, shingles array<bigint>")


def nodes_of(docs: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """Rows ``doc_id, text_hash, node, size``."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(node_of(s), len(s)) for s in (shingles(x.as_py(), words) for x in batch["text"])]
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "text_hash": batch["text_hash"],
                "node": np.array([n for n, _ in found], np.int64), "size": np.array([s for _, s in found], np.int64)})

    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash bigint, node bigint, size bigint")


def common_shingles(sets: DataFrame, most: int = MOST_COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that stand in ``COMMON`` sets or more, sorted, and their rank by that number."""
    counts = sets.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON)
    got = counts.orderBy(F.desc("n"), "s").limit(most).toPandas()
    common, n = got["s"].to_numpy(np.int64), got["n"].to_numpy(np.int64)
    order = np.argsort(common)
    return common[order], n[order]


def buckets(texts: DataFrame, words: int, similarity: float, common: np.ndarray, rank: np.ndarray) -> DataFrame:
    """Rows ``bucket, members``: sets (``size, node``, sorted) that share a shingle of their prefixes, each collection once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [shingles(x.as_py(), words) for x in part["text"]]
                keys = [prefix(s, common, rank, similarity) if len(s) else s for s in sets]
                times = list(map(len, keys))
                yield pa.record_batch({
                    "key": np.concatenate(keys), "node": np.repeat(part["node"].to_numpy(), times),
                    "size": np.repeat(np.array(list(map(len, sets)), np.int64), times)})

    keys = texts.select("node", F.col("text").cast("binary").alias("text")).mapInArrow(run, "key bigint, node bigint, size bigint")
    found = keys.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("size", "node"))).alias("members")).filter(F.size("members") > 1)
    return found.groupBy(F.xxhash64("members").alias("bucket")).agg(F.first("members").alias("members"))


def allowed(small: np.ndarray, large: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sizes allow the similarity."""
    return small >= needed(large, similarity)


def flat(batch: pa.RecordBatch, *fields: str) -> Iterator[tuple[np.ndarray, ...]]:
    """The fields of all members of a batch's buckets, one bucket after the other, and where each begins and the last ends."""
    members = batch["members"]
    at = members.offsets.to_numpy()
    if len(members):
        inner = members.flatten()
        yield *(inner.field(x).to_numpy(zero_copy_only=False) for x in fields), at - at[0]


def first_pairs(found: DataFrame, similarity: float) -> DataFrame:
    """Rows ``a, b``: each member of a bucket with the one before it, and with the first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, node, at in (x for batch in batches for x in flat(batch, "size", "node")):
            last = np.setdiff1d(np.arange(len(node)), at[:-1])
            first = at[np.searchsorted(at, last, side="right") - 1]
            a, b = np.concatenate((last - 1, first)), np.concatenate((last, last))
            keep = allowed(size[a], size[b], similarity)
            if keep.any():
                yield pa.record_batch({"a": np.maximum(node[a], node[b])[keep], "b": np.minimum(node[a], node[b])[keep]})

    return found.select("members").mapInArrow(run, "a bigint, b bigint").distinct()


def other_pairs(found: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Rows ``a, b``: the pairs of a bucket that lie in different components."""
    rows = found.select("bucket", F.explode("members").alias("x")).select("bucket", "x.size", "x.node")
    rows = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = rows.groupBy("bucket").agg(
        F.sort_array(F.collect_list(F.struct("size", "node", "root"))).alias("members"), F.min("root").alias("low"), F.max("root").alias("high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, held = [], 0
        out = lambda: pa.record_batch({"a": np.concatenate([x for x, _ in got]), "b": np.concatenate([x for _, x in got])})
        for sizes, nodes, roots, edges in (x for batch in batches for x in flat(batch, "size", "node", "root")):
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                size, node, root = sizes[low:high], nodes[low:high], roots[low:high]
                ends = np.searchsorted(size, np.floor(size / similarity + 1e-9), side="right")
                for k in range(len(node)):
                    at = np.arange(k + 1, ends[k])
                    at = at[root[at] != root[k]]
                    got.append((np.maximum(node[at], node[k]), np.minimum(node[at], node[k])))
                    held += len(at)
                    if held >= PAIRS_AT_ONCE:
                        yield out()
                        got, held = [], 0
        if held:
            yield out()

    return open_.filter("low < high").select("members").mapInArrow(run, "a bigint, b bigint").distinct()


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets have at least the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(one, "a").join(two, "b").withColumn("same", F.size(F.array_intersect("sa", "sb")))
    return both.filter(F.col("same") >= (F.size("sa") + F.size("sb") - F.col("same")) * similarity - 1e-9).select("a", "b")


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Rows ``doc_id, text_hash, root``, one for each row of ``docs``; ``root`` names the component of all pairs with the similarity.

    Words are split at ASCII white space, ASCII letters count as lower case. Null, empty and blank texts are one component.
    """
    staging = Staging(docs.sparkSession)
    rows = staging.put(nodes_of(docs, words, id_column, text_column), "rows")
    nodes = staging.put(rows.filter("size > 0").groupBy("node").agg(F.min("text_hash").alias("text_hash")), "nodes")
    once = docs.select(F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text"))
    one_text = lambda known: once.join(known, "text_hash").select("node", "text")  # noqa: E731  a repeated text repeats its node
    share = SAMPLE / max(1, nodes.count())
    sample = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < share * (1 << 20))
    common, rank = common_shingles(shingle_sets(one_text(sample).dropDuplicates(["node"]), words))
    found = staging.put(buckets(one_text(nodes).dropDuplicates(["node"]), words, similarity, common, rank), "buckets")
    there = staging.put(found.select(F.explode("members.node").alias("node")).distinct().join(nodes, "node"), "there")
    sets = staging.put(shingle_sets(one_text(there).dropDuplicates(["node"]), words), "sets")
    links = staging.put(verified(first_pairs(found, similarity), sets, similarity), "links")
    roots = staging.put(simhash.components(links, Staging(docs.sparkSession)), "roots")
    more = staging.put(verified(other_pairs(found, roots, similarity), sets, similarity), "more")
    roots = simhash.components(links.unionByName(more), Staging(docs.sparkSession))
    return rows.join(roots, "node", "left").select("doc_id", "text_hash", F.coalesce("root", "node").alias("root"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The columns of ``docs``, one row for each component: the first by id (null ids last), then by text hash."""
    return simhash.first_of_each(docs, near_copies(docs, id_column, text_column, words, similarity), id_column, text_column)
