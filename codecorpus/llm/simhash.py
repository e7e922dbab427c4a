"""Near-duplicate documents by SimHash and a Gray-ordered hierarchical index.

A fingerprint bit is 1 if it is set in over half of the hashes of the document's
shingles. Documents link if their fingerprints differ in few bits.

The search for links works on distinct fingerprints, so copies cost nothing:

1. Two fingerprints that differ in at most ``max_bits`` bits agree in one of
   ``max_bits + 1`` blocks of bits. Each fingerprint is dealt out once per block,
   by the block's value, rotated so that the block leads. A value that holds more
   than ``cell_rows`` fingerprints is cut into chunks, and each pair of chunks is
   a cell of its own: no task holds a hot value, and no pair is lost.
2. A task sorts its fingerprints by Gray rank, so that neighbours share bits.
   Upper nodes hold the bits that all fingerprints below them share (a mask and
   a pattern). Pairs of nodes are walked from the top; where the differences in
   the shared bits exceed the limit, the whole pair of groups is pruned.
3. A task returns no pairs but a star for each set that it has linked, at most one
   row per fingerprint and cell. Rounds of star contraction join these to
   components; each round is a table in the shared folder.

Nothing is gathered on the driver but row counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codecorpus.llm.common import Staging, fresh, release_memory

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
#: Fingerprints of one block value that a task compares among themselves.
CELL_ROWS = 4096
FAN_OUT = 16
#: Pairs of nodes that a task holds at a time.
PAIRS_AT_ONCE = 1 << 20
BLOCK = 1 << 15


def fingerprint_of(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of one UTF-8 text as an unsigned 64-bit number; 0 without words.

    ``bytes.split`` and ``bytes.lower`` know ASCII white space and letters only.
    """
    parts = text.lower().split() if text else []
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        starts, ends = starts[: 1 - words], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, n = xxhash.xxh64_intdigest, len(starts)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The SimHash of a text as a signed ``bigint``; null has no words."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint_of(t, words) for t in texts), np.uint64, len(texts))
        release_memory()
        return pd.Series(found.view(np.int64))

    return of(text.cast("binary"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayTree:
    """Codes in Gray order below nodes that hold the bits shared by all codes under them."""

    def __init__(self, codes: np.ndarray, fan: int = FAN_OUT):
        self.codes, self.fan = codes[np.argsort(gray_rank(codes), kind="stable")], fan
        self.levels = [(self.codes, self.codes)]  # AND and OR of what lies below
        while len(self.levels[-1][0]) > fan:
            low, high = self.levels[-1]
            at = np.arange(0, len(low), fan)
            self.levels.append((np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)))

    def near(self, level: int, a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
        """Where the shared bits of two nodes differ in no more than ``max_bits``."""
        low, high = self.levels[level]
        # a bit differs for sure if it is 1 in all of one side and 0 in all of the other
        return np.bitwise_count((low[a] & ~high[b]) | (low[b] & ~high[a])) <= max_bits

    def components(self, max_bits: int = MAX_BITS) -> np.ndarray:
        """For each code the index of the first code of its component."""
        n = len(self.codes)
        root = np.arange(n)
        top = len(self.levels) - 1
        a, b = np.triu_indices(len(self.levels[top][0]))
        stack = [(top, a, b)]
        at_once = max(1, PAIRS_AT_ONCE // self.fan**2)
        while stack:
            level, a, b = stack.pop()
            if level and len(a) > at_once:
                stack.append((level, a[at_once:], b[at_once:]))
                a, b = a[:at_once], b[:at_once]
            keep = self.near(level, a, b, max_bits)
            a, b = a[keep], b[keep]
            if not level:
                root = joined(root, a, b)
                continue
            if level == 1:  # groups that are one component already have nothing to add
                starts = np.arange(0, n, self.fan)
                first, last = np.minimum.reduceat(root, starts), np.maximum.reduceat(root, starts)
                open_ = (first[a] != last[a]) | (first[b] != last[b]) | (first[a] != first[b])
                a, b = a[open_], b[open_]
            if not len(a):
                continue
            child = np.arange(self.fan)
            below = len(self.levels[level - 1][0])
            a = (a[:, None, None] * self.fan + child[None, :, None] + 0 * child[None, None, :]).ravel()
            b = (b[:, None, None] * self.fan + child[None, None, :] + 0 * child[None, :, None]).ravel()
            keep = (a < below) & (b < below) & (a < b if level == 1 else a <= b)
            stack.append((level - 1, a[keep], b[keep]))
        return root


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Components after linking each ``a`` with its ``b``; a component is named by its least index."""
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return root
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        parent = np.arange(len(root))
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(parent, shorter := parent[parent]):
            parent = shorter
        root = parent[root]


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """First bit (from the top) and width of ``max_bits + 1`` blocks that cover 64 bits."""
    edges = [round(64 * k / (max_bits + 1)) for k in range(max_bits + 2)]
    return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]


def links(codes: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``codes``: distinct ``fp``. Rows ``a, b``: stars whose components are those of all links.

    Every two fingerprints within ``max_bits`` end in one component, no others do.
    """
    parts = blocks(max_bits)
    value = [F.shiftrightunsigned("fp", 64 - at - width).bitwiseAND(F.lit((1 << width) - 1)) for at, width in parts]
    dealt = codes.select(
        "fp", F.explode(F.array(*(F.struct(F.lit(k).alias("turn"), v.alias("value")) for k, v in enumerate(value)))).alias("x")
    ).select("fp", "x.turn", "x.value")
    hot = (
        dealt.groupBy("turn", "value").agg(F.count("*").alias("rows")).filter(F.col("rows") > cell_rows)
        .select("turn", "value", F.ceil(F.col("rows") / cell_rows).cast("int").alias("chunks"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    cells = (
        dealt.join(hot, ["turn", "value"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("own", own).withColumn("other", other)
        .withColumn("cell", F.when(F.col("chunks") == 1, F.lit(0).cast("long")).otherwise(
            1 + F.least("own", "other").cast("long") * F.col("chunks") + F.greatest("own", "other")))
        .select("fp", "turn", "value", "cell")
    )

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(x["fp"].to_numpy(), x["turn"].to_numpy(), x["value"].to_numpy(), x["cell"].to_numpy()) for x in batches]
        if not got:
            return
        fp, turn, value, cell = (np.concatenate(x) for x in zip(*got, strict=True))
        value = np.where(cell == 0, 0, value)  # values that are no hot ones share a tree
        order = np.lexsort((cell, value, turn))
        new = np.any([np.diff(x[order], prepend=x[order][:1] - 1) != 0 for x in (turn, value, cell)], axis=0)
        for rows in np.split(order, np.flatnonzero(new)[1:]):
            shift = np.uint64(parts[turn[rows[0]]][0])
            code = fp[rows].view(np.uint64)
            code = (code << shift) | (code >> (np.uint64(64) - shift)) if shift else code
            tree = GrayTree(code)
            root = tree.components(max_bits)
            member = np.flatnonzero(root != np.arange(len(root)))
            if len(member):
                back = lambda x, s=shift: ((x >> s) | (x << (np.uint64(64) - s)) if s else x).view(np.int64)
                yield pa.record_batch({"a": back(tree.codes[member]), "b": back(tree.codes[root[member]])})
        del fp, turn, value, cell, got
        release_memory()

    return cells.repartition("turn", "value", "cell").mapInArrow(stars, "a bigint, b bigint")


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """``edges``: ``a, b``. Rows ``node, root``: each linked node and the least node it reaches.

    Alternating large and small stars until nothing changes. A round is staged, so
    lineage stays short and lost executors cost one round at most.
    """
    state = staging.put(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges0")
    before, rounds = None, 0
    while True:
        seen = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, rounds = seen, rounds + 1
        both = state.union(state.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m")).filter("a > b").distinct()
        state = staging.put(small, f"edges{rounds % 2 + 1}")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Rows ``doc_id, fp, component_id, text_hash, root``, one for each row of ``docs``.

    ``component_id`` is the least id reachable over links, the row's own included; ``root``
    names the component even where no id does. A null id is never the least; a component
    of null ids alone has a null ``component_id``. A null or empty text has fingerprint 0
    and links like any other. Repeated rows stay. Other columns are not read.
    """
    staging = Staging(docs.sparkSession)
    text = F.col(text_column)
    prints = staging.put(
        docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("text_hash"), fingerprint(text, words).alias("fp")), "prints"
    )
    nodes = staging.put(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = components(links(nodes.select("fp"), max_bits, cell_rows), staging)
    member = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    class_id = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(member.join(class_id, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "fp", "component_id", "text_hash", "root"
    )


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """The columns of ``docs``, one row for each component: the first by id (null ids last), then by text hash.

    Inner columns get names that no column of ``docs`` has. An empty table gives an empty table.
    """
    found = near_duplicates(docs, id_column, text_column, words=words, max_bits=max_bits)
    return first_of_each(docs, found, id_column, text_column)


def first_of_each(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``found``: ``doc_id, text_hash, root`` for each row of ``docs``. The columns of ``docs``, the first row of each root.

    Rows that repeat both id and text are one document; any one of them stays.
    """
    staging = Staging(docs.sparkSession)
    id_, hash_, n_ = (fresh(docs.columns, f"__{x}") for x in ("id", "hash", "n"))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    first = found.groupBy("root").agg(F.min(key).alias("k"), F.count("*").alias("n"))
    first = staging.put(first.select(F.col("k.doc_id").alias(id_), F.col("k.text_hash").alias(hash_), F.col("n").alias(n_)), "first")
    same = F.col(id_column).eqNullSafe(F.col(id_)) & (F.xxhash64(text_column) == F.col(hash_))
    alone = docs.join(first.filter(F.col(n_) == 1), same, "left_semi")
    grouped = docs.join(first.filter(F.col(n_) > 1), same, "left_semi")  # far fewer rows, so these alone are made unique
    once = grouped.withColumns({id_: F.col(id_column), hash_: F.xxhash64(text_column)}).dropDuplicates([id_, hash_])
    return alone.unionByName(once.drop(id_, hash_))
