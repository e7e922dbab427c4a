"""Documents packed into fixed-length training sequences by minimum bin slack.

1. ``token_pieces``: each row's text is encoded by the public byte-level BPE tokenizer
   (no special tokens added), then id 0 closes the document. The ids are those of the
   ``tokenizers`` library with ``byte_bpe_50k.json``; by default they are computed by
   ``tiktoken`` from the same vocabulary's rank file (``byte_bpe_50k.tiktoken``), which
   gives the same ids (tested on every document of the test tables, special-token text
   included) at about a fifth of the CPU time; ``library="tokenizers"`` uses the first. A document
   of more ids than a sequence holds is cut into pieces of ``capacity`` ids and a rest.
   Nothing but numbers leaves the task: per piece its place, length and the CRC-32 of
   its ids.
2. ``pack``: a piece of ``capacity`` ids is a sequence of its own. The others are packed
   per partition of the pieces' table, which never depends on a key, so a hot source
   or a huge group of copies is spread like any other rows. For each new sequence a
   bitset subset-sum over the lengths that remain (each length with its count, split
   in powers of two) finds the multiset that fills the sequence closest to capacity,
   longest lengths first, stopping at an exact fill; the counts per length are read
   back from the saved bitsets. A partition holds only a handful of numbers per piece,
   never texts.

Every sequence is padded to ``capacity`` (1024, a power of two). The padding is what
each partition leaves in its last few sequences plus the slack that no subset closes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY = 1024
#: The id that closes every document.
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: The one special token of the vocabulary; in a text it is read as that token, as ``tokenizers`` does.
SPECIAL = {"<|endoftext|>": 50256}
#: A text longer than this many characters is encoded in parts that end where a pre-token ends.
CHUNK_CHARS = 1 << 20
#: A partition's sequences get ids from ``partition << PART_BITS``.
PART_BITS = 36

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

_encoders: dict[str, object] = {}


def vocabulary_file(library: str = "tiktoken", path: str | None = None) -> bytes:
    """The bytes of the vocabulary file; ``path`` defaults to the public byte-level BPE file of ``library``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(RANKS if library == "tiktoken" else TOKENIZER)
    with open(path, "rb") as f:
        return f.read()


class Encoder:
    """Ids of a text, from the vocabulary file's bytes; built once per process."""

    def __init__(self, library: str, content: bytes):
        if library == "tiktoken":
            import base64

            import public_tokenizers
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
            enc = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
            self.ids = lambda text: enc.encode(text, allowed_special="all")
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_str(content.decode("utf-8"))
            self.ids = lambda text: tok.encode(text, add_special_tokens=False).ids

    @staticmethod
    def shared(library: str, key: str, content) -> Encoder:
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = Encoder(library, content.value)
        return _encoders[key]


def _chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """``text`` in parts at single spaces between two non-space characters: the pre-tokenizer ends a token there anyway."""
    begin = 0
    while len(text) - begin > size:
        cut = begin + size
        while cut < len(text) - 1 and not (text[cut] == " " and not text[cut - 1].isspace() and not text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
            if cut < 0:
                cut = len(text)
        if cut >= len(text) - 1:
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


def encode(enc: Encoder, text: str | None) -> np.ndarray:
    """The ids of one document, id 0 at its end. A null text is empty: its ids are ``[0]``."""
    parts = [np.asarray(enc.ids(p), "<u4") for p in _chunks(text or "")]
    return np.concatenate([*parts, np.array([END_ID], "<u4")])


def token_pieces(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, path: str | None = None,
    library: str = "tiktoken",
) -> DataFrame:
    """Rows ``doc_id, start, length, ids_crc32, doc_tokens``, one per piece of each row of ``docs``.

    Every row is a document, also where rows repeat an id or a text. ``start``: the document's
    ids before the piece; ``doc_tokens``: all its ids, the closing 0 included; ``ids_crc32``:
    unsigned CRC-32 of the piece's ids as little-endian unsigned 32-bit numbers. A null or
    empty text gives one piece ``[0]``. Other columns are not read; an empty table gives none.
    """
    import hashlib

    content = vocabulary_file(library, path)
    key = f"{library}:{hashlib.sha256(content).hexdigest()}"
    shared = docs.sparkSession.sparkContext.broadcast(content)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder.shared(library, key, shared)
        for batch in batches:
            out = {name: [] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(enc, text)
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["length"].append(len(piece))
                    out["ids_crc32"].append(zlib.crc32(piece.tobytes()))
                    out["doc_tokens"].append(len(ids))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(n, pa.int64()) for n in out]))

    return rows.mapInArrow(cut, PIECES)


def fill(counts: np.ndarray, capacity: int) -> np.ndarray:
    """How many pieces of each length go into one sequence: the multiset of ``counts`` whose sum is largest, at most ``capacity``.

    Bitset subset-sum: bit s of ``reach`` says that sum s is possible. Lengths are taken
    longest first, each as powers-of-two bundles of its copies; the search stops at an exact
    fill. The bitsets before each bundle are kept, and the counts are read back from them.
    """
    if capacity <= 0:
        return np.zeros_like(counts)
    top = (1 << (capacity + 1)) - 1
    reach, saved = 1, []
    for length in np.nonzero(counts[: capacity + 1])[0][::-1].tolist():
        if length == 0:
            continue
        left, bundle = min(int(counts[length]), capacity // length), 1
        while left:
            take = min(bundle, left)
            saved.append((reach, length, take))
            reach |= (reach << (take * length)) & top
            left, bundle = left - take, bundle << 1
            if reach >> capacity & 1:
                break
        if reach >> capacity & 1:
            break
    best = reach.bit_length() - 1
    used = np.zeros_like(counts)
    for before, length, take in reversed(saved):
        if not before >> best & 1:
            best -= take * length
            used[length] += take
    return used


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; ``lengths`` in the order that breaks ties (earlier pieces go first).

    Full pieces come first, one sequence each. Each further sequence takes the longest piece left
    and then the multiset of the others that fills it closest to capacity (minimum bin slack).
    """
    n = len(lengths)
    seq, off = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n == 0:
        return seq, off
    order = np.argsort(lengths, kind="stable")
    values, first, many = np.unique(lengths[order], return_index=True, return_counts=True)
    # popped from the end: the earliest piece of a length goes first
    by_length = {v: order[f : f + m].tolist()[::-1] for v, f, m in zip(values.tolist(), first.tolist(), many.tolist(), strict=True)}
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    made = 0
    for i in by_length.pop(capacity, [])[::-1]:
        seq[i], made = made, made + 1
    counts[capacity] = 0
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])  # every sequence holds the longest piece left, so none is stranded
        counts[longest] -= 1
        used = fill(counts, capacity - longest)
        used[longest] += 1
        counts[longest] += 1
        at = 0
        for length in np.nonzero(used)[0][::-1].tolist():
            for _ in range(int(used[length])):
                i = by_length[length].pop()
                seq[i], off[i] = made, at
                at += length
        counts -= used
        made += 1
    return seq, off


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The columns of ``pieces`` with ``sequence_id`` and ``offset`` (gapless from 0 in a sequence).

    ``pieces`` needs ``doc_id, start, length`` with 1 <= length <= capacity; ties are broken by
    ``doc_id`` (nulls last), ``start`` and the columns' order. Sequences of one partition share
    the high bits of their id. A partition holds its pieces' numbers only.
    """
    if "sequence_id" in pieces.columns or "offset" in pieces.columns:
        pieces = pieces.drop("sequence_id", "offset")
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = pieces.columns
    arrow = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in pieces.schema])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=arrow)
        if table.num_rows == 0:
            return
        ids = table.column("doc_id")
        missing = pc.is_null(ids).to_numpy(zero_copy_only=False)
        doc = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start = pc.fill_null(table.column("start"), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = table.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.lexsort((start, doc, missing))
        seq, off = pack_lengths(lengths[order], capacity)
        part = np.int64(TaskContext.get().partitionId()) << PART_BITS
        table = table.take(pa.array(order))
        table = table.append_column("sequence_id", pa.array(seq + part)).append_column("offset", pa.array(off))
        yield from table.select([*names, "sequence_id", "offset"]).to_batches()

    return pieces.mapInArrow(packed, schema)


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def packed_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``token_pieces`` then ``pack``: rows ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    return pack(token_pieces(docs, id_column, text_column, capacity), capacity)
