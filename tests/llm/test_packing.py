import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from codecorpus.llm import packing, queries

TOK = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_pieces(rows, capacity=1024):
    """Each row's ids, then 0, cut into pieces of ``capacity``."""
    out = []
    for doc, text in rows:
        ids = TOK.encode(text or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), capacity):
            piece = ids[start : start + capacity]
            out.append((doc, start, len(piece), zlib.crc32(np.asarray(piece, "<u4").tobytes()), len(ids)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))


def check_sequences(found, capacity=1024):
    by_seq = {}
    for r in found:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(x[1] for x in parts) <= capacity
        assert all(a[0] + a[1] == b[0] for a, b in itertools.pairwise(parts))
    return by_seq


def test_fill_equals_best_subset():
    rng = random.Random(3)
    for _ in range(400):
        capacity = rng.randint(5, 90)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = np.bincount(lengths, minlength=capacity + 1)
        used = packing.fill(counts.copy(), capacity)
        best = max(sum(c) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if sum(c) <= capacity)
        assert int((used * np.arange(len(used))).sum()) == best and (used <= counts).all()


def test_pack_lengths_uses_each_piece_once():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 1025, 3000)
    seq, off = packing.pack_lengths(lengths)
    for s in np.unique(seq):
        parts = sorted(zip(off[seq == s], lengths[seq == s], strict=True))
        assert parts[0][0] == 0 and sum(p[1] for p in parts) <= 1024
        assert all(a[0] + a[1] == b[0] for a, b in itertools.pairwise(parts))
    bound = max(lengths.sum() / 1024, (lengths > 512).sum())  # no two pieces over half a sequence share one
    assert seq.max() + 1 <= 1.06 * bound + 1


def test_query_equals_plain_encoding(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = queries.op13_packing(spark, sf).collect()
    assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found), key=lambda r: (r[0], r[1], r[3])) == plain_pieces(rows)
    by_seq = check_sequences(found)
    total = sum(r.length for r in found)
    assert len(by_seq) * 1024 <= 1.05 * total + 1024 * spark.read.parquet(f"{sf}/documents.parquet").rdd.getNumPartitions()


def test_long_texts_are_encoded_in_parts_alike(monkeypatch):
    text = "Lorem ipsum, dolor  sit amet.\n  Ünïcode 12 345 words'll end   here " * 400
    enc = packing.Encoder("tokenizers", packing.vocabulary_file("tokenizers"))
    whole = packing.encode(enc, text)
    monkeypatch.setattr(packing, "CHUNK_CHARS", 50)
    parts = list(packing._chunks(text, 50))
    assert len(parts) > 100 and "".join(parts) == text
    assert np.array_equal(np.concatenate([packing.encode(enc, p)[:-1] for p in parts] + [np.array([0], "<u4")]), whole)


def test_both_libraries_give_the_same_ids(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["a<|endoftext|>b", " <|endoftext|> x", "漢字 ▁ ﬁ É\u0001x\u0000y 🎉", "it's 12,345.6 'll  \r\n", "   ", None]
    fast = packing.Encoder("tiktoken", packing.vocabulary_file("tiktoken"))
    plain = packing.Encoder("tokenizers", packing.vocabulary_file("tokenizers"))
    assert all(np.array_equal(packing.encode(fast, t), packing.encode(plain, t)) for t in texts)


def test_odd_rows(spark, odd_docs, odd_rows):
    pieces = packing.token_pieces(odd_docs)
    assert sorted(map(tuple, packing.token_pieces(odd_docs, library="tokenizers").collect()), key=lambda r: tuple(-1 if x is None else x for x in r)) == sorted(
        map(tuple, pieces.collect()), key=lambda r: tuple(-1 if x is None else x for x in r)
    )
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, pieces.collect()), key=key) == sorted(plain_pieces([r[:2] for r in odd_rows]), key=key)
    found = packing.pack(pieces).collect()
    assert len(found) == len(pieces.collect())
    check_sequences(found)
    assert packing.packed_documents(odd_docs.filter("false")).count() == 0
