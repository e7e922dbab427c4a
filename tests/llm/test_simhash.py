import random

import numpy as np
import pytest
import xxhash

from codecorpus.llm import queries, simhash


def plain_fingerprint(text, words=4):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    found = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def plain_components(prints, limit=4):
    """The component of each fingerprint, by comparing all pairs."""
    codes = sorted(set(prints))
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[i + 1 :]:
            if (a ^ b).bit_count() <= limit:
                root[find(b)] = find(a)
    return {c: find(c) for c in codes}


def near_copies(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    texts = []
    for _ in range(n):
        words = list(base) if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    return texts


def check(rows, found):
    prints = {r.doc_id: r.fp & (2**64 - 1) for r in found}
    assert all(prints[i] == plain_fingerprint(t) for i, t in rows)
    roots = plain_components(prints.values())
    least = {}
    for i, f in prints.items():
        least[roots[f]] = min(i, least.get(roots[f], i))
    assert {r.doc_id: r.component_id for r in found} == {i: least[roots[f]] for i, f in prints.items()}


@pytest.mark.parametrize("cell_rows", [4096, 4])
def test_components_equal_all_pairs(spark, cell_rows):
    rows = list(enumerate(near_copies(3)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, simhash.near_duplicates(docs, cell_rows=cell_rows).collect())


def test_tree_equals_all_pairs():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**64, 30, dtype=np.uint64)
    codes = np.unique(np.concatenate([centres[rng.integers(0, 30, 1500)] ^ (np.uint64(1) << rng.integers(0, 64, 1500, dtype=np.uint64)) for _ in range(2)] + [centres]))
    tree = simhash.GrayTree(codes, fan=4)
    want = plain_components([int(c) for c in tree.codes])
    root = tree.components(4)
    groups = {}
    for code, r in zip(tree.codes.tolist(), root.tolist(), strict=True):
        groups.setdefault(want[code], set()).add(r)
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_odd_rows(spark, odd_docs, odd_rows):
    found = simhash.near_duplicates(odd_docs).collect()
    assert len(found) == len(odd_rows)
    empty = [r for r in found if r.fp == 0]
    # null, empty and blank texts are linked to each other; a null id names no component
    assert len(empty) == 4 and {r.component_id for r in empty} == {2}
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.select("doc_id").collect()).count((False, 1)) == 2  # two different texts
    assert kept.filter("trim(coalesce(text, '')) in ('', '\t\n')").count() == 1
    nothing = odd_docs.filter("false")
    assert simhash.near_duplicates(nothing).count() == simhash.one_of_each(nothing).count() == 0


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = queries.op1_simhash(spark, sf).collect()
    check(rows, [type("R", (), {"doc_id": r.doc_id, "fp": int(r.fingerprint, 16), "component_id": r.component_id}) for r in found])
