import itertools

from codecorpus.llm import near_copies
from tests.llm.test_simhash import near_copies as copies


def plain_roots(texts, words=5, similarity=0.8):
    """The group of each text, by the Jaccard similarity of all pairs."""
    sets = []
    for t in texts:
        parts = t.encode().lower().split()
        sets.append({tuple(parts[k : k + words]) for k in range(max(1, len(parts) - words + 1))} if parts else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return [find(x) for x in range(len(texts))]


def test_stage_equals_jaccard_of_all_pairs(spark, sf):
    made = copies(7, 300)
    tables = spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()
    texts = [*made, *(r.text or "" for r in tables), "", " \t", "one two", "One  two", "one two three"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in near_copies.one_of_each(docs).collect()}
    want = plain_roots(texts)
    assert kept == set(want) and len(kept) < len(texts)
    groups = {}
    for r in near_copies.near_copies(docs).collect():
        groups.setdefault(r.root, set()).add(want[r.doc_id])
    assert all(len(x) == 1 for x in groups.values())


def test_the_order_of_shingles_changes_no_link(spark, monkeypatch):
    texts = copies(11, 150)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for common in (1, 1 << 30):
        monkeypatch.setattr(near_copies, "COMMON", common)
        assert {r.doc_id for r in near_copies.one_of_each(docs).collect()} == set(plain_roots(texts))


def test_odd_rows(spark, odd_docs):
    kept = near_copies.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.filter("trim(coalesce(text, '')) in ('', '\t\n')").count() == 1
    assert near_copies.one_of_each(odd_docs.filter("false")).count() == 0
