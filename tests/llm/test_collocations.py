import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

from codecorpus.llm import collocations, queries
from codecorpus.llm.oracles import SQL


def test_tile_count_equals_counter():
    rng = np.random.default_rng(2)
    first, second = rng.zipf(1.3, 20_000) % 500, rng.zipf(1.3, 20_000) % 500
    codes, counts = collocations.tile_count(first, second, 500, dense=16)
    assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == Counter((first * 500 + second).tolist())
    assert list(codes) == sorted(codes)


def test_batch_counts_equal_plain_counts():
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(40)]
    pieces = [[rng.choice(vocab[: rng.randint(1, 40)]) for _ in range(rng.randint(1, 12))] for _ in range(400)]
    want = Counter()
    for p in pieces:
        for k in (1, 2, 3):
            want.update((k, " ".join(p[i : i + k])) for i in range(len(p) - k + 1))
    got = {(r["n_words"], r["phrase"]): r["c"] for b in collocations.count_batch("en", pieces) for r in b.to_pylist()}
    assert got == dict(want)


def test_words_of():
    assert collocations.words_of("Ab\tCD é. x,\ny  z!") == [["ab", "cd", "é"], ["x"], ["y", "z"]]
    assert collocations.words_of(None) == []


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(SQL["op12_collocations"]).fetchall())
    got = sorted(tuple(r) for r in queries.op12_collocations(spark, sf).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == want and len(got) > 0


def test_odd_rows(spark, odd_docs):
    many = odd_docs.unionByName(odd_docs.filter("doc_id = 5"))
    found = collocations.collocations(many, min_count=2).collect()
    assert {r.lang for r in found} <= {"en", "de", "und"} and any(r.phrase == "lorem ipsum dolor" for r in found)
    assert not any(r.phrase == "lorem ipsum" for r in found)  # as often as a longer candidate that holds it
    assert all(r.score <= 1_000_000 and r.a >= 2 for r in found)
    assert collocations.collocations(odd_docs.filter("false")).count() == 0


def test_words_in_equals_words_of():
    texts = ["Ab\tCD é. x,\ny  z!", None, "", " \t", "É\u0001x\u0000y 🎉 Q\x0b漢 a:b;c?D", "last word"]
    words, linked, row = collocations.words_in(pa.array(texts, pa.string()))
    pieces, words = {}, words.to_pylist()
    for p, word in enumerate(words):
        if p and linked[p - 1]:
            pieces[row[p]][-1].append(word)
        else:
            pieces.setdefault(row[p], []).append([word])
    assert [pieces.get(k, []) for k in range(len(texts))] == [collocations.words_of(t) for t in texts]


def test_only_frequent_phrases_are_summed(spark, monkeypatch):
    """Rare phrases stay in their tasks as hashes; those that are frequent only over all tasks are found."""
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(2000)]
    docs = [(" ".join(rng.choice(vocab[: rng.randint(1, 2000)]) for _ in range(30)) + f". seen once a text{k % 2}", rng.choice(["en", "de", None])) for k in range(3000)]
    want = Counter()
    for text, lang in docs:
        for p in collocations.words_of(text):
            want[lang or "und", 0, ""] += len(p)
            want.update((lang or "und", k, " ".join(p[i : i + k])) for k in (1, 2, 3) for i in range(len(p) - k + 1))
    frequent = {key: n for key, n in want.items() if n >= 10}
    df = spark.createDataFrame(docs, "text string, lang string").repartition(6)
    monkeypatch.setattr(collocations, "BATCH_BYTES", 20_000)
    found = {(r.lang, r.n_words, r.phrase): r.f for r in collocations.phrase_counts(df, min_count=10).collect()}
    assert found == frequent
    assert {(r.lang, r.n_words, r.phrase): r.f for r in collocations.phrase_counts(df).collect()} == want
    rows = df.selectExpr("text", "coalesce(lang, 'und') AS lang")
    kept = sum(len(r["cells"]) // 8 for r in collocations.frequent_cells(rows, 10).collect())
    assert kept == len(frequent) - 3 < len(want) / 10  # without the three totals
