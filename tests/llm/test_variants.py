import itertools
import random
import re
import zlib
from collections import Counter

from codecorpus.llm import queries, variants


def plain_words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n):
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, ns in near.items():
        if ns:
            top = min(ns, key=lambda x: (-n[x], x))
            form[w] = top if n[top] >= 5 * n[w] else None
        else:
            form[w] = None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def test_affected_bounds_the_grams_that_one_edit_changes():
    rng = random.Random(1)
    letters = "abcdé"
    frequent = {a + b for a in letters for b in letters if rng.random() < 0.5}
    for _ in range(40000):
        if rng.random() < 0.01:
            frequent = {a + b for a in letters for b in letters if rng.random() < rng.random()}
        w = "".join(rng.choice(letters[: rng.randint(2, 5)]) for _ in range(rng.randint(6, 12)))
        p = rng.randrange(len(w) + 1)
        c = rng.choice(letters)
        r = rng.choice([w[:p] + c + w[p:], w[:p] + w[p + 1 :], w[:p] + c + w[p + 1 :]])
        if len(r) < 6:
            continue
        gw, gr = Counter(variants.decompose(w, frequent)), Counter(variants.decompose(r, frequent))
        nag = variants.affected(list(variants.decompose(w, frequent)), len(w))
        assert sum((gw & gr).values()) >= sum(gw.values()) - nag >= 1


def test_query_equals_all_pairs(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = plain_variants(plain_words(rows))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in queries.op11_variants(spark, sf).collect()}
    assert got == want and any(v[0] for v in want.values())


def test_made_variants(spark):
    rng = random.Random(3)
    base = ["library", "colour", "organisation", "behaviour", "théâtre"]
    texts = []
    for w in base:
        texts += [w] * 40
        for _ in range(12):
            p = rng.randrange(len(w))
            texts += [w[:p] + w[p + 1 :], w[:p] + "x" + w[p:], w[:p] + "z" + w[p + 1 :]] * 5
    rng.shuffle(texts)
    rows = [(i, " ".join(texts[i : i + 7])) for i in range(0, len(texts), 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.variants(docs).collect()}
    assert got == plain_variants(plain_words(rows))
    assert got["colour"][0] is None and any(v[1] == "colour" for k, v in got.items() if k != "colour")


def test_odd_rows(spark, odd_docs, odd_rows):
    many = odd_docs.unionByName(odd_docs)
    for _ in range(2):
        many = many.unionByName(many)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.variants(many).collect()}
    assert got == plain_variants(plain_words([r[:2] for r in odd_rows] * 8))
    assert variants.variants(odd_docs.filter("false")).count() == 0
