import hashlib
import itertools
import random
from collections import Counter


from codecorpus.llm import decontaminate, queries, url_rules
from tests.llm.test_texts import words_of


def plain_hits(docs, items, size=10):
    """n_words, n_hit and item ids for each document, by trying every window at every place."""
    wanted = {}
    for item, text in items:
        w = words_of(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wanted.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    lengths = {len(k) for k in wanted}
    out = []
    for doc, text in docs:
        w, hit, names = words_of(text), set(), set()
        for n, i in ((n, i) for n in lengths for i in range(len(w) - n + 1)):
            if (key := tuple(w[i : i + n])) in wanted:
                hit.update(range(i, i + n))
                names |= wanted[key]
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def made(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c d e f g hh ii jj kk ll".split())
    items = [(i, " ".join(word() for _ in range(rng.randrange(0, 25)))) for i in range(12)] + [(None, "a b"), (3, "zz zz zz"), (7, None), (8, "")]
    docs = []
    for i in range(60):
        w = [word() for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            passage = rng.choice(items)[1] or ""
            w[5:5] = passage.upper().split()[rng.randrange(3) :]
        docs.append((i, ", ".join(w)))
    docs += [(1, docs[3][1]), (3, docs[3][1]), (None, docs[6][1]), (99, None), (5, "zz zz zz zz zz")]
    return docs, items


def test_hits_equal_every_window(spark):
    docs, items = made(1)
    found = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(tuple(r) for r in found.select(*COLUMNS).collect()) == plain_hits(docs, items)


def test_hits_do_not_depend_on_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    docs, items = made(2)
    found = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(tuple(r) for r in found.select(*COLUMNS).collect()) == plain_hits(docs, items)


def test_decontamination_of_odd_rows(spark, odd_docs, odd_rows):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog")], "item_id long, text string")
    found = decontaminate.contamination(odd_docs, items)
    assert found.count() == len(odd_rows) and found.filter("contaminated").count() == 3
    clean = decontaminate.clean_of(odd_docs, items)
    assert clean.columns == odd_docs.columns and clean.count() == len(odd_rows) - 3
    assert decontaminate.contamination(odd_docs.filter("false"), items).count() == 0
    assert decontaminate.contamination(odd_docs, items.filter("false")).filter("contaminated").count() == 0


def test_words_near_each_other(spark):
    docs = spark.createDataFrame([(1, "red x green y blue"), (2, "red " + "x " * 30 + "green blue"), (3, "green blue")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "blue green red")], "item_id long, text string")
    from codecorpus.llm.common import Staging

    found = decontaminate.PhraseIndex(docs, items, Staging(spark)).near(slop=5)
    assert [(r.doc, r.item, r.first_pos, r.last_pos) for r in found.collect()] == [(1, "1", 0, 4)]


def test_written_rules(spark):
    urls = {
        "http://a.example.com/en/1": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://WWW.Example.com/en/?q=1": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "x://b.com/fr#t": ("b.com", "/fr", "com/", "allow"), "http://b.com": ("b.com", "", None, "allow"),
        "http://u.net/es/": ("u.net", "/es/", "net/es/", "block"), "http://u.net/es": ("u.net", "/es", None, "allow"),
        "http://telecom/": ("telecom", "/", None, "allow"), "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"), None: ("", "", None, "allow"),
    }
    rows = [(i, u, i) for i, u in enumerate([*urls, *urls])]
    found = url_rules.verdicts(spark.createDataFrame(rows, "page_id long, url string, rule int")).collect()
    assert len(found) == len(rows)
    assert all((r.host, r.path, r.rule) == urls[rows[r.page_id][1]][:3] for r in found)
    # where no written rule fits, the mined ones decide; a URL without a host is allowed
    assert all(r.verdict == urls[rows[r.page_id][1]][3] for r in found if r.rule or not r.host)
    assert all((r.verdict == "block") == (r.mined_rule is not None) for r in found if not r.rule)
    assert url_rules.verdicts(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_mined_rules_equal_all_combinations(spark):
    rng = random.Random(4)
    rows = [([t for t in "abcdef" if rng.random() < 0.5] or ["a"], None) for _ in range(300)]
    rows = [(t, "a" in t and "c" in t or "e" in t and rng.random() < 0.85) for t, _ in rows]
    found = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, blocked boolean"), 0.05, 0.9, 3)
    good = {}
    for k in (1, 2, 3):
        for s in itertools.combinations("abcdef", k):
            there = [b for t, b in rows if set(s) <= set(t)]
            if sum(there) >= 0.05 * len(rows) and sum(there) / len(there) >= 0.9:
                good[s] = sum(there) / len(there)
    minimal = {s for s in good if not any(set(r) < set(s) for r in good)}
    assert {tuple(r.tokens) for r in found.collect()} == minimal and minimal
    urls = spark.createDataFrame([("u1", ["a", "c", "x"]), ("u2", ["b"]), ("u3", list("abcdef"))], "url string, tokens array<string>")
    met = {(r.url, r.rule) for r in url_rules.matching(urls, found).collect()}
    assert met == {(u, " ".join(s)) for u, t in (("u1", "acx"), ("u2", "b"), ("u3", "abcdef")) for s in minimal if set(s) <= set(t)}


def test_query_reads_all_pages(spark, sf):
    assert queries.op6_url_rules(spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()
