import itertools
import math

from pyspark.sql import functions as F

from codecorpus.operators import beam
from codecorpus.plans import catalog

MASK = "<mask>"


def plain_lists(targets, k):
    """The next-token lists of ``fit_next_tokens`` for rows that share one context line, by a plain loop."""
    import re

    tok = lambda t: re.findall(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ ]", t)
    pairs = [(p, c) for t in targets for p, c in zip(["<s>", *tok(t)], [*tok(t), beam.END], strict=True)]
    n = {}
    for p, c in pairs:
        n[p, c] = n.get((p, c), 0) + 1
    types = len({c for _, c in pairs})
    n_prev = {}
    for (p, _), v in n.items():
        n_prev[p] = n_prev.get(p, 0) + v
    pg = {(p, c): (v + 1) / (n_prev[p] + types) for (p, c), v in n.items()}
    # one line for all rows: context counts equal bigram counts
    lp = {(p, c): math.log((v + beam.CONTEXT_WEIGHT * pg[p, c]) / (n_prev[p] + beam.CONTEXT_WEIGHT)) for (p, c), v in n.items()}
    lists = {}
    for (p, c), v in sorted(lp.items(), key=lambda x: (x[0][0], -x[1], x[0][1])):
        lists.setdefault(p, [])
        if len(lists[p]) < k:
            lists[p].append((c, v))
    return lists


def plain_beam(lists, k, max_tokens):
    """Beam search as a loop: the k best by log-probability over tokens, finished hypotheses kept."""
    frontier = [((), 0.0, False)]
    score = lambda h: h[1] / max(1, len(h[0])) ** beam.LENGTH_PENALTY
    for _ in range(max_tokens):
        pool = [h for h in frontier if h[2]]
        for tokens, logp, done in frontier:
            if not done:
                for c, v in lists.get(tokens[-1] if tokens else "<s>", []):
                    pool.append(((*tokens, c), logp + v, c == beam.END or len(tokens) + 1 >= max_tokens))
        frontier = sorted(pool, key=lambda h: (-round(score(h), 12), " ".join(h[0])))[:k]
        if all(h[2] for h in frontier):
            break
    return [(list(h[0]), round(score(h), 9)) for h in frontier]


def every_sequence(lists, max_tokens):
    """All finished or cut hypotheses over the lists, by exhaustive search."""
    out = []

    def walk(tokens, logp):
        if tokens and (tokens[-1] == beam.END or len(tokens) >= max_tokens):
            out.append((tokens, logp))
            return
        for c, v in lists.get(tokens[-1] if tokens else "<s>", []):
            walk([*tokens, c], logp + v)

    walk([], 0.0)
    return out


def rows_for(spark, targets, tests):
    train = spark.createDataFrame([(i, f"def f():\n    x = 1\n    {MASK}", t) for i, t in enumerate(targets)], "o_orderkey long, input_text string, target_text string")
    test = spark.createDataFrame([(100 + i, f"def g():\n    x = 1\n    {MASK}", t) for i, t in enumerate(tests)], "o_orderkey long, input_text string, target_text string")
    return train, test


def test_beam_equals_exhaustive_search_where_the_beam_holds_everything(spark):
    targets = ["a", "a b", "b", "b a", "a a", "b"]
    train, test = rows_for(spark, targets, ["a"])
    lists = beam.fit_next_tokens(train, k=3)
    found = beam.beam_search(lists, test, "o_orderkey", k=64, max_tokens=4).collect()
    every = every_sequence(plain_lists(targets, 3), 4)
    want = sorted(((t, round(v / len(t), 12)) for t, v in every), key=lambda x: (-x[1], " ".join(x[0])))
    want = [(t, round(v, 9)) for t, v in want]
    got = [(r.tokens, round(r.score, 9)) for r in sorted(found, key=lambda r: r.rank)]
    assert got == want[: len(got)] and len(got) == min(64, len(want))


def test_beam_equals_plain_loop(spark):
    targets = ["if x > 0 :", "if x > 1 :", "if y :", "if x :", "return x", "if x > 0 and y :", "if not x :"] * 3 + ["if z"]
    train, test = rows_for(spark, targets, ["if x :", "return x"])
    for k in (1, 3, 10):
        found = beam.beam_search(beam.fit_next_tokens(train, k=k), test, "o_orderkey", k=k, max_tokens=8)
        want = plain_beam(plain_lists(targets, k), k, 8)
        for key in (100, 101):
            rows = sorted(found.filter(F.col("o_orderkey") == key).collect(), key=lambda r: r.rank)
            assert [(r.tokens, round(r.score, 9)) for r in rows] == want


def test_odd_rows(spark):
    train, test = rows_for(spark, ["a b", None, ""], ["x"])
    test = test.unionByName(test).unionByName(spark.createDataFrame([(None, None, None)], test.schema))
    found = beam.beam_search(beam.fit_next_tokens(train, k=2), test, "o_orderkey", k=2, max_tokens=5).collect()
    assert len(found) == 2 * 3 and {r.rank for r in found} == {1, 2}
    empty = beam.beam_search(beam.fit_next_tokens(train.filter("false"), k=2), test, "o_orderkey", k=2, max_tokens=5)
    assert empty.count() == 0


def test_query(spark, sf):
    rows = catalog.q_beam_search(spark, sf)
    found = rows.collect()
    assert found and max(r.rank for r in found) <= 10
    acc = catalog.q_beam_accuracy(spark, sf).first()
    assert acc.rows > 0 and 0 <= acc.beam_accuracy <= 1


def test_each_distinct_line_is_decoded_once(spark, monkeypatch):
    """The frontier holds hypotheses of lines, not of rows; every row still gets its line's hypotheses."""
    train, _ = rows_for(spark, ["if x > 0 :", "if y :", "if x :"], ["x"])
    texts = ["def g():\n    x = 1\n    " + MASK, "def g():\n    z = 2\n    " + MASK, None]
    test = spark.createDataFrame([(i % 7 or None, texts[i % 3]) for i in range(60)], "o_orderkey long, input_text string")
    sizes, put = [], beam.Staging.put

    def counted(self, df, name):
        out = put(self, df, name)
        if name.startswith("beam") and name[4:].isdigit():
            sizes.append(out.count())
        return out

    monkeypatch.setattr(beam.Staging, "put", counted)
    for rows in (beam.BROADCAST_ROWS, 0):  # lists broadcast, or asked for step by step
        monkeypatch.setattr(beam, "BROADCAST_ROWS", rows)
        found = beam.beam_search(beam.fit_next_tokens(train, k=3), test, "o_orderkey", k=3, max_tokens=6).collect()
        assert max(sizes) <= 3 * len(texts)
        assert len(found) == 3 * 60 and sorted(r.rank for r in found) == sorted([1, 2, 3] * 60)
