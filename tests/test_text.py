import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from codecorpus.functions import text
from codecorpus.operators import masking

BREAKS = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", chr(0x2028), chr(0x2029)]
BLANKS = [" ", "\t", "\xa0", chr(0x3000), "\x1f", chr(0x200B), chr(0x2003)]
PIECES = BREAKS + BLANKS + ["a", "if", "x:", "if x:", "iffy: int", "elif a:", "é", "😀", "(", "{2: 3}", "if x[1:2]: pass"]
PATTERN = re.compile(r"^\s*(if\s*\(?.*?\)?\s*:)")


def evaluate(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    return [r.v for r in df.select("id", column(F.col("t")).alias("v")).orderBy("id").collect()]


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=9).map("".join), min_size=150, max_size=300))
def test_text_rules_follow_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    t = F.col("t")
    rows = df.select(
        "t",
        text.split_lines(t).alias("lines"),
        text.unify_breaks(t).alias("unified"),
        text.nonblank_lines(t).alias("nonblank"),
        text.strip(t).alias("stripped"),
        text.code_tokens(t).alias("tokens"),
        masking.find_statements(t).alias("found"),
        masking.has_statement(t).alias("has"),
    ).collect()
    assert len(rows) == len(texts)
    for r in rows:
        lines = r.t.splitlines()
        assert r.lines == lines, repr(r.t)
        assert r.unified == "\n".join(lines), repr(r.t)
        assert r.nonblank == sum(1 for x in lines if x.strip()), repr(r.t)
        assert r.stripped == r.t.strip(), repr(r.t)
        assert r.tokens == " ".join(r.t.split()), repr(r.t)
        want = [(m.group(1), i) for i, m in ((i, PATTERN.match(x)) for i, x in enumerate(lines)) if m]
        assert [(h.text, h.line) for h in r.found] == want, repr(r.t)
        assert r.has == bool(want), repr(r.t)


def test_statement_pattern_cases(spark):
    cases = {
        "if x[1:2]: pass": "if x[1:",
        "iffy: int = 3": "iffy:",
        "elif a: b": None,
        "if (a and": None,
        "x = 1 if y else {2: 3}": None,
        "if 'if q:' : ...": "if 'if q:",
        "\xa0if a : b": "if a :",
    }
    found = evaluate(spark, list(cases), lambda c: masking.find_statements(c))
    assert [f[0].text if f else None for f in found] == list(cases.values())


def test_names_paths_signatures(spark):
    urls = ["https://h/o/tool.git", "https://h/o/my.github.io", "plain", "https://h/o/"]
    assert evaluate(spark, urls, text.local_repo_name) == [u.split("/")[-1].replace(".git", "") for u in urls]
    paths = ["repo/a/b.py", "repo/x.py", "alone.py"]
    assert evaluate(spark, paths, text.repo_from_path) == ["repo", "repo", "alone.py"]
    assert evaluate(spark, paths, text.relative_path) == ["a/b.py", "x.py", ""]
    assert evaluate(spark, ["f"], lambda c: text.signature(c, F.lit(True))) == ["async def f(...)"]
    assert evaluate(spark, ["f"], lambda c: text.signature(c, F.lit(False))) == ["def f(...)"]
    ends = evaluate(spark, ["a\nb\nc"], lambda c: text.default_end_line(F.lit(4), F.lit(None).cast("int"), c))
    assert ends == [6]
    assert evaluate(spark, ["a"], text.append_mask) == ["a <mask>"]


def test_numbers(spark):
    got = evaluate(spark, ["1.5", "x", None, "nan", "-2"], text.to_numeric)
    assert got == [1.5, 0.0, 0.0, 0.0, -2.0]
    assert abs(evaluate(spark, ["0"], lambda c: text.confidence(c.cast("double")))[0] - 100 / (1 + 1e-8)) < 1e-9


def test_same_stripped(spark):
    df = spark.createDataFrame([(" a\n", "a"), ("a", "b"), (None, "a"), (None, None)], "l string, r string")
    got = [r.v for r in df.coalesce(1).select(text.same_stripped(F.col("l"), F.col("r")).alias("v")).collect()]
    assert got == [True, False, False, False]
