from pyspark.sql import functions as F

from codecorpus.operators import clean
from codecorpus.plans import collect
from tests.conftest import plan_of, values

SCHEMA = "path string, seq int, original_code string, start_line int, end_line int"


def code(n, tag="x"):
    return "\n\n".join(f"{tag}{i}" for i in range(n))


def table(spark):
    rows = [
        ("a", 0, code(2), 1, 2),
        ("a", 1, code(3), 1, 3),
        ("a", 2, code(100), 1, 100),
        ("a", 3, code(101), 1, 101),
        ("b", 0, code(3), 9, 1),
        ("b", 1, code(3), None, 1),
        ("b", 2, "", 1, 1),
        ("b", 3, code(3), 1, 3),
        ("b", 4, code(3), 1, 3),
        ("c", 0, code(3, "y"), 5, 5),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_reject_reasons(spark):
    got = {(r.path, r.seq): r.reject_reason for r in clean.with_reject_reason(table(spark)).collect()}
    assert got == {
        ("a", 0): "short", ("a", 1): None, ("a", 2): None, ("a", 3): "long", ("b", 0): "invalid", ("b", 1): "invalid",
        ("b", 2): "short", ("b", 3): None, ("b", 4): None, ("c", 0): None,
    }


def test_dedup_keeps_the_first_and_limits_before_the_shuffle(spark):
    df = clean.dedup_exact(clean.clean_functions(table(spark)))
    assert values(df, "path", "seq") == [("a", 1), ("a", 2), ("c", 0)]
    plan = plan_of(df)
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_append_new_is_idempotent(spark):
    first = clean.dedup_exact(table(spark))
    assert clean.append_new(first, table(spark)).count() == 0
    fresh = clean.append_new(table(spark).filter("path = 'a'"), table(spark))
    assert values(fresh, "path", "seq") == [("b", 2), ("c", 0)]
    assert clean.append_rows(first, fresh).count() == first.count() + 2


def counters(spark, n):
    funcs = clean.cap_after_clean(table(spark), n)
    return collect.function_counters(funcs).withColumn("duplicates", collect.duplicate_count()).first().asDict()


def test_cap_counts_only_the_prefix(spark):
    whole = counters(spark, 99)
    assert whole == {
        "functions_raw": 10, "short_functions": 2, "long_functions": 1, "empty_functions": 0, "invalid_lines": 2,
        "functions_written": 3, "duplicates": 2,
    }
    assert counters(spark, 3) == whole
    capped = counters(spark, 2)
    assert capped["functions_raw"] == 3 and capped["functions_written"] == 2 and capped["long_functions"] == 0


def test_hot_text_counts(spark):
    rows = spark.range(5000).select(
        F.lit("p").alias("path"), F.col("id").cast("int").alias("seq"),
        F.when(F.col("id") % 3 == 0, "a\nb\nc").otherwise(F.concat_ws("\n", "id", "id", "id")).alias("original_code"),
        F.lit(1).alias("start_line"), F.lit(3).alias("end_line"),
    )
    assert clean.dedup_exact(rows).count() == 5000 - 1667 + 1
