import random

import pytest
from pyspark.sql import functions as F

from codecorpus.operators import caps, splits
from tests.conftest import values


@pytest.mark.parametrize("n", [1, 7, 250, 499, 500, 501])
def test_nth_key_by_selection(spark, n):
    rng = random.Random(n)
    keys = [(f"p{rng.randrange(4)}", i) for i in range(500)]
    rng.shuffle(keys)
    df = spark.createDataFrame(keys, "path string, seq int").repartition(4).cache()
    got = caps.nth_key(df, ["path", "seq"], n, small=20, sample=60)
    assert got == (sorted(keys)[n - 1] if n <= 500 else None)


def test_nth_key_with_tiny_samples(spark):
    df = spark.range(300).cache()
    assert caps.nth_key(df, ["id"], 123, small=5, sample=4) == (122,)


def test_head_is_a_filter_that_reaches_the_scan(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    keys = sorted(r.o_orderkey for r in df.select("o_orderkey").collect())
    top = caps.head(df, 100, ["o_orderkey"], small=50)
    assert values(top, "o_orderkey") == [(k,) for k in keys[:100]]
    plan = top._jdf.queryExecution().toString()
    assert "LessThanOrEqual(o_orderkey" in plan and "Exchange" not in plan
    assert caps.head(df, 0, ["o_orderkey"]).count() == 0
    assert caps.head(df, 10**9, ["o_orderkey"]).count() == len(keys)


@pytest.mark.parametrize("n,size", [(3, 3), (20, 20), (33, 33), (40, 34)])
def test_first_matching_grows_its_prefix(spark, n, size):
    df = spark.range(100).repartition(3).cache()
    got = caps.first_matching(df, (F.col("id") > 30) & (F.col("id") % 2 == 0), n, ["id"], small=10)
    assert values(got, "id") == [(i,) for i in range(32, 100, 2)][:size]


def test_first_matching_counts_matches_only(spark):
    df = spark.range(100)
    got = caps.first_matching(df, F.col("id") % 3 == 0, 5, ["id"])
    assert values(got, "id") == [(0,), (3,), (6,), (9,), (12,)]


@pytest.mark.parametrize("n", [0, 1, 5, 9, 10, 101])
def test_split_sizes(spark, n):
    df = splits.split_dataset(spark.range(n), "id", small=20)
    sizes = {r.split: r.rows for r in splits.split_sizes(df).collect()}
    assert tuple(sizes.get(s, 0) for s in ("train", "val", "test")) == splits.part_sizes(n)
    assert df.count() == n


def test_part_sizes():
    assert splits.part_sizes(50_000) == (40_000, 5_000, 5_000)
    assert splits.part_sizes(1) == (0, 0, 1)


def test_split_does_not_depend_on_partitions_or_method(spark):
    base = spark.range(400)
    want = values(splits.split_dataset(base.coalesce(1), "id"), "id", "split")
    for n in (4, 16):
        assert values(splits.split_dataset(base.repartition(n), "id", small=30), "id", "split") == want


def test_exact_split_moves_no_rows(spark, sf):
    df = splits.split_dataset(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderkey")
    assert "Exchange" not in df._jdf.queryExecution().toString()


def test_null_and_repeated_keys_are_errors(spark):
    nulls = spark.createDataFrame([(None,), (1,), (2,), (3,)], "k int")
    with pytest.raises(ValueError, match="no key"):
        caps.head(nulls, 4, ["k"])
    with pytest.raises(ValueError, match="no key"):
        splits.split_dataset(nulls, "k")
    same = spark.createDataFrame([(7,)] * 100, "k int").repartition(4).cache()
    with pytest.raises(ValueError, match="repeat"):
        caps.nth_key(same, ["k"], 50, small=10, sample=10)
    with pytest.raises(ValueError, match="repeat"):
        caps.head(spark.createDataFrame([(1,), (2,), (2,)], "k int"), 2, ["k"])


def test_written_splits_search_statements_once(spark, sf, monkeypatch):
    from codecorpus.plans import catalog
    from codecorpus.session import Staging

    staged, put = [], Staging.put
    monkeypatch.setattr(Staging, "put", lambda self, df, name: staged.append(name) or put(self, df, name))
    split = catalog.splits.split_dataset

    def no_search(df, *args, **kwargs):
        assert "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()
        return split(df, *args, **kwargs)

    monkeypatch.setattr(catalog.splits, "split_dataset", no_search)
    assert catalog.q_splits_written(spark, sf).count() > 0 and staged == ["pairs"]
