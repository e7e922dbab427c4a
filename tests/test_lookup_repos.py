import random

from pyspark.sql import functions as F

from codecorpus.operators import lookup, repos
from codecorpus.sources import readers
from tests.conftest import values


def both_plans(df, table, on, how):
    near = lookup.lookup_join(df, table, on, how)
    far = lookup.lookup_join(df, table, on, how, broadcast_rows=2)
    return near, far


def test_shuffled_lookup_equals_broadcast(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string"))
    df = spark.range(2000).select("id", key.alias("k"), (F.col("id") % 2).alias("g")).repartition(5)
    rows = [("hot", g, g + 10, None) for g in (0, 1)] + [(str(i), i % 2, i, "v") for i in range(0, 2000, 4)]
    table = spark.createDataFrame(rows, "k string, g bigint, n int, v string")
    for how in ("left", "inner"):
        near, far = both_plans(df, table, ["k", "g"], how)
        columns = ["id", "g", F.coalesce("k", F.lit("-")), F.coalesce("n", F.lit(-1)), F.coalesce("v", F.lit("-"))]
        assert values(near, *columns) == values(far, *columns)
        assert far.columns == ["id", "k", "g", "n", "v"]


def test_hot_keys_are_found_and_few(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")).repartition(4)
    hot = lookup.hot_keys(df, ["k"])
    assert (-1,) in values(hot, "k") and hot.count() < 500


def test_hot_key_without_table_row(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise("cold").alias("k"))
    table = spark.createDataFrame([("cold", 1), ("a", 2), ("b", 3), ("c", 4)], "k string, n int")
    far = lookup.lookup_join(df, table, ["k"], broadcast_rows=1)
    assert far.count() == 900 and far.filter("n IS NULL").count() == 450


def test_first_line_containing_matches_a_scan(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choice("ab/.-") for _ in range(rng.randrange(12))) for _ in range(60)] + ["", "# aab note", "  ba  "]
    names = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(25)} | {"zz", "aab"})
    line_df = spark.createDataFrame(list(enumerate(lines)), "line_no bigint, line string")
    files = spark.createDataFrame([(n,) for n in names] + [(None,)], "repo_name string")
    got = {r.repo_name: r.repo_url for r in repos.attach_repo_url(files, line_df).collect()}
    for name in names:
        want = next((x.strip() for x in lines if name in x), repos.UNKNOWN_URL)
        assert got[name] == want
    assert got[None] == repos.UNKNOWN_URL


def test_buckets_of_names_equal_one_automaton(spark):
    rng = random.Random(8)
    lines = ["".join(rng.choice("abc/.é") for _ in range(rng.randrange(15))) for _ in range(200)] + [None, ""]
    names = sorted({"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 5))) for _ in range(80)} | {""})
    line_df = spark.createDataFrame(list(enumerate(lines)), "line_no bigint, line string")
    files = spark.createDataFrame([(n,) for n in names], "repo_name string")
    one = dict(values(repos.first_line_containing(files, line_df), "repo_name", "url"))
    many = dict(values(repos.first_line_containing(files, line_df, most_bytes=500), "repo_name", "url"))
    want = {n: next(x.strip() for x in lines if x is not None and n in x) for n in names if any(x is not None and n in x for x in lines)}
    assert one == many == want


def test_exact_lookup_and_first_owner(spark):
    lines = spark.createDataFrame(
        [(0, "# https://h/x/foo"), (1, " https://h/a/foobar "), (2, "https://h/b/foo.git"), (3, "https://h/c/foo")],
        "line_no bigint, line string",
    )
    files = spark.createDataFrame([("foo",), ("foobar",), ("nope",)], "repo_name string")
    exact = repos.attach_repo_url(files, lines, exact=True)
    assert values(exact, "repo_name", "repo_url") == [
        ("foo", "https://h/b/foo.git"), ("foobar", "https://h/a/foobar"), ("nope", repos.UNKNOWN_URL)
    ]
    loose = repos.attach_repo_url(files, lines)
    assert dict(values(loose, "repo_name", "repo_url"))["foo"] == "# https://h/x/foo"


def test_lookup_has_no_nested_loop(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select(F.col("page_id").alias("line_no"), F.col("url").alias("line"))
    names = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("source").alias("repo_name"))
    plan = repos.first_line_containing(names, pages)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_repo_urls_and_names(spark):
    df = spark.createDataFrame([("acme/tool",), ("acme/tool",), ("zed/lib",)], "name string")
    assert values(repos.repo_urls(df), "url") == [("https://github.com/acme/tool",), ("https://github.com/zed/lib",)]


def test_url_list_order_over_many_splits(spark, tmp_path):
    path = tmp_path / "urls.txt"
    path.write_text("".join(f"https://h/o/r{i}\n" if i % 5 else ("# note\n" if i % 2 else "  \n") for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        urls = readers.read_url_list(spark, str(path))
        rows = urls.collect()
        assert urls.rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.url for r in sorted(rows)] == [f"https://h/o/r{i}" for i in range(3000) if i % 5]


def test_columns_do_not_depend_on_the_size(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    table = spark.createDataFrame([("a", 10)], "k string, v int")
    near, far = (lookup.lookup_join(df, table, ["k"], broadcast_rows=n) for n in (100, 0))
    assert near.columns == far.columns == ["id", "k", "v"]
    assert values(near, "id", F.coalesce("v", F.lit(-1))) == values(far, "id", F.coalesce("v", F.lit(-1)))


def test_lines_of_a_folder_are_in_name_order(spark, tmp_path):
    (tmp_path / "list").mkdir()
    (tmp_path / "list" / "a.txt").write_text("first\n")
    (tmp_path / "list" / "b.txt").write_text("".join(f"b{i}\n" for i in range(50)))
    lines = readers.read_raw_lines(spark, str(tmp_path / "list")).orderBy("line_no").collect()
    assert [r.line for r in lines] == ["first", *(f"b{i}" for i in range(50))]
