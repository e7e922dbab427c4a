import json

import pytest
from pyspark.sql import functions as F

from codecorpus.sources import readers, writers
from tests.conftest import values

ODD = ["a\nb", 'say "x", y', "back\\slash", "", "NA", "null", "nan", "a\r\nb", "é, ç", None]


def function_rows(spark):
    rows = [("r", "u", f"{i:02}", "f", 1, 2, "s", t, t) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, readers.FUNCTION_SCHEMA)


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_functions_round_trip_in_two_appends(spark, tmp_path, format):
    df = function_rows(spark).repartition(2)
    path = str(tmp_path / "t")
    writers.write_functions(df.filter("file_path < '05'"), path, format)
    writers.write_functions(df.filter("file_path >= '05'"), path, format)
    back = {r.file_path: r.original_code for r in readers.read_functions(spark, path, format).collect()}
    want = [t if format == "parquet" or t is None else t.replace("\r\n", "\n") for t in ODD]
    got = [back[f"{i:02}"] if format == "parquet" or back[f"{i:02}"] is None else back[f"{i:02}"].replace("\r\n", "\n") for i in range(len(ODD))]
    assert got == want


def test_repo_table(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("id,name,stars\n1,acme/tool,5\n2,zed/lib,\n")
    assert values(readers.read_repo_table(spark, str(path)), "name") == [("acme/tool",), ("zed/lib",)]
    path.write_text("id,title\n1,x\n")
    with pytest.raises(ValueError):
        readers.read_repo_table(spark, str(path))


def test_url_list_and_writer(spark, tmp_path):
    path = tmp_path / "u.txt"
    path.write_text("https://h/a\n\n# note\n  https://h/b  \n")
    urls = readers.read_url_list(spark, str(path))
    assert [r.url for r in urls.orderBy("line_no").collect()] == ["https://h/a", "https://h/b"]
    writers.write_url_list(urls, str(tmp_path / "out"))
    assert values(spark.read.text(str(tmp_path / "out")), "value") == [("https://h/a",), ("https://h/b",)]


def test_pretrain_csv_is_quoted_and_read_as_text(spark, tmp_path):
    df = spark.createDataFrame([([1, 2], [-100, 2], 'a "q"\n\n b')], "input_ids array<int>, labels array<int>, original_code_snippet string")
    path = str(tmp_path / "p")
    writers.write_pretrain(df, path)
    writers.write_pretrain(df, path)
    raw = [r.value for r in spark.read.text(path, wholetext=True).collect() if r.value]
    # A task without rows may leave a file with the header alone.
    header = '"input_ids","labels","original_code_snippet"\n'
    assert [r for r in raw if r != header] == [header + '"[1, 2]","[-100, 2]","a ""q""\n\n b"\n']
    columns = df.columns
    text = readers.read_as_strings(spark, path, columns)
    assert set(dict(text.dtypes).values()) == {"string"}
    assert readers.parse_int_list(text, ["input_ids", "labels"]).collect() == df.collect()
    bad = spark.createDataFrame([("[1, 2",), ("x",), (None,), ("[]",)], "a string")
    got = [r.a for r in readers.parse_int_list(bad.coalesce(1), ["a"]).collect()]
    assert got == [None, None, None, []]
    with pytest.raises(ValueError):
        readers.read_as_strings(spark, path, ["nope"])


def test_corpus_splits_results(spark, tmp_path):
    df = function_rows(spark)
    writers.write_corpus(df, str(tmp_path / "c"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "c"), lineSep="\n").collect())
    assert lines == sorted(x for t in ODD if t is not None for x in t.split("\n"))
    splits = spark.range(9).select("id", F.element_at(F.array(*map(F.lit, ("train", "val", "test"))), (F.col("id") % 3 + 1).cast("int")).alias("split"))
    writers.write_splits(splits, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s/split=val")).count() == 3
    scored = spark.createDataFrame(
        [("c", "i", "t", True, "p", "12.5", 3.5), ("c", "i", None, False, "p", "x", None)], readers.SCORED_SCHEMA
    )
    for format in ("csv", "parquet"):
        writers.write_results(scored, str(tmp_path / format), format)
    assert values(readers.read_scored(spark, str(tmp_path / "csv")), "has_if", "prediction_score") == [(False, "x"), (True, "12.5")]
    assert sorted(readers.read_scored(spark, str(tmp_path / "csv")).collect(), key=repr) == sorted(scored.collect(), key=repr)


def test_loss_history(spark, tmp_path):
    log = {"best_metric": None, "log_history": [
        {"epoch": 0.5, "grad_norm": 2.0, "learning_rate": 5e-05, "loss": 7.5, "step": 500},
        {"epoch": 0.5, "eval_loss": 1.5, "step": 500},
    ]}
    path = tmp_path / "state.json"
    path.write_text(json.dumps(log, indent=2))
    rows = readers.read_loss_history(spark, str(path)).collect()
    assert [(r.step, r.loss, r.eval_loss) for r in rows] == [(500, 7.5, None), (500, None, 1.5)]


def test_loss_history_written_as_state_files_and_read_back(spark, tmp_path):
    rows = [(s, s / 100, None if s % 7 == 0 else 1.0 / (s + 1), 0.5 - s / 1000 if s % 7 == 0 else None) for s in range(1, 300)]
    log = spark.createDataFrame(rows, "step long, epoch double, loss double, eval_loss double")
    path = str(tmp_path / "state")
    writers.write_loss_history(log, path, entries_per_file=40)
    files = [p for p in (tmp_path / "state").rglob("*.json")]
    assert len(files) >= 5
    back = readers.read_loss_history(spark, path)
    assert values(back, "step", "epoch", "loss", "eval_loss") == sorted(rows)
    assert back.filter("grad_norm IS NOT NULL OR learning_rate IS NOT NULL").count() == 0
