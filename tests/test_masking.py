import pytest
from pyspark.sql import functions as F

from codecorpus.operators import masking, splits, validate
from codecorpus.plans import datasets
from tests.conftest import values

CODE = "def f(x):\n    if x > 1: # if x > 1: no\n        y = 2\n    if y == 1:\n\tif (y):\n        return 1\n"
CASES = [
    (0, CODE), (1, "x = 1"), (2, None), (3, ""), (4, "if a:\r\n  pass\r\n"), (5, "if a:"), (6, "a\n\n  if b[1:2]:\n\n"),
    (7, "a if b:\n\x0cif c:\n"),
]


def masked(spark, on_missing, rows=CASES, n=3, seed=42):
    df = spark.createDataFrame(rows, "k int, original_code string").repartition(n)
    return masking.mask_statement(df, "k", seed=seed, on_missing=on_missing)


def test_drop_and_keep(spark):
    kept = {r.k: r for r in masked(spark, "keep").collect()}
    dropped = {r.k: r for r in masked(spark, "drop").collect()}
    assert set(kept) == set(range(8)) and set(dropped) == {0, 4, 5, 6, 7}
    for k, r in dropped.items():
        assert kept[k] == r and r.has_if
        # The hidden text put back gives the input, its line breaks unified.
        assert r.input_text.replace("<if_mask>", r.target_text, 1) == "\n".join(CASES[k][1].splitlines())
    for k in (1, 2, 3):
        assert (kept[k].input_text, kept[k].target_text, kept[k].has_if) == (CASES[k][1], None, False)
    assert dropped[6].target_text == "if b[1:"
    with pytest.raises(ValueError):
        masked(spark, "other")


def test_every_statement_is_drawn_by_some_key(spark):
    rows = [(i, CODE) for i in range(60)]
    got = {r.target_text for r in masked(spark, "drop", rows).collect()}
    assert got == {"if x > 1:", "if y == 1:", "if (y):"}


def test_same_rows_for_any_partitioning(spark):
    rows = [(i, CODE) for i in range(40)]
    want = values(masked(spark, "drop", rows, 1), "k", "input_text")
    for n in (4, 16):
        assert values(masked(spark, "drop", rows, n), "k", "input_text") == want


def test_counts(spark):
    df = spark.createDataFrame(CASES, "k int, original_code string")
    assert tuple(masking.skipped_no_match(df).first()) == (5, 2, 1)
    assert masking.statement_table(df).count() == 3 + 4


def test_mask_tokens_shares_and_invariants(spark):
    ids = F.transform(F.sequence(F.lit(0), F.lit(499)), lambda i: F.pmod(i * 7, F.lit(1000)).cast("int"))
    df = spark.range(40).select("id", ids.alias("input_ids")).withColumn("was", F.col("input_ids"))
    chosen = kinds = 0
    masks = same = 0
    for r in masking.mask_tokens(df, "id", vocab_size=1000).collect():
        for was, now, label in zip(r.was, r.input_ids, r.labels):
            kinds += 1
            if label == masking.UNSCORED:
                assert now == was
                continue
            assert label == was and was > 4
            chosen += 1
            masks += now == 4
            same += now == was
    assert abs(chosen / kinds - 0.15) < 0.01
    assert abs(masks / chosen - 0.8) < 0.03 and abs(same / chosen - 0.1) < 0.03
    padding = spark.createDataFrame([(1, [1] * 9)], "id int, input_ids array<int>")
    r = masking.mask_tokens(padding, "id", probability=1.0).first()
    assert r.input_ids == [1] * 9 and r.labels == [-100] * 9


def test_validation_kinds(spark):
    good = "[" + ", ".join(["1"] * 8) + "]"
    none = "[" + ", ".join(["-100"] * 8) + "]"
    rows = [(0, good, good), (1, "[1, 2", good), (2, "x", good), (3, None, good), (4, "[1]", good), (5, good, none), (6, "[1]", none)]
    df = spark.createDataFrame(rows, "k int, input_ids string, labels string").withColumn("original_code_snippet", F.lit("c"))
    checked = validate.check_pretrain(df, 8)
    got = {r.k: r.errors for r in checked.collect()}
    assert got == {
        0: [], 1: ["list_text"], 2: ["list_text"], 3: ["list_text"], 4: ["length"], 5: ["nothing_masked"],
        6: ["length", "nothing_masked"],
    }
    assert validate.validate_pretrain(df, 8).first().asDict() == {
        "rows": 7, "bad_rows": 6, "list_text": 3, "length": 2, "nothing_masked": 2, "passed": False,
    }
    assert values(validate.error_examples(checked, "k", 2), "row_number", "k") == [(2, 1), (3, 2)]
    with pytest.raises(ValueError):
        validate.check_pretrain(df.drop("labels"))


def test_finetune_table(spark):
    df = spark.createDataFrame([(i, CODE if i % 2 else "x = 1") for i in range(60)], "k int, original_code string")
    table = datasets.finetune_table(df, "k", n=20)
    assert sorted(r.k for r in table.select("k").collect()) == list(range(1, 41, 2))
    sizes = {r.split: r.rows for r in splits.split_sizes(table).collect()}
    assert sizes == {"train": 16, "val": 2, "test": 2}


def test_pads_are_put_behind_the_masked_ids(spark, monkeypatch):
    """Masking sees the ids of the text, not 512 places; the rows are those of masking padded ids."""
    from codecorpus.operators import bpe, masking
    from codecorpus.plans import datasets

    rows = spark.createDataFrame([(1, "if a: b"), (2, ""), (3, "c " * 30)], "k long, original_code string")
    vocab = bpe.learn_merges(rows, "original_code", vocab_size=12)
    padded = masking.mask_tokens(bpe.encode(rows, vocab, "original_code", "input_ids", 16), "k", vocab_size=len(vocab.tokens), mask_id=bpe.MASK_ID)
    want = {r.k: (r.input_ids, r.labels) for r in padded.collect()}
    sizes, mask = [], masking.mask_tokens

    def seen(df, *args, **kwargs):
        sizes.extend(len(r.input_ids) for r in df.collect())
        return mask(df, *args, **kwargs)

    monkeypatch.setattr(masking, "mask_tokens", seen)
    got = {r.k: (r.input_ids, r.labels) for r in datasets.pretrain_table(rows, vocab, "k", seq_len=16).collect()}
    assert got == want and sorted(sizes)[:2] == [0, 7]
