"""From the function table to the training tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from codecorpus.operators import bpe, caps, masking, splits
from codecorpus.session import Staging


def pretrain_table(
    funcs: DataFrame, vocab: bpe.Vocabulary, key: str, n: int | None = None, seq_len: int = bpe.MAX_LENGTH,
    seed: int = 42, code: str = "original_code", windows: bool = False,
) -> DataFrame:
    """``input_ids, labels, original_code_snippet`` of all functions, or of the first n.

    A text longer than ``seq_len`` ids is cut there; ``cut_texts`` counts those. With ``windows`` it
    goes on in further rows instead (``window`` from 0). No row moves: encoding and masking are per row.
    """
    rows = funcs.filter(F.col(code).isNotNull()).select(key, code)
    if n is not None:
        rows = caps.head(rows, n, [key])
    if windows:
        ids = bpe.encode_windows(rows, vocab, code, "input_ids", seq_len)
        place = F.concat_ws("-", F.col(key).cast("string"), F.col("window").cast("string"))
        masked = masking.mask_tokens(ids.withColumn("_place", place), "_place", vocab_size=len(vocab.tokens), mask_id=bpe.MASK_ID, seed=seed)
        return masked.select(key, "window", "input_ids", "labels", F.col(code).alias("original_code_snippet"))
    # pads are never drawn, so they are put behind the masked ids
    ids = bpe.encode(rows, vocab, code, "input_ids", seq_len, pad=False)
    masked = masking.mask_tokens(ids, key, vocab_size=len(vocab.tokens), mask_id=bpe.MASK_ID, seed=seed)
    return masked.select(
        key, bpe.fit_length(F.col("input_ids"), seq_len, True, False).alias("input_ids"),
        bpe.fit_length(F.col("labels"), seq_len, True, False, masking.UNSCORED).alias("labels"), F.col(code).alias("original_code_snippet"),
    )


def cut_texts(funcs: DataFrame, vocab: bpe.Vocabulary, seq_len: int = bpe.MAX_LENGTH, code: str = "original_code") -> DataFrame:
    """One row: ``texts``, and ``cut``, how many of them have more than ``seq_len`` ids."""
    ids = bpe.encode_column(F.col(code), vocab)
    return funcs.filter(F.col(code).isNotNull()).select(F.size(ids).alias("n")).agg(
        F.count("*").alias("texts"), F.count_if(F.col("n") > seq_len).alias("cut"))


def finetune_table(
    funcs: DataFrame, key: str, n: int | None = None, seed: int = 42, code: str = "original_code", exact: bool = True
) -> DataFrame:
    """``key, input_text, target_text, split`` of the functions with a statement, or the first n of them."""
    condition = masking.has_statement(F.col(code))
    rows = funcs.select(key, code)
    first = rows.filter(condition) if n is None else caps.first_matching(rows, condition, n, [key])
    masked = masking.mask_statement(first, key, code, seed).select(key, "input_text", "target_text")
    staged = Staging(funcs.sparkSession).put(masked, "finetune")
    return splits.split_dataset(staged, key, seed, exact)
