"""The user-function surface: batches of rows and single values."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema, batch_size: int | None = None) -> DataFrame:
    """Apply ``fn`` to batches of rows; its columns replace the input's.

    Without a batch size ``fn`` gets the Arrow batches as they come; with one,
    no batch is larger.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            step = batch_size or max(len(frame), 1)
            for start in range(0, len(frame), step):
                yield fn(frame.iloc[start : start + step].reset_index(drop=True))

    return df.mapInPandas(run, schema)


def map_values(col: Column, fn: Callable, return_type: str) -> Column:
    """Apply a Python function to each value; nulls stay null.

    Prefer a native expression where one exists.
    """

    @F.pandas_udf(return_type)
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else fn(v) for v in values], index=values.index, dtype=object)

    return run(col)
