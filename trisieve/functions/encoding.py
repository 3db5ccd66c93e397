"""The interface to a sentence encoder; the model itself is brought by the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts to vectors, one row each; sent to the executors, so it must be picklable or load itself there.
Model = Callable[[Sequence[str]], object]


def encode(df: DataFrame, text_col: str, role: str, model: Model, batch: int = 256, out: str = "vec") -> DataFrame:
    """Adds the vector of each text, of length one, in its role ('query' or 'passage', put before the text).

    Null texts get null vectors, zero vectors stay zero. The model sees at most `batch` texts at once.
    """
    if role not in ("query", "passage"):
        raise ValueError(f"unknown role {role}")

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            found: list = [None] * len(column)
            at = np.flatnonzero(column.notna().to_numpy())
            for start in range(0, len(at), batch):
                part = at[start : start + batch]
                x = np.asarray(model([f"{role}: {t}" for t in column.iloc[part]]), dtype=np.float64)
                norm = np.sqrt((x * x).sum(axis=1))[:, None]
                for i, v in zip(part, x / np.where(norm > 0, norm, 1.0), strict=True):
                    found[i] = v.astype(np.float32)
            yield pd.Series(found, dtype=object)

    return df.withColumn(out, run(F.col(text_col)))
