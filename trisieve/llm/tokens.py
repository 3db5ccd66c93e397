"""Sizes of texts in tokens of a public tokenizer (byte-level BPE for many languages, 50,256 ids)."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisieve.runtime import spread

#: Folder and file of the vocabulary.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _count(folder: str, vocabulary: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoding(folder, vocabulary).encode_ordinary
        for pdf in batches:
            pdf["tokens"] = [len(encode(t)) for t in pdf.pop("text")]
            yield pdf

    return run


def token_counts(df: DataFrame, id_col: str, text_col: str, keep: list[str], folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, kept columns, tokens) of each row with a non-blank text."""
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), *keep, F.col(text_col).cast("string").alias("text")).filter(F.col("text").rlike(r"(?U)\S"))
    kept = "".join(f", `{c}` string" for c in keep)
    return spread(rows).mapInPandas(_count(folder, vocabulary), f"doc_id bigint{kept}, tokens bigint")
