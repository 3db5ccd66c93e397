"""Set and vector similarities and fuzzy dimension matches."""

from __future__ import annotations

from difflib import get_close_matches

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisieve.functions.text import ascii_tokens, word_set


def shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def overlap_ratio(query: Column, passage: Column) -> Column:
    """Share of the query's ASCII words (longer than one letter) found in the passage; 0 without any."""
    q = ascii_tokens(query, longer_than=1)
    return F.when(F.size(q) > 0, shared(q, ascii_tokens(passage)) / F.size(q)).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words of two texts; 0 if both have none."""
    x, y = word_set(a), word_set(b)
    return shared(x, y) / F.greatest(F.size(F.array_union(x, y)), F.lit(1))


def ordered_union(*lists: Column) -> Column:
    """The distinct elements of all lists in order of first appearance."""
    return F.array_distinct(F.concat(*lists))


def coverage(wanted: Column, text: Column) -> Column:
    """Share of the wanted word set that a word set holds."""
    return shared(wanted, text) / F.greatest(F.size(wanted), F.lit(1))


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision, row by row; for blocks of vectors see operators.vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def canonical_name(df: DataFrame, column: str, names: list[str], as_: str, keep_unknown: bool = False) -> DataFrame:
    """The first of `names` ("name | address") that a value equals or contains, without case and final slash.

    The names are parameters, so they become one expression; unknown values are null, or kept trimmed.
    """
    value = F.regexp_replace(F.lower(F.trim(F.col(column))), "/+$", "")
    branch = None
    for name in names:
        label, _, address = name.lower().partition(" | ")
        hit = (value == name.lower().rstrip("/")) | F.contains(value, F.lit(label.rstrip("/")))
        if address:
            hit = hit | F.contains(value, F.lit(address.rstrip("/")))
        branch = F.when(hit, F.lit(name)) if branch is None else branch.when(hit, F.lit(name))
    rest = F.trim(F.col(column)) if keep_unknown else F.lit(None).cast("string")
    return df.withColumn(as_, rest if branch is None else branch.otherwise(rest))


def closest_topic(topics: list[str], cutoff: float = 0.86):
    """A UDF that gives the topic with the same words, else the closest one above the cutoff, else null."""
    known = {" ".join(t.casefold().split()): t for t in topics}

    @F.pandas_udf(T.StringType())
    def run(column: pd.Series) -> pd.Series:
        def one(x: str) -> str | None:
            key = " ".join(x.casefold().split())
            near = [key] if key in known else get_close_matches(key, known, n=1, cutoff=cutoff)
            return known[near[0]] if near else None

        return column.map(one, na_action="ignore")

    return run
