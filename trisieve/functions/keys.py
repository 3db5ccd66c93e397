"""Reproducible identifiers and digests; they make reruns idempotent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trisieve.functions.text import folded

UNIT = "\x1f"
RECORD = "\x1e"


def digest(*parts: Column, separator: str = UNIT) -> Column:
    """SHA-256 in hex over the parts; null parts are left out."""
    return F.sha2(F.concat_ws(separator, *[p.cast("string") for p in parts]), 256)


def stable_id(prefix: str, *parts: Column, length: int = 24) -> Column:
    return F.concat(F.lit(prefix), F.substring(digest(*parts), 1, length))


def pair_hash(source: Column, anchor: Column, positive: Column) -> Column:
    return digest(source, folded(anchor), folded(positive))


def triplet_hash(anchor: Column, positive: Column, negative: Column) -> Column:
    return F.md5(F.concat_ws(RECORD, anchor, positive, negative))


def folded_digest(*parts: Column) -> Column:
    return F.sha2(folded(F.concat_ws(UNIT, *parts)), 256)


def short_sha1(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 24))


def numbered(prefix: str, number: Column, width: int) -> Column:
    """Prefix and zero-padded number; a number of more digits is not cut."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text))
