"""Chunkers, stitching and consecutive-run grouping."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisieve.functions.similarity import coverage
from trisieve.functions.text import strip, suffix_prefix_overlap, word_set
from trisieve.operators.select import row_index
from trisieve.runtime import bounded_join, materialize


def fixed_windows(c: Column, size: int = 384, overlap: int = 48) -> Column:
    """All windows at multiples of size - overlap; a tail inside the last window is a chunk of its own."""
    starts = F.sequence(F.lit(0), F.length(c) - 1, F.lit(size - overlap))
    return F.when(F.length(c) > 0, F.transform(starts, lambda s: F.substring(c, s + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def stride_windows(c: Column, size: int = 1200, overlap: int = 150) -> Column:
    """array<struct<start,text>> of stripped windows; the last one reaches the end of the text."""
    body = strip(c)
    last = F.greatest(F.length(body) - overlap - 1, F.lit(0))
    spans = F.transform(F.sequence(F.lit(0), last, F.lit(size - overlap)), lambda s: F.struct(s.cast("int").alias("start"), strip(F.substring(body, s + 1, F.lit(size))).alias("text")))
    return F.when(F.length(body) > 0, F.filter(spans, lambda x: x["text"] != "")).otherwise(F.array().cast("array<struct<start:int,text:string>>"))


def answer_windows(context: Column, starts: Column, answers: Column, size: int = 1200, before: int = 150) -> Column:
    """Distinct array<struct<start,text>> of windows around each answer, in order of first appearance.

    Raises on an answer longer than a window.
    """
    room = F.greatest(F.length(context) - size, F.lit(0))
    spans = F.transform(F.arrays_zip(starts.alias("at"), answers.alias("answer")), lambda x: F.least(F.greatest(x["at"] - before, F.lit(0)), room))
    windows = F.transform(F.array_distinct(spans), lambda s: F.struct(s.cast("int").alias("start"), F.substring(context, s + 1, F.lit(size)).alias("text")))
    return F.when(F.exists(answers, lambda a: F.length(a) > size), F.raise_error(F.lit(f"an answer is longer than {size}"))).otherwise(windows)


CHUNKS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("text", T.StringType())]))


def boundary_chunks(size: int = 384, least: int = 192, overlap: int = 48):
    """A UDF: windows cut after the last line break, '. ' or '; ' beyond `least`, with overlap."""

    def cut(text: str) -> list[dict]:
        text, out, at = text.strip(), [], 0
        while at < len(text):
            end = at + size
            if end >= len(text):
                end = len(text)
            else:
                best = max(text.rfind(mark, at, end) for mark in ("\n", ". ", "; ")) - at
                end = at + best + 1 if best >= least else end
            piece = text[at:end].strip()
            if piece:
                out.append({"start": at, "text": piece})
            if end == len(text):
                break
            at = max(end - overlap, at + 1)
        return out

    @F.pandas_udf(CHUNKS)
    def run(column: pd.Series) -> pd.Series:
        return column.map(cut, na_action="ignore")

    return run


def word_chunks(size: int = 384, overlap: int = 48, least: int = 80):
    """A UDF: whole words up to `size` characters, whole words up to `overlap` repeated; ends at the first
    chunk shorter than `least`. One word above the size is a chunk of its own."""

    def cut(text: str) -> list[str]:
        words = text.split()
        ends, total = [], -1
        for w in words:
            total += len(w) + 1
            ends.append(total)  # length of the words up to here, joined by blanks
        span = lambda i, j: ends[j - 1] - (ends[i - 1] + 1 if i else 0)
        out, i = [], 0
        while i < len(words):
            j = i + 1
            while j < len(words) and span(i, j + 1) <= size:
                j += 1
            if span(i, j) < least:
                break
            out.append(" ".join(words[i:j]))
            if j == len(words):
                break
            k = j
            while k > i and span(k - 1, j) <= overlap:
                k -= 1
            i = max(i + 1, k)
        return out

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(column: pd.Series) -> pd.Series:
        return column.map(cut, na_action="ignore")

    return run


def lossless_pieces(size: int = 4300):
    """A UDF: pieces up to `size` characters, cut before the last blank of their second half; they join to the text."""
    piece = re.compile(rf"(?s)[\s\S]{{{size // 2},{size}}}(?= )|[\s\S]{{{size}}}")

    def cut(text: str) -> list[str]:
        out, at = [], 0
        while len(text) - at > size:
            found = piece.match(text, at)
            out.append(found[0])
            at = found.end()
        return [*out, text[at:]]

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(column: pd.Series) -> pd.Series:
        return column.map(cut, na_action="ignore")

    return run


def best_chunks(df: DataFrame, id_col: str, chunks: Column, wanted: Column, title: Column) -> DataFrame:
    """(id, start, text): of each row's chunks (array of struct start, text) the one whose words, with the
    title's, cover most of the wanted words. Ties go to more shared words, then to the earlier chunk; rows
    without chunks give none. The id must be unique."""
    rows = df.select(id_col, wanted.alias("_wanted"), title.alias("_title"), F.explode(chunks).alias("_c"))
    words = rows.withColumn("_words", word_set(F.concat_ws(" ", "_title", "_c.text")))
    score = F.struct(coverage(F.col("_wanted"), F.col("_words")).alias("coverage"), F.size(F.array_intersect("_wanted", "_words")).alias("shared"), (-F.col("_c.start")).alias("early"), F.col("_c.text").alias("text"))
    best = words.groupBy(id_col).agg(F.max(score).alias("_best"))
    return best.select(id_col, (-F.col("_best.early")).alias("start"), "_best.text")


#: Rows whose running start is found in one task.
RUN = 100_000


def islands(df: DataFrame, keys: list[str], order_by: list[str], partition_by: list[str], blank_key: str | None = None, fallback: str = "data_id") -> DataFrame:
    """Adds `island`: the position of the first row of the run of equal keys that a row belongs to.

    Rows are ordered by `partition_by` and `order_by` together; a run never crosses a partition. A row
    whose `blank_key` is blank is a run of its own (its key is `fallback`). Neighbours meet by a join on
    the position and starts are carried over blocks of RUN rows, so that no partition is one task.
    """
    rows = row_index(df, [*partition_by, *order_by], "_row")
    own = [F.when(F.trim(F.col(k)) != "", F.col(k)).otherwise(F.concat(F.lit("\x00"), F.col(fallback))) if k == blank_key else F.col(k) for k in keys]
    key = F.to_json(F.array(*[F.coalesce(k.cast("string"), F.lit("\x01")) for k in [*own, *[F.col(c) for c in partition_by]]]))
    keyed = materialize(rows.withColumn("_key", key), "islands")
    before = keyed.select((F.col("_row") + 1).alias("_row"), F.col("_key").alias("_before"))
    start = F.when(~F.col("_key").eqNullSafe(F.col("_before")), F.col("_row"))
    starts = keyed.join(before, "_row", "left").withColumn("_start", start).withColumn("_block", F.floor(F.col("_row") / RUN))
    running = F.max("_start").over(Window.partitionBy("_block").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0))
    carried = F.max("_last").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))  # one row a block
    blocks = materialize(starts.groupBy("_block").agg(F.max("_start").alias("_last")).select("_block", carried.alias("_carried")), "blocks")
    out = bounded_join(starts.withColumn("_running", running), blocks, ["_block"], by=["_row"])
    return out.withColumn("island", F.coalesce("_running", "_carried")).select(*df.columns, "island")


#: Chunks whose new parts are joined before those of the whole document.
PART = 1000


def stitched_parts(df: DataFrame, document: list[str], order_by: list[str], text: str, overlap: int = 48, least: int = 32) -> DataFrame:
    """Adds `_row`, the place of each chunk over all documents, and `_new`, its text without the overlap.

    The overlap depends only on the end of the chunk before, which comes by a join on the place; no task
    holds the chunks of a document.
    """
    rows = materialize(row_index(df, [*document, *order_by], "_row").withColumn("_body", F.coalesce(F.col(text), F.lit(""))), "stitch")
    before = rows.select((F.col("_row") + 1).alias("_row"), *[F.col(c).alias(f"_doc{i}") for i, c in enumerate(document)], F.expr(f"right(_body, {overlap})").alias("_before"))
    parts = rows.join(before, "_row", "left")
    same = F.col("_before").isNotNull()
    for i, c in enumerate(document):
        same = same & F.col(c).eqNullSafe(F.col(f"_doc{i}"))
    parts = parts.withColumn("_cut", F.when(same, suffix_prefix_overlap(F.col("_before"), F.col("_body"), overlap, least)).otherwise(0))
    return parts.withColumn("_new", F.expr("substring(_body, 1 + _cut)")).select(*df.columns, "_row", "_new")


def stitch(df: DataFrame, document: list[str], order_by: list[str], text: str, overlap: int = 48, least: int = 32) -> DataFrame:
    """One row for each document: its chunks joined without the overlap of neighbouring raw chunks.

    Runs of PART chunks are joined first, then the runs of a document; a document that no row can hold is
    to be used by its stitched_parts.
    """
    joined = lambda at, new: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, new))), lambda x: x[new]), "")
    parts = stitched_parts(df, document, order_by, text, overlap, least).withColumn("_part", F.floor(F.col("_row") / PART))
    runs = parts.groupBy(*document, "_part").agg(joined("_row", "_new").alias("_text"), F.count(F.lit(1)).alias("_n"))
    return runs.groupBy(*document).agg(joined("_part", "_text").alias("document"), F.sum("_n").alias("chunks"))
