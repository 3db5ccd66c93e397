"""Problem 10: the reading level of each document, from 1 (first readers) to 4 (specialist texts).

Method: each word's acquisition grade is the level at which half of its use is reached, from its
distribution over the rated texts; a document's level is predicted from quantiles of the grades of its
known words, calibrated on the rated documents.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisieve.runtime import materialize, spread

LEVELS = 4
#: Rated documents the grades and the calibration are fitted on; beyond it those of the smallest id hash.
MAX_RATED = 50_000
#: Rated documents in which a word must occur to get a grade.
MIN_DOCS = 4
SMOOTH = 0.2
QUANTILES = (0.05, 0.10, 0.25, 0.40, 0.50, 0.60, 0.75, 0.90, 0.95)
N_FEATURES = len(QUANTILES) + 2

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return _WORD.findall(text.lower())


def _tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents with each word, by level; a document of several ratings counts in parts."""
    for pdf in batches:
        seen: dict[str, list[float]] = {}
        for text, levels in zip(pdf["text"], pdf["levels"], strict=True):
            for w in set(words(text)):
                row = seen.setdefault(w, [0.0] * LEVELS)
                for level in levels:
                    row[level - 1] += 1 / len(levels)
        yield pd.DataFrame({"word": list(seen), **{f"n{i + 1}": [v[i] for v in seen.values()] for i in range(LEVELS)}})


def acquisition_grades(counts: dict[str, list[float]], totals: np.ndarray) -> dict[str, float]:
    """Grade of each word: where the cumulated share of its rate over the levels passes one half."""
    out = {}
    for word, row in counts.items():
        rate = (np.asarray(row) + SMOOTH) / (totals + SMOOTH * LEVELS)
        share = rate / rate.sum()
        upto = np.cumsum(share)
        k = min(int(np.searchsorted(upto, 0.5)), LEVELS - 1)
        out[word] = k + 0.5 + (0.5 - (upto[k - 1] if k else 0.0)) / share[k]
    return out


def features(text: str, grades: dict[str, float]) -> list[float] | None:
    """Quantiles and mean of the known words' grades and their number; None without known words."""
    known = [g for w in words(text) if (g := grades.get(w)) is not None]
    if not known:
        return None
    a = np.sort(np.asarray(known))
    at = np.asarray(QUANTILES) * (len(a) - 1)
    low = at.astype(int)
    high = np.minimum(low + 1, len(a) - 1)
    return [*(a[low] + (at - low) * (a[high] - a[low])).tolist(), float(a.mean()), float(np.log1p(len(a)) / 5)]


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 600) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights of a softmax regression of level shares `y` on the features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros((z.shape[1], LEVELS))
    for _ in range(steps):
        p = np.exp((s := z @ w) - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w -= 0.5 * (z.T @ (p - y) / len(z) + 1e-4 * w)
    return mean, scale, w


def _describe(grades):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = grades.value
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "lang": pdf["lang"], "x": [features(t, table) for t in pdf["text"]]})

    return run


def _predict(mean: np.ndarray, scale: np.ndarray, w: np.ndarray, default: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            known = pdf["x"].notna().to_numpy()
            level = np.full(len(pdf), default, dtype=np.int32)
            if known.any():
                z = (np.stack(pdf["x"][known].to_list()) - mean) / scale
                level[known] = (np.hstack([z, np.ones((len(z), 1))]) @ w).argmax(axis=1) + 1
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "lang": pdf["lang"], "reading_level": level})

    return run


def reading_levels(df: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", max_rated: int = MAX_RATED) -> DataFrame:
    """(doc_id, source, lang, reading_level) of each non-blank text.

    Grades and calibration are fitted on at most `max_rated` rated documents; the word table is bounded
    by their words. Several ratings of a document count in parts; ratings outside 1 to 4, and of missing
    or blank documents, are ignored. A text without known words gets the most frequent rated level (2
    without any rating). Repeated rows are kept; an empty table gives an empty result; other columns are
    ignored; languages are compared in lower case.
    """
    spark = df.sparkSession
    texts = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.lower(F.col(lang_col).cast("string")).alias("lang"), F.col(text_col).cast("string").alias("text")).filter(F.col("text").rlike(r"(?U)\S"))
    rated = ratings.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("reading_level").cast("int").alias("level")).filter(f"doc_id IS NOT NULL AND level BETWEEN 1 AND {LEVELS}").groupBy("doc_id").agg(F.sort_array(F.collect_list("level")).alias("levels"))
    rated = materialize(rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rated), "p10r")
    sample = texts.join(F.broadcast(rated), "doc_id").select("text", "levels")  # at most max_rated rows
    tally = sample.mapInPandas(_tally, "word string, " + ", ".join(f"n{i + 1} double" for i in range(LEVELS)))
    parts = [F.sum(f"n{i + 1}").alias(f"n{i + 1}") for i in range(LEVELS)]
    frequent = tally.groupBy("word").agg(*parts).filter(" + ".join(f"n{i + 1}" for i in range(LEVELS)) + f" >= {MIN_DOCS}")
    counts = {r.word: [r[i + 1] for i in range(LEVELS)] for r in frequent.collect()}
    totals = np.zeros(LEVELS)
    for r in rated.select(F.explode("levels").alias("level"), (1 / F.size("levels")).alias("part")).groupBy("level").agg(F.sum("part").alias("n")).collect():
        totals[r.level - 1] = r.n
    default = int(totals.argmax()) + 1 if totals.any() else 2
    grades = spark.sparkContext.broadcast(acquisition_grades(counts, totals))
    described = materialize(spread(texts).mapInPandas(_describe(grades), "doc_id bigint, source string, lang string, x array<double>"), "p10x")
    train = described.join(F.broadcast(rated), "doc_id").filter("x IS NOT NULL").select("x", "levels").toPandas()
    if len(train):
        y = np.array([[np.mean(np.asarray(v) == i + 1) for i in range(LEVELS)] for v in train["levels"]])
        model = calibrate(np.stack(train["x"].to_list()), y)
    else:
        w = np.zeros((N_FEATURES + 1, LEVELS))
        w[-1, default - 1] = 1.0
        model = np.zeros(N_FEATURES), np.ones(N_FEATURES), w
    return described.mapInPandas(_predict(*model, default), "doc_id bigint, source string, lang string, reading_level int")


def level_profile(levels: DataFrame) -> DataFrame:
    """(source, lang, reading_level, documents, share): how demanding each source's texts are, by language."""
    from pyspark.sql import Window

    counts = levels.groupBy("source", "lang", "reading_level").agg(F.count(F.lit(1)).alias("documents"))
    return counts.withColumn("share", F.col("documents") / F.sum("documents").over(Window.partitionBy("source", "lang")))
