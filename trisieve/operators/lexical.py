"""Lexical hard negatives from shared title words of documents that are near in the corpus order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trisieve.functions.text import title_words
from trisieve.operators.select import row_index
from trisieve.runtime import bounded_join, materialize

WINDOW = 20
#: Best candidates whose texts are tried first.
TRY_FIRST = 5
FALLBACKS = 100
#: Document numbers in one slice of a posting list.
SLICE = 100_000


def postings(docs: DataFrame, slice_: int = SLICE) -> DataFrame:
    """(idx, title, token, pos): each document's place in the ordered list of each of its title words.

    A list is numbered in slices of document numbers, whose sizes are summed, so a very frequent word
    is no single task.
    """
    tokens = docs.select("idx", "title", F.explode(title_words(F.col("title"))).alias("token")).withColumn("slice", F.floor(F.col("idx") / slice_))
    inside = F.row_number().over(Window.partitionBy("token", "slice").orderBy("idx"))
    numbered = materialize(tokens.withColumn("at", inside), "postings")
    sizes = numbered.groupBy("token", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("token").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = materialize(sizes.select("token", "slice", before.alias("before")), "slices")
    return bounded_join(numbered, starts, ["token", "slice"], by=["idx"]).select("idx", "title", "token", (F.col("at") + F.col("before") - 1).alias("pos"))


def candidates(posted: DataFrame, window: int = WINDOW) -> DataFrame:
    """(idx, other, score): other titles within `window` places in a shared word's list, and how many words agree.

    The band join meets only the own and the two neighbouring buckets of window + 1 places, each of
    bounded size.
    """
    width = window + 1
    left = posted.select("idx", "title", "token", "pos", F.explode(F.array(*[F.floor(F.col("pos") / width) + d for d in (-1, 0, 1)])).alias("bucket"))
    right = posted.select(F.col("idx").alias("other"), F.col("title").alias("other_title"), "token", F.col("pos").alias("other_pos"), F.floor(F.col("pos") / width).alias("bucket"))
    near = left.join(right, ["token", "bucket"]).filter((F.abs(F.col("pos") - F.col("other_pos")) <= window) & (F.col("idx") != F.col("other")) & ~F.col("title").eqNullSafe(F.col("other_title")))
    return near.groupBy("idx", "other").agg(F.count(F.lit(1)).alias("score"))


def lexical_negatives(df: DataFrame, id_col: str, title_col: str, text_col: str, passage_col: str) -> DataFrame:
    """(id, negative_id, hard_negative): for each document the best passage of another title that its text does not hold.

    Candidates are ranked by shared title words, then nearness in id order, then order; without a usable
    one the next documents in circular order are tried, up to FALLBACKS of them. Documents with neither
    give a null negative.
    """
    docs = materialize(row_index(df.select(F.col(id_col).alias("id"), F.col(title_col).alias("title"), F.col(text_col).alias("text"), F.col(passage_col).alias("passage")), ["id"], "idx"), "docs")
    order = [F.desc("score"), F.abs(F.col("idx") - F.col("other")), F.col("other")]
    ranked = materialize(candidates(postings(docs)).withColumn("rank", F.row_number().over(Window.partitionBy("idx").orderBy(*order))), "ranked")
    own = docs.select("idx", "text")
    passages = docs.select(F.col("idx").alias("other"), F.col("id").alias("negative_id"), "passage")

    def choose(tried: DataFrame) -> DataFrame:
        usable = tried.join(passages, "other").join(own, "idx").filter((F.col("passage") != "") & ~F.contains(F.col("text"), F.col("passage")))
        return usable.groupBy("idx").agg(F.min_by(F.struct("negative_id", "passage"), "rank").alias("x"))

    first = materialize(choose(ranked.filter(F.col("rank") <= TRY_FIRST)), "first")
    second = materialize(choose(ranked.filter(F.col("rank") > TRY_FIRST).join(first, "idx", "left_anti")), "second")
    done = first.unionByName(second)
    n = docs.count()
    open_ = docs.join(done, "idx", "left_anti").select("idx", "title")
    offsets = F.explode(F.sequence(F.lit(1), F.lit(max(1, n - 1)))) if n <= FALLBACKS else F.explode(F.sequence(F.lit(1), F.lit(FALLBACKS)))
    circle = open_.select("idx", "title", offsets.alias("rank")).withColumn("other", F.pmod(F.col("idx") + F.col("rank"), F.lit(max(n, 1))))
    circle = circle.join(docs.select(F.col("idx").alias("other"), F.col("title").alias("other_title")), "other").filter(~F.col("title").eqNullSafe(F.col("other_title")) & (F.col("idx") != F.col("other")))
    every = done.unionByName(choose(circle.select("idx", "other", "rank")))
    return docs.select("id", "idx").join(every, "idx", "left").select("id", F.col("x.negative_id").alias("negative_id"), F.col("x.passage").alias("hard_negative"))
