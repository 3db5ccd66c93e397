"""Problem 9: records of several sources are combined to target shares, with capped repeats.

Method: hash-threshold histograms. Tokens are summed by source and hash bucket, the budget's threshold is
found in the cumulated histogram, only the boundary bucket is refined by further bits, and a filter on
the hash chooses the records, without sorting. The thresholds of the repeats of a source are nested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisieve.llm.tokens import TOKENIZERS, VOCABULARY, token_counts
from trisieve.runtime import bounded_join, materialize

#: Hash bits read at each level; together all 62 bits of the hash.
BITS = (10, 13, 13, 13, 13)
SEED = 20


def _budgets(counted: DataFrame, targets: DataFrame, total: int | None) -> DataFrame:
    """(source, target_share, max_repeats, available, budget, base, need) of each target source."""
    wanted = targets.select(F.col("source").cast("string").alias("source"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats")).filter("source IS NOT NULL").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    sums = counted.groupBy("source").agg(F.sum("tokens").alias("available"))
    table = wanted.join(sums, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    size = F.lit(total) if total is not None else F.sum("available").over(Window.partitionBy(F.lit(1)))
    table = table.withColumn("budget", F.round(F.coalesce("target_share", F.lit(0.0)) * size).cast("bigint"))
    most = F.coalesce("max_repeats", F.lit(1)) * F.col("available")
    reach = F.least(F.col("budget"), most)
    base = F.when(F.col("available") > 0, F.floor(reach / F.col("available"))).otherwise(0).cast("bigint")
    return materialize(table.withColumn("base", base).withColumn("need", reach - base * F.col("available")), "p9b")


def _thresholds(counted: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): the hash below which the records of a source are used once more."""
    state = materialize(budgets.filter("need > 0").select("source", F.lit(0).cast("bigint").alias("prefix"), "need"), "p9s")
    done, left, used = [], 62, 0
    for bits in BITS:
        left -= bits
        used += bits
        inside = bounded_join(counted, state, ["source"], by=["doc_id"], how="inner").filter(F.shiftrightunsigned("h", left + bits) == F.col("prefix"))
        histogram = inside.groupBy("source", F.shiftrightunsigned("h", left).alias("bucket")).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"), F.max("h").alias("last"), F.max("need").alias("need"))
        upto = F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket"))  # at most 2 ** bits rows a source
        edge = histogram.withColumn("upto", upto).filter("upto >= need AND upto - tokens < need")
        edge = materialize(edge.select("source", F.col("bucket").alias("prefix"), (F.col("need") - F.col("upto") + F.col("tokens")).alias("need"), "tokens", "n", "last"), "p9e")
        # a bucket of one record needs no refinement: it is in if that comes closer to the budget
        cut = F.when(F.col("need") * 2 >= F.col("tokens"), F.col("last") + 1).otherwise(F.shiftleft("prefix", left))
        final = edge if not left else edge.filter("n = 1")
        done.append(final.select("source", cut.alias("threshold")))
        state = edge.filter("n > 1").select("source", "prefix", "need")
        if not left or state.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return materialize(out, "p9t")


def _hash() -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id"), 2)


def mix(df: DataFrame, targets: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", total_tokens: int | None = None, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The chosen records (doc_id, source, tokens, repeats) and the report of the shares.

    The mixture's size is `total_tokens`, by default that of all documents of the target sources. A
    source that cannot reach its share under the cap is used as often as allowed and reported as such.
    Blank texts, records without source, and sources without a target are not used; a null cap is 1, a
    null share is 0; of repeated target rows the largest share and cap hold; repeated records count as
    records, but share one threshold. Empty tables give empty results.

    Report: (source, target_share, actual_share, budget, tokens, available, max_repeats, reached).
    """
    named = df.withColumn("_source", F.col(source_col).cast("string")).filter("_source IS NOT NULL")
    counted = token_counts(named.select(F.col(id_col).alias("_id"), "_source", F.col(text_col).alias("_text")), "_id", "_text", ["_source"], folder, vocabulary).withColumnRenamed("_source", "source")
    counted = materialize(counted.withColumn("h", _hash()), "p9")
    budgets = _budgets(counted, targets, total_tokens)
    limits = materialize(budgets.join(_thresholds(counted, budgets), "source", "left").select("source", "base", F.coalesce("threshold", F.lit(0)).alias("threshold")), "p9l")
    repeats = F.col("base") + (F.col("h") < F.col("threshold")).cast("bigint")
    chosen = bounded_join(counted, limits, ["source"], by=["doc_id"], how="inner").select("doc_id", "source", "tokens", repeats.cast("int").alias("repeats")).filter("repeats > 0")
    got = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"))
    report = budgets.join(got, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    share = F.try_divide(F.col("tokens").cast("double"), F.sum("tokens").over(Window.partitionBy(F.lit(1))))
    reached = F.coalesce("max_repeats", F.lit(1)) * F.col("available") >= F.col("budget")
    return chosen, report.select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce(share, F.lit(0.0)).alias("actual_share"), "budget", "tokens", "available", "max_repeats", reached.alias("reached"))
