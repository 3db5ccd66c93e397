"""Checked joins, expectations, leakage-free hold-outs and ranking metrics."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisieve.functions.keys import digest, stable_id
from trisieve.functions.text import casefold, is_blank, unescaped
from trisieve.operators.quality import distinct_triple
from trisieve.operators.select import even_indices, quotas, row_index
from trisieve.runtime import bounded_join, materialize


class ExpectationError(ValueError):
    """A table did not meet its expectations."""


def expectations(df: DataFrame, unique: list[str] = [], filled: list[str] = [], distinct: list[tuple[str, str]] = [], longest: dict[str, int] = {}, rows: int | None = None, pure: dict[str, str] = {}, absent: dict[str, list[str]] = {}, fail: bool = False) -> DataFrame:  # noqa: B006
    """(check, observed, expected, passed), from one aggregation over the table.

    Checks: number of rows, unique columns, filled columns, distinct columns, longest texts, columns with
    one value only, and markers (such as names of benchmark sources) that a column must not hold. With `fail` a failing check raises.
    """
    checks: list[tuple[str, Column, Column]] = []
    if rows is not None:
        checks.append(("rows", F.count(F.lit(1)), F.lit(rows)))
    checks += [(f"unique {c}", F.count_distinct(c), F.count(F.lit(1))) for c in unique]
    checks += [(f"filled {c}", F.count_if(is_blank(F.col(c))), F.lit(0)) for c in filled]
    checks += [(f"distinct {a} {b}", F.count_if(F.col(a) == F.col(b)), F.lit(0)) for a, b in distinct]
    checks += [(f"longest {c}", F.count_if(F.length(c) > n), F.lit(0)) for c, n in longest.items()]
    checks += [(f"pure {c}", F.count_if(~F.col(c).eqNullSafe(F.lit(v))), F.lit(0)) for c, v in pure.items()]
    for c, marks in absent.items():
        held = F.lit(False)
        for m in marks:
            held = held | F.contains(F.lower(c), F.lit(m.lower()))
        checks.append((f"absent {c}", F.count_if(held), F.lit(0)))
    one = df.agg(*[F.struct(o.cast("bigint").alias("observed"), e.cast("bigint").alias("expected")).alias(f"c{i}") for i, (_, o, e) in enumerate(checks)])
    out = one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"c{i}.observed").alias("observed"), F.col(f"c{i}.expected").alias("expected")) for i, (name, _, _) in enumerate(checks)])).alias("x")).select("x.*").withColumn("passed", F.col("observed") == F.col("expected"))
    if fail and (bad := out.filter("NOT passed").collect()):
        raise ExpectationError("; ".join(f"{r.check}: {r.observed} instead of {r.expected}" for r in bad))
    return out


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct non-null value."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("values")).filter("values > 1")


def many_to_one(left: DataFrame, right: DataFrame, key: str, fail: bool = True) -> DataFrame:
    """Left join with a right side whose key must be unique; `resolved` tells whether a row was found."""
    if fail and not right.groupBy(key).count().filter("count > 1").isEmpty():
        raise ExpectationError(f"{key} is not unique")
    return left.join(right.withColumn("resolved", F.lit(True)), key, "left").withColumn("resolved", F.coalesce("resolved", F.lit(False)))


def resolve_qrels(qrels: DataFrame, queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """(query_id, corpus_id, score, query, passage, state) with state 'ok', 'no_query', 'no_passage' or 'neither'."""
    q = many_to_one(qrels.filter("score > 0"), queries.select("query_id", F.col("text").alias("query")), "query_id").withColumnRenamed("resolved", "_q")
    both = many_to_one(q, corpus.select("corpus_id", F.col("text").alias("passage")), "corpus_id").withColumnRenamed("resolved", "_c")
    state = F.when(F.col("_q") & F.col("_c"), "ok").when(F.col("_q"), "no_passage").when(F.col("_c"), "no_query").otherwise("neither")
    return both.select("query_id", "corpus_id", "score", "query", "passage", state.alias("state"))


def attach_indices(rows: DataFrame, queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """Adds the row index of the query, the positive and the negative document; `mapped` is false where one is missing."""
    q = queries.select(F.col("id").alias("qid"), F.col("row_index").alias("query_row_index"))
    side = lambda x: corpus.select(F.col("id").alias(f"{x}_doc_id"), F.col("row_index").alias(f"{x}_row_index"))
    out = rows.join(q, "qid", "left").join(side("positive"), "positive_doc_id", "left").join(side("hard_negative"), "hard_negative_doc_id", "left")
    return out.withColumn("mapped", F.col("query_row_index").isNotNull() & F.col("positive_row_index").isNotNull() & F.col("hard_negative_row_index").isNotNull())


def without_leaks(df: DataFrame, key: Column, train: DataFrame, train_key: Column) -> DataFrame:
    """Rows whose key does not occur in training."""
    return df.withColumn("_key", key).join(train.select(train_key.alias("_key")), "_key", "left_anti").drop("_key")


def leaked(df: DataFrame, key: Column, train: DataFrame, train_key: Column) -> DataFrame:
    """Rows whose key occurs in training."""
    return df.withColumn("_key", key).join(train.select(train_key.alias("_key")), "_key", "left_semi").drop("_key")


# --- hold-out ---------------------------------------------------------------------------------


def _pick(quota: list[int]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        chosen, used = [], set()
        for group, rows in pdf.sort_values(["shard", "place", "rank"]).groupby(["shard", "place"], sort=True):
            left = quota[group[1]]
            for i, key in zip(rows.index, rows["key"], strict=True):
                if left == 0:
                    break
                if key not in used:
                    used.add(key)
                    chosen.append(i)
                    left -= 1
        return pdf.loc[chosen]

    return run


def holdout_rows(shards: DataFrame, train: DataFrame, requested: int, groups: int, group_size: int, order_by: list[str]) -> DataFrame:
    """(shard, query, positive, negative): hash-ranked rows of evenly spaced row groups, query-disjoint from training.

    `shards` has shard, query, positive, negative. Each shard gives `requested` rows with equal quotas
    for its groups, none for a quota of 0; a query is used once over all. Of each group only as many rows
    as could be needed, even if all queries chosen before were among them, go to the final sequential
    choice: at most requested x shards of each group.
    """
    key = digest(casefold(unescaped(F.col("query"))))
    quota = quotas(requested, groups)
    # the rows of all shards are numbered in one pass
    rows = row_index(shards.filter("shard IS NOT NULL"), ["shard", *order_by], "_row")
    sizes = materialize(rows.groupBy("shard").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")), "shards")
    picked = sizes.select("shard", "_first", F.posexplode(even_indices(F.ceil(F.col("_n") / F.lit(group_size)), groups)).alias("place", "row_group"))
    starts = materialize(picked, "places")  # at most `groups` rows a shard
    at = F.floor((F.col("_row") - F.col("_first")) / F.lit(group_size))
    numbered = bounded_join(rows, sizes.select("shard", "_first"), ["shard"], by=order_by).withColumn("row_group", at).drop("_first")
    parts = bounded_join(numbered, starts.drop("_first"), ["shard", "row_group"], by=order_by, how="inner")
    names = range(sizes.count())
    q, p, n = (unescaped(F.col(c)).alias(c) for c in ("query", "positive", "negative"))
    rows = parts.select("shard", "place", q, p, n).withColumn("key", key)
    rows = rows.filter(distinct_triple(F.col("query"), F.col("positive"), F.col("negative"))).withColumn("rank", digest(F.col("query"), F.col("positive"), F.col("negative")))
    fresh = without_leaks(rows, F.col("key"), train, digest(casefold(unescaped(F.col("query")))))
    own = Window.partitionBy("shard", "place", "key").orderBy("rank", "positive", "negative")
    first = fresh.withColumn("_own", F.row_number().over(own)).filter("_own = 1")
    order = F.row_number().over(Window.partitionBy("shard", "place").orderBy("rank", "positive", "negative"))
    few = materialize(first.withColumn("_at", order).filter(F.col("_at") <= requested * len(names)).select("shard", "place", "query", "positive", "negative", "key", "rank"), "holdout")
    chosen = few.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(_pick(quota), T.StructType([*few.schema.fields, T.StructField("_all", T.IntegerType())]))
    return chosen.select("shard", "query", "positive", "negative")


def holdout_tables(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Queries, corpus and qrels with content-addressed ids; equal texts share one document."""
    qid = lambda c: stable_id("q_", F.col(c), length=20)
    did = lambda c: stable_id("d_", F.col(c), length=20)
    queries = rows.select(qid("query").alias("id"), F.col("query").alias("text"), F.col("shard").alias("source_shard")).dropDuplicates(["id", "text"])
    texts = rows.select(F.col("positive").alias("text")).unionByName(rows.select(F.col("negative").alias("text"))).distinct()
    corpus = texts.select(did("text").alias("id"), F.lit("").alias("title"), "text")
    qrels = rows.select(qid("query").alias("query_id"), did("positive").alias("corpus_id"), F.lit(1).cast("bigint").alias("score"))
    return queries, corpus, qrels


def enough(df: DataFrame, requested: int, share: float = 0.95) -> DataFrame:
    """Raises unless at least `share` of the requested rows are there."""
    if (n := df.count()) < math.ceil(share * requested):
        raise ExpectationError(f"only {n} of {requested} rows")
    return df


def manifest(df: DataFrame, by: list[str], overlap: Column) -> DataFrame:
    """(keys, rows, overlapping, rate) with the rate rounded to six places."""
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(overlap).alias("overlapping"))
    return n.withColumn("rate", F.round(F.col("overlapping") / F.col("rows"), 6))


# --- metrics ----------------------------------------------------------------------------------


def retrieval_metrics(ranks: DataFrame, at: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """One row of recall, MRR and nDCG at k, mean and median rank, for one positive a query."""
    r = F.col("rank")
    aggs = [F.count(F.lit(1)).alias("queries")]
    for k in at:
        inside = r <= k
        aggs.append(F.avg(F.when(inside, 1.0).otherwise(0.0)).alias(f"recall_at_{k}"))
        aggs.append(F.avg(F.when(inside, 1.0 / r).otherwise(0.0)).alias(f"mrr_at_{k}"))
        aggs.append(F.avg(F.when(inside, F.lit(1.0) / F.log2(r + 1.0)).otherwise(0.0)).alias(f"ndcg_at_{k}"))
    return ranks.agg(*aggs, F.avg("rank").alias("mean_rank"), F.median("rank").alias("median_rank"))


def per_query_rank(ranks: DataFrame, k: int = 10) -> DataFrame:
    return ranks.withColumn(f"reciprocal_rank_at_{k}", F.when(F.col("rank") <= k, 1.0 / F.col("rank")).otherwise(F.lit(0.0)))


def mean_score(scores: DataFrame, score: str) -> DataFrame:
    """(mean_score, tasks): the plain mean of one score a task; null scores count as none."""
    return scores.agg(F.avg(score).alias("mean_score"), F.count(score).alias("tasks"))


def training_steps(counts: DataFrame, n: str, batch: int, world: int = 1, drop_last: bool = False) -> DataFrame:
    """(steps): the batches of all tables together; each table's last part counts, or not."""
    each = F.floor(F.col(n) / (batch * world)) if drop_last else F.ceil(F.col(n) / (batch * world))
    return counts.agg(F.sum(each).cast("bigint").alias("steps"))
