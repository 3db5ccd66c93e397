"""Ranked selection, quotas, samples, row numbers and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisieve.functions.keys import digest
from trisieve.runtime import bounded_join, materialize

#: Row numbers in one slice of a key.
SLICE = 100_000


def best_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """The first row of each key in the given order (which should end in a unique column)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: list[str], order_by: list[Column], n: int | Column, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))).filter(F.col(rank) <= n)


def row_index(df: DataFrame, order_by: list[str], name: str = "row_index") -> DataFrame:
    """Adds a dense number from 0 in the given order, without a single-task sort.

    The rows are range-partitioned and written once; each partition's first number is the sum of the
    sizes before it (one row a partition). Rows that are equal in `order_by` keep any order.
    """
    sorted_ = df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in order_by]).sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in order_by])
    held = materialize(sorted_.withColumn("_at", F.monotonically_increasing_id()), "rows")
    part = F.shiftright("_at", 33)
    sizes = held.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    first = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = materialize(sizes.select("_part", first.alias("_first")), "starts")
    joined = bounded_join(held.withColumn("_part", part), starts, ["_part"], by=["_at"])
    return joined.withColumn(name, F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_first", "_at")


def numbered(df: DataFrame, key: str, order_by: list[str], name: str, slice_: int = SLICE) -> DataFrame:
    """Adds each row's number from 0 within its key, in the given order; null is a key like any other.

    A key's rows are numbered in slices of row numbers, whose sizes are summed, so a very frequent key is
    no single task.
    """
    rows = row_index(df, order_by, "_row").withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))).withColumn("_part", F.floor(F.col("_row") / slice_))
    held = materialize(rows.withColumn("_in", F.row_number().over(Window.partitionBy("_key", "_part").orderBy("_row"))), "numbered")
    sizes = held.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = materialize(sizes.select("_key", "_part", before.alias("_before")), "starts")
    joined = bounded_join(held, starts, ["_key", "_part"], by=["_row"])
    return joined.withColumn(name, F.col("_in") + F.col("_before") - 1).drop("_key", "_part", "_row", "_in", "_before")


def page(df: DataFrame, key: str, after, n: int) -> DataFrame:
    """The next n rows behind a key, in key order."""
    return (df if after is None else df.filter(F.col(key) > F.lit(after))).orderBy(key).limit(n)


def hash_fraction(key: Column, salt: str = "") -> Column:
    """A reproducible number in [0, 1) from a key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), key)), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def hash_sample(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Keeps the rows whose key hash is below the fraction; the same rows on any cluster."""
    return df.filter(hash_fraction(F.col(key), salt) < fraction)


def adaptive_sample(df: DataFrame, key: str, target: int, least: int = 0) -> DataFrame:
    """About twice the target by hash, at least 5 %, then exactly the target by hash order.

    Raises if fewer than `least` rows are there.
    """
    total = df.count()
    percent = min(100.0, max(5.0, 200.0 * target / max(total, 1)))
    out = hash_sample(df, key, percent / 100).orderBy(hash_fraction(F.col(key)), key).limit(target)
    if least and (n := out.count()) < least:
        raise ValueError(f"only {n} rows where {least} are needed")
    return out


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Rows in an order given by a keyed hash."""
    return df.orderBy(digest(F.lit(str(seed)), F.col(key)), key)


def quotas(total: int, groups: int) -> list[int]:
    """Equal parts; the first groups take the remainder."""
    return [total // groups + (i < total % groups) for i in range(groups)] if groups > 0 else []


def even_indices(n: Column, k: int) -> Column:
    """Up to k evenly spaced whole numbers in [0, n); halves go to the even neighbour."""
    many = F.array_distinct(F.transform(F.sequence(F.lit(0), F.least(F.lit(k), n) - 1), lambda i: F.bround(i * (n - 1) / (F.least(F.lit(k), n) - 1)).cast("bigint")))
    return F.when(n < 1, F.array().cast("array<bigint>")).when(F.least(F.lit(k), n) == 1, F.array(F.floor(n / 2).cast("bigint"))).otherwise(many)


def even_groups(df: DataFrame, order_by: list[str], group_size: int, k: int) -> DataFrame:
    """The rows of k evenly spaced groups of `group_size` consecutive rows, with `row_index` and `row_group`."""
    numbered = row_index(df, order_by).withColumn("row_group", F.floor(F.col("row_index") / group_size))
    picked = numbered.agg((F.max("row_group") + 1).alias("n")).select(F.explode(even_indices(F.coalesce("n", F.lit(0)), k)).alias("row_group"))
    return numbered.join(F.broadcast(picked), "row_group")  # k rows


def quota_select(df: DataFrame, quota: DataFrame, key: str, order_by: list[Column]) -> DataFrame:
    """Up to `quota` rows of each key, in the given order; keys without a quota give no row."""
    table = materialize(quota.select(key, "quota"), "quota")
    joined = bounded_join(df, table, [key], by=df.columns[:1], how="inner")
    # a constant limit lets Spark cut a hot key's rows before the shuffle
    most = table.agg(F.max("quota")).first()[0] or 0
    return top_per_key(joined, [key], order_by, most).filter(F.col("rank") <= F.col("quota")).drop("quota")


def exact_quotas(df: DataFrame, quota: DataFrame, key: str, order_by: list[Column], unique: list[list[str]]) -> DataFrame:
    """Exactly `quota` rows of each key, in the given order.

    Raises if a key has fewer rows, or if rows of the selection agree in one of the column groups `unique`
    (compared without case).
    """
    rows = materialize(quota_select(df, quota, key, order_by), "quotas")
    got = quota.select(key, "quota").join(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), key, "left").filter(F.coalesce("_n", F.lit(0)) != F.col("quota")).orderBy(key).first()
    if got is not None:
        raise ValueError(f"{got[key]}: selected {got['_n'] or 0} rows where {got['quota']} are needed")
    for columns in unique:
        folded = [F.replace(F.lower(F.col(x).cast("string")), F.lit("ß"), F.lit("ss")).alias(f"_{i}") for i, x in enumerate(columns)]
        if not rows.groupBy(*folded).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
            raise ValueError(f"the selection repeats {', '.join(columns)}")
    return rows


def two_tier(df: DataFrame, source: str, preferred: str, other: str, order_by: list[Column], n: int) -> DataFrame:
    """Up to n rows of the preferred source, filled up to n with rows of the other."""
    first = df.filter(F.col(source) == preferred).orderBy(*order_by).limit(n)
    taken = first.agg(F.count(F.lit(1)).alias("_taken"))
    second = df.filter(F.col(source) == other).orderBy(*order_by).limit(n)
    rank = F.row_number().over(Window.partitionBy(source).orderBy(*order_by))  # at most n rows
    second = second.withColumn("_rank", rank).crossJoin(F.broadcast(taken)).filter(F.col("_rank") <= n - F.col("_taken")).drop("_rank", "_taken")  # one row
    return first.unionByName(second)


def diverse_top(df: DataFrame, anchor_rank: str, issues: str, order_by: list[Column], n: int) -> DataFrame:
    """All first-ranked rows before the others; these by issues and rank; n rows."""
    first = F.col(anchor_rank) == 1
    return df.orderBy(F.when(first, 0).otherwise(1), F.when(first, 0).otherwise(F.col(issues)), F.col(anchor_rank), *order_by).limit(n)


def top_quality(df: DataFrame, n: int) -> DataFrame:
    """Ranked export of triplets: exact repeats dropped, ranked within an anchor, diverse anchors first."""
    from trisieve.functions.keys import triplet_hash
    from trisieve.operators import quality as q

    a, p, h = F.col("anchor"), F.col("positive"), F.col("hard_negative")
    rows = df.filter((F.trim(a) != "") & (F.trim(p) != "") & (F.trim(h) != "") & (a != p) & (a != h) & (p != h))
    rows = rows.select("data_id", "source", "title", "topic", a, p, h, q.chunk_index(F.col("data_id")).alias("chunk_index"), q.quality_issues(a, p, h).alias("quality_issues"), q.mentions_title(F.col("title"), p).alias("mentions_title"), q.ends_sentence(p).alias("ends_sentence"), triplet_hash(a, p, h).alias("_triplet"))
    tail = [F.col("chunk_index"), F.desc("mentions_title"), F.desc("ends_sentence"), F.md5("data_id")]
    rows = best_per_key(rows, ["_triplet"], [F.col("quality_issues"), F.col("chunk_index"), F.col("data_id")])
    # n rows of an anchor come before any further one of it, so the limit loses none and cuts a hot anchor before the shuffle
    rows = top_per_key(rows, ["anchor"], [F.col("quality_issues"), *tail], n, rank="anchor_rank")
    return diverse_top(rows, "anchor_rank", "quality_issues", tail, n).drop("_triplet")


def best_scored(ids: Column, scores: Column, excluded: Column | None = None) -> Column:
    """struct<score,id> of the highest finite score outside `excluded`, the smaller id at a tie; null if none."""
    pairs = F.arrays_zip(ids.alias("id"), scores.alias("score"))
    usable = F.filter(pairs, lambda x: x["id"].isNotNull() & x["score"].isNotNull() & ~F.isnan(x["score"]) & (F.abs(x["score"]) < float("inf")) & (F.lit(True) if excluded is None else ~F.array_contains(excluded, x["id"])))
    best = F.array_max(F.transform(usable, lambda x: F.struct(x["score"].cast("double").alias("score"), (-x["id"]).alias("id"))))
    return F.when(best.isNotNull(), F.struct(best["score"].alias("score"), (-best["id"]).alias("id")))


def first_acceptable(df: DataFrame, keys: list[str], accept: Column, rank: Column, value: str) -> DataFrame:
    """The value of the accepted row with the lowest rank for each key."""
    return df.filter(accept).groupBy(*keys).agg(F.min_by(value, rank).alias(value))


def mined_pairs(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(qid, positive and best negative with scores, reason) from rows of scored candidate lists.

    Columns: qid, pos, pos_score, neg, neg_score. The negative is no positive of the row and scores
    strictly above the threshold. Reasons: invalid_schema (a list is null), unaligned_scores,
    no_positive, no_negative, below_threshold; null if accepted.
    """
    lists = ["pos", "pos_score", "neg", "neg_score"]
    missing = F.col("qid").isNull()
    for c in lists:
        missing = missing | F.col(c).isNull()
    rows = df.withColumn("_p", best_scored(F.col("pos"), F.col("pos_score"))).withColumn("_n", best_scored(F.col("neg"), F.col("neg_score"), F.col("pos")))
    reason = F.when(missing, "invalid_schema").when((F.size("pos") != F.size("pos_score")) | (F.size("neg") != F.size("neg_score")), "unaligned_scores").when(F.col("_p").isNull(), "no_positive").when(F.col("_n").isNull(), "no_negative").when(F.col("_n.score") <= threshold, "below_threshold")
    return rows.select("qid", F.col("_p.id").alias("positive_doc_id"), F.col("_p.score").alias("positive_score"), F.col("_n.id").alias("hard_negative_doc_id"), F.col("_n.score").alias("hard_negative_score"), reason.alias("reason"))
