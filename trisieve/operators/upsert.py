"""Merge-style writes as table-to-table operators; the result is the new version of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisieve.operators.select import best_per_key


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str, order_by: list[Column]) -> DataFrame:
    """The existing rows and those new ones whose key is absent; the first of new rows with one key wins.

    `inserted` tells which rows are new. Rows without a key are never inserted.
    """
    fresh = best_per_key(new.filter(F.col(key).isNotNull()).join(existing.select(key), key, "left_anti"), [key], order_by)
    return existing.withColumn("inserted", F.lit(False)).unionByName(fresh.withColumn("inserted", F.lit(True)), allowMissingColumns=True)


def upsert_better(existing: DataFrame, new: DataFrame, key: str, score: str, order_by: list[Column]) -> DataFrame:
    """The whole row with the highest score of each key; at a tie the existing row, then the given order."""
    both = existing.withColumn("_new", F.lit(1)).unionByName(new.withColumn("_new", F.lit(2)))
    return best_per_key(both, [key], [F.desc_nulls_last(score), F.col("_new"), *order_by]).drop("_new")


def upsert_fields(existing: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """All keys of both sides (each unique); new non-null values of `fields` replace the old ones."""
    old, fresh = existing.select(key, *[F.col(f).alias(f"_old_{f}") for f in fields]), new.select(key, *fields)
    joined = old.join(fresh, key, "full_outer")
    return joined.select(key, *[F.coalesce(F.col(f), F.col(f"_old_{f}")).alias(f) for f in fields])


def update_changed(df: DataFrame, column: str, new: Column) -> DataFrame:
    """The table with the column's new value and a `changed` flag (null-safe)."""
    return df.withColumn("_new", new).withColumn("changed", ~F.col("_new").eqNullSafe(F.col(column))).withColumn(column, F.col("_new")).drop("_new")


def pending(todo: DataFrame, status: DataFrame, key: str, done: Column) -> DataFrame:
    """Rows that have no status row which is done."""
    return todo.join(status.filter(done).select(key), key, "left_anti")
