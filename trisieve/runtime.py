"""Session helpers shared by all operators: shared scratch tables, input spreading, skew-safe joins."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side may be broadcast explicitly only when it was counted and measured: at most so many rows and bytes.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20

#: Rows of one key that one salt slice of a skewed join handles.
ROWS_PER_SALT = 20_000

_scratch: list[tuple[SparkSession, str]] = []


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for scratch tables that all executors share.

    It is the session's spark.checkpoint.dir; only where that is unset and the master is local (tests,
    one machine) a temporary folder is made and set.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = getattr(spark.sparkContext, "_trisieve_dir", None)
        if not found:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            found = "file://" + tempfile.mkdtemp(prefix="trisieve-")
            spark.sparkContext._trisieve_dir = found
            spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def free_scratch() -> None:
    """Deletes all scratch tables of this process; DataFrames made so far must not be used any more."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session may be gone
            pass


atexit.register(free_scratch)


def materialize(df: DataFrame, label: str = "t") -> DataFrame:
    """Writes `df` as a table in the shared folder and reads it back.

    This cuts the lineage; unlike an executor-local copy it survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/trisieve/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _scratch.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin repartitioning, but only where the scan has fewer splits than the cluster has cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if _splits(df, cores) >= cores else df.repartition(2 * cores)


def _splits(df: DataFrame, cores: int) -> int:
    """About how many splits the scans of a plan have, from the sizes that the optimizer knows; nothing runs."""
    conf, leaves = df.sparkSession._jsparkSession.sessionState().conf(), df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        size = int(str(leaves.apply(i).stats().sizeInBytes()))
        total += -(-size // min(conf.filesMaxPartitionBytes(), max(conf.filesOpenCostInBytes(), -(-size // cores))))
    return total


def small(df: DataFrame, rows: int | None = None) -> bool:
    """Whether a materialized table may be broadcast, with at most BROADCAST_ROWS or the given number of rows."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= BROADCAST_BYTES and df.count() <= (BROADCAST_ROWS if rows is None else rows)


def bounded_join(left: DataFrame, right: DataFrame, on: list[str], by: list[str], how: str = "left", salts: int = 16) -> DataFrame:
    """Joins a possibly very skewed left side with a materialized right side of unique keys.

    The right side is counted: up to BROADCAST_ROWS rows and BROADCAST_BYTES it is broadcast, beyond that every
    right row is repeated once per salt, so a left key with a third of all rows spreads over `salts` tasks. The
    salt is a hash of the left columns `by`, so that a task run again gives the same rows. The repeated side is merged:
    Spark goes by its compressed bytes and would broadcast through the driver what is far larger in memory.
    """
    if small(right):
        return left.join(F.broadcast(right), on, how)
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    return left.join(salted.hint("merge"), [*on, "_salt"], how).drop("_salt")


def pair_join(left: DataFrame, right: DataFrame, on: list[str], sizes: DataFrame, size: str, by: list[str]) -> DataFrame:
    """Inner join of two sides that may both repeat a key very often.

    `sizes` has one row for each key with its number of left rows in `size`. The left rows of a key
    are cut into slices of about ROWS_PER_SALT rows, by a hash of the left columns `by`, and the right
    rows are repeated for each slice.
    """
    slices = F.ceil(F.col(size) / F.lit(ROWS_PER_SALT)).cast("int")
    many = materialize(sizes.select(*on, slices.alias("_slices")).filter("_slices > 1"), "hot")
    # at most one row for ROWS_PER_SALT rows of the left side
    many = F.broadcast(many) if small(many) else many
    left = left.join(many, on, "left").withColumn("_slice", F.pmod(F.xxhash64(*by), F.coalesce("_slices", F.lit(1))).cast("int")).drop("_slices")
    right = right.join(many, on, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1))).drop("_slices")
    return left.join(right, [*on, "_slice"]).drop("_slice")
