"""Validated, idempotent publishing of tables."""

from __future__ import annotations

import hashlib
import json
import sqlite3
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trisieve.operators.select import best_per_key


def _fs(df: DataFrame, path: str):
    jvm = df.sparkSession.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def publish(df: DataFrame, path: str, validate: Callable[[DataFrame], object] | None = None, replace: bool = False, dictionary: list[str] = [], block_bytes: int | None = None, partition_by: list[str] = []) -> str | None:  # noqa: B006
    """Writes Parquet beside the target, validates what was written and renames it into place.

    An existing target is refused, or with `replace` renamed to a backup with a time stamp, whose path
    is returned. If validation raises, the target is untouched and the staging folder is removed.
    """
    fs, where = _fs(df, path)
    if fs.exists(where(path)) and not replace:
        raise FileExistsError(path)
    staging = f"{path.rstrip('/')}_staging_{uuid.uuid4().hex[:8]}"
    writer = df.write.option("compression", "zstd").option("compression.codec.zstd.level", 3)
    for column in dictionary:
        writer = writer.option(f"parquet.enable.dictionary#{column}", "true")
    if block_bytes:
        writer = writer.option("parquet.block.size", block_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(staging)
        if validate is not None:
            validate(df.sparkSession.read.parquet(staging))
    except BaseException:
        fs.delete(where(staging), True)
        raise
    backup = None
    if fs.exists(where(path)):
        backup = f"{path.rstrip('/')}_backup_{time.strftime('%Y%m%d%H%M%S', time.gmtime())}_{uuid.uuid4().hex[:4]}"
        fs.rename(where(path), where(backup))
    fs.rename(where(staging), where(path))
    return backup


def append_new(df: DataFrame, path: str, key: str, order_by: list[Column] | None = None) -> int:
    """Appends the rows whose key is not in the target yet; returns their number.

    Of rows with one key the first in `order_by` counts, by default in the order of all columns.
    """
    fs, where = _fs(df, path)
    fresh = best_per_key(df.filter(F.col(key).isNotNull()), [key], order_by or [F.col(c) for c in df.columns if c != key] or [F.lit(0)])
    if fs.exists(where(path)):
        fresh = fresh.join(df.sparkSession.read.parquet(path).select(key), key, "left_anti")
    watch = Observation("append")
    fresh.observe(watch, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return watch.get.get("n", 0)


def refuse_filled(df: DataFrame) -> DataFrame:
    """Raises if a target already has rows."""
    if not df.isEmpty():
        raise FileExistsError("the target is not empty")
    return df


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.option("header", True).csv(path)


def file_digests(df: DataFrame, path: str) -> dict[str, str]:
    """SHA-256 of each data file of a published table, read through the file system in pieces."""
    fs, where = _fs(df, path)
    out, files = {}, fs.listFiles(where(path), True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        stream, digest = fs.open(status.getPath()), hashlib.sha256()
        channel = df.sparkSession.sparkContext._jvm.org.apache.commons.io.IOUtils
        try:
            at, length = 0, status.getLen()
            while at < length:
                size = min(1 << 22, length - at)
                digest.update(bytes(channel.readFully(stream, int(size))))
                at += size
        finally:
            stream.close()
        out[name] = digest.hexdigest()
    return out


def copy_to_sqlite(df: DataFrame, path: str, table: str, key: str | None = None) -> int:
    """Copies a table row by row into one local SQLite file, checks its integrity and number of rows.

    For small exports: the rows pass through the driver one partition at a time.
    """
    if not table.replace("_", "").isalnum():
        raise ValueError(f"unsafe table name {table!r}")
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "float": "REAL", "boolean": "INTEGER"}
    columns = ", ".join(f'"{n}" {kinds.get(k, "TEXT")}' + (" PRIMARY KEY" if n == key else "") for n, k in df.dtypes)
    with sqlite3.connect(path) as con:
        con.execute(f'CREATE TABLE "{table}" ({columns})')
        marks = ", ".join("?" * len(df.columns))
        con.executemany(f'INSERT OR IGNORE INTO "{table}" VALUES ({marks})', (tuple(r) for r in df.toLocalIterator()))
        con.commit()
        if con.execute("PRAGMA integrity_check").fetchone()[0] != "ok":
            raise OSError("the copy is damaged")
        n = con.execute(f'SELECT count(*) FROM "{table}"').fetchone()[0]
    wanted = df.select(key).distinct().count() if key else df.count()
    if n != wanted:
        raise OSError(f"{n} rows instead of {wanted}")
    return n


def reusable(spark, path: str, metadata: dict, build: Callable[[], DataFrame], rebuild: bool = False) -> DataFrame:
    """A derived table (such as an index) that is built once for given metadata and then read again.

    The metadata are stored beside the data; other metadata, or `rebuild`, make it anew. The table is
    published as a whole, so an interrupted build leaves nothing behind.
    """
    stamp = json.dumps(metadata, sort_keys=True)
    probe = spark.range(0)
    fs, where = _fs(probe, path)
    notes = f"{path.rstrip('/')}.meta"
    if not rebuild and fs.exists(where(path)) and fs.exists(where(notes)) and [r.value for r in spark.read.text(notes).collect()] == [stamp]:
        return spark.read.parquet(path)
    publish(build(), path, replace=True)
    spark.createDataFrame([(stamp,)], "value string").coalesce(1).write.mode("overwrite").text(notes)
    return spark.read.parquet(path)
