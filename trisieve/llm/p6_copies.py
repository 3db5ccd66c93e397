"""Problem 6: records that differ only in white space, case, punctuation or field order.

Method: recursive radix partitioning on canonical bytes, the UTF-8 bytes of the canonical text. Equal records
are first folded inside each Arrow batch; bucket sizes are counted by leading bytes, buckets above a constant
limit that hold more than one record are split by further bytes until each fits, and one trie per bucket
counts the records at its terminals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisieve.runtime import bounded_join, materialize, pair_join, spread

#: Folded entries a bucket may hold, at any size of the input.
BUCKET_ROWS = 20_000
#: Leading bytes kept beside the text, so that counting seldom reads it.
HEAD = 64


def canonical_text(fields: list[str]) -> Column:
    """The fields without white space and punctuation, case-folded, nulls empty, in sorted order."""

    def plain(c: str) -> Column:
        folded = F.regexp_replace(F.lower(F.upper(F.coalesce(F.col(c).cast("string"), F.lit("")))), "ς", "σ")
        return F.regexp_replace(folded, r"[\p{P}\p{Z}\s\x1c-\x1f\x{85}]+", "")

    return F.array_join(F.sort_array(F.array(*[plain(c) for c in fields])), "\x1f")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal records of one batch become one entry with their ids; a batch bounds the list."""
    for batch in batches:
        groups: dict[str, list[str]] = {}
        for key, rid in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            groups.setdefault(key, []).append(rid)
        keys = [k.encode() for k in groups]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.binary()), pa.array([k[:HEAD] for k in keys], pa.binary()), pa.array([hashlib.sha256(k).digest() for k in keys], pa.binary()),
                pa.array([min(x, key=lambda v: (v is None, v)) for x in groups.values()], pa.string()), pa.array([len(x) for x in groups.values()], pa.int64()), pa.array(list(groups.values()), pa.list_(pa.string())),
            ],
            names=["key", "head", "digest", "least", "n", "ids"],
        )


class Trie:
    """Counts keys. An edge is [its bytes, copies, least id, entries, further edges by their first byte].

    Edges hold as many bytes as no key branches in, so texts with long beginnings in common cost no more
    than their number. A key ends at its terminal edge, whose counters are its own.
    """

    def __init__(self) -> None:
        self.root: list = [b"", 0, None, 0, {}]

    @staticmethod
    def _tally(edge: list, n: int, least: str | None) -> None:
        edge[1] += n
        edge[3] += 1
        if least is not None and (edge[2] is None or least < edge[2]):
            edge[2] = least

    def add(self, key: bytes, n: int, least: str | None) -> None:
        edge, at = self.root, 0
        while at < len(key):
            found = edge[4].get(key[at])
            if found is None:
                found = edge[4][key[at]] = [key[at:], 0, None, 0, {}]
                edge, at = found, len(key)
            elif key.startswith(found[0], at):
                edge, at = found, at + len(found[0])
            else:
                label, low, high = found[0], 1, min(len(found[0]), len(key) - at)
                while low < high:  # the bytes in common
                    middle = (low + high + 1) // 2
                    if label[:middle] == key[at : at + middle]:
                        low = middle
                    else:
                        high = middle - 1
                found[0] = label[low:]
                edge[4][key[at]] = [label[:low], 0, None, 0, {label[low]: found}]
        self._tally(edge, n, least)

    def items(self) -> Iterator[tuple[bytes, int, str, int]]:
        """(key, copies, least id, entries) of each key."""
        todo = [(b"", self.root)]
        while todo:
            before, edge = todo.pop()
            here = before + edge[0]
            if edge[3]:
                yield here, edge[1], edge[2], edge[3]
            todo += [(here, child) for child in edge[4].values()]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads a partition sorted by bucket and keeps one bucket's trie at a time."""

    def out(trie: Trie) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            digests, counts, least, entries = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(least, pa.string()), pa.array(entries, pa.int64())], names=["digest", "copies", "keep_id", "entries"])

        for key, n, least, entries in trie.items():
            rows.append((hashlib.sha256(key).digest(), n, least, entries))
            if len(rows) == 20_000:
                yield batch()
                rows.clear()
        if rows:
            yield batch()

    bucket, trie = None, Trie()
    for batch in batches:
        for b, key, n, least in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if b != bucket:
                yield from out(trie)
                bucket, trie = b, Trie()
            trie.add(key, n, least)
    yield from out(trie)


def radix_buckets(folded: DataFrame, limit: int) -> DataFrame:
    """The entries with the `bucket` of each: as many leading bytes as are needed for the bucket to fit.

    Each round takes twice as many bytes, so long beginnings in common need few rounds; a bucket of one
    record only is not split, as its trie is one terminal. The oversized buckets of a round are joined.
    """
    prefix = lambda n: F.substring("head" if n <= HEAD else "key", 1, n)
    rounds: list[tuple[int, DataFrame]] = []
    n = 1
    while True:
        rows = folded.select(prefix(n).alias("bucket"), "digest", *(["head"] if n <= HEAD else ["head", "key"]))
        if rounds:
            length, before = rounds[-1]
            rows = rows.withColumn("_before", F.substring("bucket", 1, length)).join(before.withColumnRenamed("bucket", "_before"), "_before", "left_semi")
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.min("digest").alias("a"), F.max("digest").alias("b"))
        large = materialize(sizes.filter((F.col("rows") > limit) & (F.col("a") != F.col("b"))).select("bucket"), "p6b")
        if large.isEmpty():
            break
        rounds.append((n, large))
        n *= 2
    out, used = folded, F.lit(1)
    for i, (length, large) in enumerate(rounds):
        marked = large.withColumnRenamed("bucket", "_at").withColumn(f"_large{i}", F.lit(True))
        out = bounded_join(out.withColumn("_at", prefix(length)), marked, ["_at"], by=["digest"]).drop("_at")
        used = F.when(F.col(f"_large{i}").isNotNull(), F.lit(2 * length)).otherwise(used)
    return out.withColumn("_used", used).withColumn("bucket", F.expr("substring(key, 1, _used)")).select("bucket", "key", "n", "least")


def folded_records(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(key, head, digest, least, n, ids): the records of a batch with equal canonical bytes, folded into one entry."""
    keyed = spread(df.select(F.col(id_col).cast("string").alias("_id"), *fields)).select(canonical_text(fields).alias("key"), "_id")
    return materialize(keyed.mapInArrow(_fold, "key binary, head binary, digest binary, least string, n bigint, ids array<string>"), "p6")


def counted(folded: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(digest, copies, keep_id, entries) of each distinct record, from one trie for each radix bucket."""
    routed = radix_buckets(folded, bucket_rows)
    return routed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_count, "digest binary, copies bigint, keep_id string, entries bigint")


def distinct_records(df: DataFrame, id_col: str, fields: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row for each distinct record: keep_id (its smallest id) and copies (how many rows hold it).

    White space, case and Unicode punctuation are ignored, the order of the fields does not matter and
    null equals empty. Records of empty fields only are copies of each other. Rows without an id sort
    last; repeated ids count as rows. An empty table gives an empty result; other columns are ignored.
    """
    return counted(folded_records(df, id_col, fields), bucket_rows).select("keep_id", "copies")


def copies(df: DataFrame, id_col: str, fields: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(keep_id, copy_id) for each row but the smallest id of each group of copies.

    The ids return to their group by a join that slices hot groups; see distinct_records for the cases.
    """
    folded = folded_records(df, id_col, fields)
    groups = materialize(counted(folded, bucket_rows).filter("copies > 1"), "p6g")
    back = pair_join(folded.select("digest", "least", "ids"), groups.select("digest", "keep_id"), ["digest"], groups, "entries", by=["least"])
    return back.select("keep_id", F.explode("ids").alias("copy_id")).filter("copy_id <> keep_id")
