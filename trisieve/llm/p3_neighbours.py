"""Problem 3: the k most similar vectors of every vector.

Method: cross-polytope hashing. Fast Hadamard pseudo-rotations turn each unit vector, the nearest signed
axis is a digit of its bucket; several tables, and the next axes of each digit, collect candidates that are
ranked by the exact cosine. Buckets above a constant size are split by a further digit: which they are is
joined to the vectors; a bucket that stays oversized after the last digit is worked off in blocks, each pair
of blocks in a task of its own, so that nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trisieve.runtime import bounded_join, materialize, pair_join, spread

TABLES = 4
#: Digits at most; a digit is only computed where buckets of the one before are oversized.
DIGITS = 8
#: Axes tried for the first digit, and for each further one that a bucket has.
FIRST_AXES, AXES = 2, 3
#: Vectors in a bucket before it is split by another digit, and in a block of a bucket that stays larger.
BUCKET = 4096
#: Candidates of a bucket beside the k that the fast pass keeps for the exact cosine.
SPARE = 5
#: Scores next to each other of which the fast pass first looks at the largest.
STRIP = 32


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, orthonormal; the width is a power of two."""
    n, width = x.shape
    h = 1
    while h < width:
        y = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


@lru_cache(maxsize=256)
def rotation(width: int, table: int, digit: int) -> np.ndarray:
    """Three sign diagonals, each followed by the Hadamard transform, as one matrix.

    At the widths of embeddings one product with it is faster than the transforms of each row.
    """
    rng = np.random.default_rng([5, width, table, digit])
    out = np.eye(width, dtype=np.float32)
    for _ in range(3):
        out = hadamard(out * rng.choice([-1.0, 1.0], size=width).astype(np.float32))
    return out


def axes(unit: np.ndarray, table: int, digit: int, n: int) -> np.ndarray:
    """The n nearest signed axes of each row after one pseudo-rotation, the nearest first."""
    x = unit @ rotation(unit.shape[1], table, digit)
    size = np.abs(x)
    rows = np.arange(len(x))
    best = []
    for _ in range(n):
        at = size.argmax(axis=1)
        best.append(at * 2 + (x[rows, at] < 0))
        size[rows, at] = -1.0
    return np.stack(best, axis=1).astype(np.int64)


def _width(dim: int) -> int:
    return max(2, 1 << (dim - 1).bit_length())


def _bits(dim: int) -> tuple[int, int]:
    """(bits of a digit, digits that fit beside the table in 60 bits)."""
    bits = (2 * _width(dim) - 1).bit_length()
    return bits, min(DIGITS, (60 - (TABLES - 1).bit_length()) // bits)


def _encode(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            lists = batch.column(2)
            # a list counts if it has the right length and no null in it
            right = pc.fill_null(pc.equal(pc.list_value_length(lists), dim), False)
            ids, groups, lists = batch.column(0).filter(right), batch.column(1).filter(right), lists.filter(right)
            values = lists.flatten()
            raw = np.asarray(values.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)
            if values.null_count:
                raw[np.asarray(values.is_null()).reshape(-1, dim)] = np.nan
            with np.errstate(over="ignore", invalid="ignore"):
                norm = np.sqrt((raw * raw).sum(axis=1))
                usable = np.isfinite(raw).all(axis=1) & (norm > 0) & np.isfinite(norm)
            unit = (raw[usable] / norm[usable][:, None]).astype(np.float32)
            same = [hashlib.blake2b(x, digest_size=16).digest() for x in unit]
            keep = pa.array(usable)
            yield pa.RecordBatch.from_arrays(
                [ids.filter(keep), groups.filter(keep), pa.array([x.tobytes() for x in raw[usable].astype(np.float32)], pa.binary()), pa.array(same, pa.binary())], names=["vec_id", "grp", "raw", "same"]
            )

    return run


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """The vectors of a binary column, as float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, dim))
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(np.float32).reshape(len(column), dim).astype(np.float64) if not offsets[0] % 4 else np.frombuffer(data.tobytes(), np.float32).reshape(len(column), dim).astype(np.float64)


def _units(column: pa.Array, dim: int) -> np.ndarray:
    x = _matrix(column, dim)
    x = (x / np.sqrt((x * x).sum(axis=1))[:, None]).astype(np.float32)
    return np.pad(x, ((0, 0), (0, _width(dim) - dim)))


def _home(unit: np.ndarray, table: int, depth: int, bits: int) -> np.ndarray:
    """The bucket of each row in a table with `depth` digits, as a number that begins with the table."""
    code = np.full(len(unit), table, np.int64)
    for d in range(depth):
        code = (code << bits) | axes(unit, table, d, 1)[:, 0]
    return code


def _sizes(dim: int, depth: int):
    """Bucket sizes at a depth, for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, _ = _bits(dim)
        for batch in batches:
            unit = _units(batch.column(1), dim)
            groups = batch.column(0).dictionary_encode()
            which = np.asarray(groups.indices, dtype=np.int64)
            grp, code, n = [], [], []
            for g, name in enumerate(groups.dictionary.to_pylist()):
                part = unit[which == g]
                for t in range(TABLES):
                    found, counts = np.unique(_home(part, t, depth, bits), return_counts=True)
                    grp += [name] * len(found)
                    code.append(found)
                    n.append(counts)
            yield pa.RecordBatch.from_arrays([pa.array(grp, pa.string()), pa.array(np.concatenate(code) if code else [], pa.int64()), pa.array(np.concatenate(n) if n else [], pa.int64())], names=["grp", "code", "n"])

    return run


def _route(dim: int, depth: int):
    """A row for the own bucket of each vector (digit 0) and for each further axis of a digit, in each table.

    The code has `depth` digits, of which a bucket uses the first ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, _ = _bits(dim)
        for batch in batches:
            if not len(batch):
                continue
            unit = _units(batch.column(2), dim)
            for t in range(TABLES):
                near = [axes(unit, t, d, FIRST_AXES if d == 0 else AXES) for d in range(depth)]
                home = np.full(len(unit), t, np.int64)
                for d in range(depth):
                    home = (home << bits) | near[d][:, 0]
                codes, digits = [home], [0]
                for d in range(depth):
                    shift = bits * (depth - 1 - d)
                    for p in range(1, near[d].shape[1]):
                        codes.append(home + ((near[d][:, p] - near[d][:, 0]) << shift))
                        digits.append(d + 1)
                take = pa.array(np.tile(np.arange(len(unit)), len(codes)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take), pa.array(np.concatenate(codes)), pa.array(np.repeat(np.array(digits, np.int32), len(unit)))],
                    names=["vec_id", "grp", "raw", "code", "digit"],
                )

    return run


INDEX, QUERY = 1, 2


def _search(k: int, dim: int):
    """The k nearest index vectors of each query of a bucket, by a fast pass and the exact cosine."""

    def run(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        everything, all_ids = _matrix(table.column("raw"), dim), table.column("vec_id").to_numpy()
        everything /= np.sqrt((everything * everything).sum(axis=1))[:, None]
        order = np.flatnonzero(role & INDEX)
        order = order[np.argsort(all_ids[order], kind="stable")]
        wanted = np.flatnonzero(role & QUERY)
        if not len(order) or not len(wanted):
            return pa.table({"grp": pa.array([], pa.string()), "vec_id": pa.array([], pa.int64()), "near": pa.array([], pa.list_(pa.int64())), "sims": pa.array([], pa.list_(pa.float64()))})
        ids, x, y, qids = all_ids[order], everything[order], everything[wanted], all_ids[wanted]
        keep = k + SPARE
        strips = -(-len(ids) // STRIP)
        x32 = np.zeros((strips * STRIP, x.shape[1]), np.float32)
        x32[: len(ids)] = x
        near, sims = [], []
        step = max(1, 4_000_000 // (strips * STRIP))
        for start in range(0, len(y), step):
            part = y[start : start + step]
            rough = part.astype(np.float32) @ x32.T
            rough[:, len(ids) :] = -9.0
            if strips > keep:
                # each of the best is in one of as many strips with the largest best
                lanes = rough.reshape(len(part), strips, STRIP)
                at = np.argpartition(-lanes.max(axis=2), keep - 1, axis=1)[:, :keep]
                few = np.take_along_axis(lanes, at[:, :, None], axis=1).reshape(len(part), -1)
                places = (at[:, :, None] * STRIP + np.arange(STRIP)).reshape(len(part), -1)
            else:
                few, places = rough, np.broadcast_to(np.arange(strips * STRIP), rough.shape)
            take = min(keep, few.shape[1])
            best = np.take_along_axis(places, np.argpartition(-few, take - 1, axis=1)[:, :take], axis=1)
            best.sort(axis=1)
            real = best < len(ids)
            best = np.minimum(best, len(ids) - 1)
            exact = np.round(np.einsum("qd,qcd->qc", part, x[best]), 12)
            exact[~real | (ids[best] == qids[start : start + step][:, None])] = -9.0
            rank = np.argsort(-exact, axis=1, kind="stable")[:, :k]
            near.append(np.take_along_axis(ids[best], rank, axis=1))
            sims.append(np.take_along_axis(exact, rank, axis=1))
        near, sims = np.concatenate(near), np.concatenate(sims)
        real = sims > -5.0
        offsets = np.concatenate(([0], np.cumsum(real.sum(axis=1)))).astype(np.int32)
        return pa.table({"grp": table.column("grp").take(pa.array(wanted)), "vec_id": pa.array(qids), "near": pa.ListArray.from_arrays(pa.array(offsets), pa.array(near[real])), "sims": pa.ListArray.from_arrays(pa.array(offsets), pa.array(sims[real]))})

    return run


def oversized(vectors: DataFrame, dim: int, bucket: int) -> list[DataFrame]:
    """For each depth the buckets (grp, code, n) above the limit; the last one may be of the last digit."""
    bits, most = _bits(dim)
    found: list[DataFrame] = []
    while len(found) < most:
        sizes = vectors.select("grp", "raw").mapInArrow(_sizes(dim, len(found) + 1), "grp string, code bigint, n bigint")
        if found:
            above = found[-1].select("grp", F.col("code").alias("above"))
            sizes = sizes.withColumn("above", F.shiftright("code", bits)).join(above, ["grp", "above"], "left_semi").drop("above")
        large = materialize(sizes.groupBy("grp", "code").agg(F.sum("n").alias("n")).filter(F.col("n") > bucket), "p3o")
        if large.isEmpty():
            break
        found.append(large)
    return found


def routed(vectors: DataFrame, dim: int, bucket: int) -> DataFrame:
    """(grp, bucket, part, role, vec_id, raw): where each vector is searched, and where it searches."""
    bits, most = _bits(dim)
    large = oversized(vectors, dim, bucket)
    depth = min(most, len(large) + 1)
    rows = vectors.select("vec_id", "grp", "raw").mapInArrow(_route(dim, depth), "vec_id bigint, grp string, raw binary, code bigint, digit int")
    used = F.lit(1)
    for d in range(1, depth):
        rows = rows.withColumn("_at", F.shiftright("code", bits * (depth - d)))
        rows = bounded_join(rows, large[d - 1].select("grp", F.col("code").alias("_at"), F.lit(True).alias(f"_over{d}")), ["grp", "_at"], by=["vec_id", "code"]).drop("_at")
        used = F.when(F.col(f"_over{d}").isNotNull() & (used == d), F.lit(d + 1)).otherwise(used)
    # a further axis of a digit that the bucket does not use leads to the own bucket
    rows = rows.withColumn("_used", used).filter(F.col("digit") <= F.col("_used"))
    rows = rows.withColumn("bucket", F.expr(f"shiftright(code, cast({bits} * ({depth} - _used) as int))") * 16 + F.col("_used"))
    role = F.when(F.col("digit") == 0, INDEX + QUERY).otherwise(QUERY)
    if len(large) < most:
        return rows.select("grp", "bucket", F.lit(0).cast("bigint").alias("part"), role.alias("role"), "vec_id", "raw")
    # buckets that the last digit leaves too large: one task for each pair of an index block and a query block
    blocks = large[-1].select("grp", (F.col("code") * 16 + depth).alias("bucket"), F.ceil(F.col("n") / F.lit(bucket)).alias("_n"))
    rows = bounded_join(rows, materialize(blocks, "p3b"), ["grp", "bucket"], by=["vec_id", "code"]).withColumn("_n", F.coalesce("_n", F.lit(1)))
    mine = F.pmod(F.xxhash64("vec_id"), F.col("_n"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1))
    rows = rows.withColumn("_mine", mine).withColumn("_b", other)
    index = rows.filter("digit = 0").select("grp", "bucket", (F.col("_mine") * F.col("_n") + F.col("_b")).alias("part"), F.when(F.col("_mine") == F.col("_b"), INDEX + QUERY).otherwise(INDEX).alias("role"), "vec_id", "raw")
    query = rows.filter("digit > 0 OR _mine <> _b").select("grp", "bucket", (F.col("_b") * F.col("_n") + F.col("_mine")).alias("part"), F.lit(QUERY).alias("role"), "vec_id", "raw")
    return index.unionByName(query)


def nearest(df: DataFrame, id_col: str, group_col: str, vec_col: str, k: int = 5, dim: int = 64, bucket: int = BUCKET) -> DataFrame:
    """(grp, vec_id, neighbour, cosine, rank): up to k most similar other vectors of the same group.

    Ties go to the smaller id; equal vectors (also after scaling) are searched once and expanded at the
    end. Null, wrongly sized, zero and non-finite vectors and rows without id or group take no part. An
    empty table gives an empty result; other columns are ignored; ids are taken as unique.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(group_col).cast("string").alias("grp"), F.col(vec_col).alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("grp").isNotNull() & F.col("vec").isNotNull())
    encoded = materialize(spread(rows).mapInArrow(_encode(dim), "vec_id bigint, grp string, raw binary, same binary"), "p3e")
    members = encoded.select("vec_id", "grp", "same")
    repeated = materialize(members.groupBy("grp", "same").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "p3c")
    doubles = members.join(repeated, ["grp", "same"])
    first = doubles.withColumn("at", F.row_number().over(Window.partitionBy("grp", "same").orderBy("vec_id"))).filter(F.col("at") <= k + 1)
    first = materialize(first.groupBy("rep").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "p3d")
    others = materialize(doubles.filter("vec_id <> rep").select("vec_id", "rep", "n"), "p3m")
    single = encoded.join(others.select("vec_id"), "vec_id", "left_anti").select("vec_id", "grp", "raw")
    lists = routed(single, dim, bucket).groupBy("grp", "bucket", "part").applyInArrow(_search(k, dim), "grp string, vec_id bigint, near array<bigint>, sims array<double>")
    merged = lists.select("grp", "vec_id", F.arrays_zip((F.transform("sims", lambda s: -s)).alias("d"), F.col("near").alias("id")).alias("found")).groupBy("grp", "vec_id").agg(F.collect_list("found").alias("found"))
    best = F.slice(F.array_sort(F.array_distinct(F.flatten("found"))), 1, k)
    near = merged.select("grp", F.col("vec_id").alias("rep"), F.explode_outer(best).alias("hit")).select("grp", "rep", F.col("hit.id").alias("near"), (-F.col("hit.d")).alias("cosine"))
    # classes of equal vectors: each neighbour stands for its first k + 1 members, and members for each other
    spelled = near.filter("near IS NOT NULL").join(first.withColumnsRenamed({"rep": "near"}), "near", "left").select("grp", "rep", F.explode(F.coalesce("ids", F.array("near"))).alias("near"), "cosine")
    inner = first.join(repeated.select("grp", "rep"), "rep").select("grp", "rep", F.explode("ids").alias("near"), F.lit(1.0).alias("cosine"))
    top = Window.partitionBy("grp", "rep").orderBy(F.desc("cosine"), "near")
    own = materialize(spelled.unionByName(inner).withColumn("at", F.row_number().over(top)).filter(F.col("at") <= k + 1).select("grp", "rep", "near", "cosine"), "p3n")
    copied = pair_join(others, own, ["rep"], repeated.select("rep", "n"), "n", by=["vec_id"]).select("grp", "vec_id", "near", "cosine")
    whole = own.select("grp", F.col("rep").alias("vec_id"), "near", "cosine").unionByName(copied).filter("vec_id <> near")
    rank = F.row_number().over(Window.partitionBy("grp", "vec_id").orderBy(F.desc("cosine"), "near"))
    return whole.withColumn("rank", rank).filter(F.col("rank") <= k).select("grp", "vec_id", F.col("near").alias("neighbour"), "cosine", "rank")


def neighbour_pairs(df: DataFrame, id_col: str, group_col: str, vec_col: str, k: int = 5, dim: int = 64) -> DataFrame:
    """(vec_id_a, vec_id_b), a < b: at least one is among the k nearest of the other; see nearest()."""
    near = nearest(df, id_col, group_col, vec_col, k, dim)
    return near.select(F.least("vec_id", "neighbour").alias("vec_id_a"), F.greatest("vec_id", "neighbour").alias("vec_id_b")).distinct()
