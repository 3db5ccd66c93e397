"""Exact, greedy and near-duplicate removal and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from trisieve.operators.select import best_per_key
from trisieve.runtime import BROADCAST_ROWS, ROWS_PER_SALT, bounded_join, materialize, small, spread

#: Lengths of the character n-grams of the near-duplicate search.
LOW, HIGH = 3, 5

#: Words of texts that are cut into n-grams at once, and texts or pairs of one task.
PIECE_WORDS, SLICE_TEXTS = 100_000, 10_000

#: Parts of the n-grams in a sketch; rows and squared rows of the n-grams that share a task.
SKETCH, BUCKET_ROWS, BUCKET_PAIRS = 64, 50_000, 5_000_000

#: The lower half of a 64-bit number.
HALF = (1 << 32) - 1


def by_digest(df: DataFrame, digest: Column, order_by: list[Column]) -> DataFrame:
    """The first row of each digest in the given order."""
    return best_per_key(df.withColumn("_digest", digest), ["_digest"], order_by).drop("_digest")


def unseen(df: DataFrame, key: Column, known: DataFrame, known_key: Column, order_by: list[Column]) -> DataFrame:
    """Rows whose key is neither known nor that of an earlier row."""
    keyed = df.withColumn("_key", key).join(known.select(known_key.alias("_key")).distinct(), "_key", "left_anti")
    return best_per_key(keyed, ["_key"], order_by).drop("_key")


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def greedy_keep(df: DataFrame, id_col: str, keys: dict[str, Column], order_by: list[str]) -> DataFrame:
    """Adds `keep`: a row is kept if no kept row before it shares any of its keys.

    This is the sequential scan's result, found in rounds: a row that is the first of the undecided
    ones for each of its keys is kept, and rows that share a key with it are dropped. The order must be
    unique. Each round's aggregation is combined before the shuffle, so hot keys do no harm.
    """
    order = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([*order_by, id_col])])
    left = materialize(df.select(F.col(id_col).alias("_id"), order.alias("_ord"), F.array(*[F.struct(F.lit(n).alias("kind"), k.cast("string").alias("key")) for n, k in keys.items()]).alias("_keys")), "greedy")
    kept: list[DataFrame] = []
    while not left.isEmpty():
        flat = left.select("_id", "_ord", F.explode("_keys").alias("k")).select("_id", "_ord", "k.kind", "k.key")
        first = materialize(flat.groupBy("kind", "key").agg(F.min("_ord").alias("_first")), "first")
        leads = bounded_join(flat, first, ["kind", "key"], by=["_id"]).groupBy("_id").agg(F.bool_and(F.col("_ord") == F.col("_first")).alias("lead"))
        now = materialize(leads.filter("lead").select("_id"), "now")
        kept.append(now)
        taken = materialize(flat.join(now, "_id", "left_semi").select("kind", "key").distinct().withColumn("_taken", F.lit(True)), "taken")
        gone = bounded_join(flat, taken, ["kind", "key"], by=["_id"], how="inner").select("_id").distinct()
        left = materialize(left.join(gone, "_id", "left_anti"), "greedy")
    if not kept:
        return df.withColumn("keep", F.lit(True))
    every = reduce(DataFrame.unionByName, kept).select(F.col("_id").alias(id_col), F.lit(True).alias("keep"))
    return df.join(every, id_col, "left").withColumn("keep", F.coalesce("keep", F.lit(False)))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the edges; nodes without an edge are absent.

    Alternating large-star and small-star steps until each node is the smallest of its neighbours or has one
    neighbour, the smallest; the number of rounds grows as the logarithm of the size. Only hot nodes are sliced.
    """
    now = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "edges")

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
        slices = F.ceil(F.col("n") / ROWS_PER_SALT).cast("int")
        hot = materialize(least.filter(F.col("n") > ROWS_PER_SALT).select("u", slices.alias("slices")), "hot")
        hot = F.broadcast(hot) if small(hot) else hot
        sliced = both.join(hot, "u", "left").withColumn("slice", F.pmod(F.xxhash64("v"), F.coalesce("slices", F.lit(1))).cast("int"))
        # "merge": Spark goes by compressed bytes and would broadcast what is far larger in memory
        right = least.select("u", "m", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice")).hint("merge")
        joined = sliced.join(right, ["u", "slice"])
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return materialize(out.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star")

    def done(pairs: DataFrame) -> bool:
        ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(pairs.select("v", F.lit(0), F.lit(1)).toDF("node", "up", "down"))
        return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1").isEmpty()

    while not done(now):
        now = star(star(now, True), False)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _pieces(batch: pa.RecordBatch | pa.Table, *texts: str) -> Iterator[tuple]:
    """Slices of a batch with about PIECE_WORDS words each, and the words of each of its text columns."""
    words = [pc.split_pattern(batch.column(t), " ") for t in texts]
    words = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in words]
    if not len(batch):
        return
    at = np.cumsum(sum(pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in words)) // PIECE_WORDS
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    for i, j in zip(starts, [*starts[1:], len(batch)], strict=True):
        yield batch.slice(i, j - i), *(x.slice(i, j - i) for x in words)


def _counts(words: pa.ListArray, at: dict[str, int], cut: dict[str, np.ndarray], new: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, n-gram, how often) of lists of words, in this order; n-grams are numbered by `at`, unknown ones are left out or numbered."""
    coded = words.flatten().dictionary_encode()
    for w in coded.dictionary.to_pylist():
        if w not in cut:
            padded = f" {w} "
            grams = [padded[k : k + n] for n in range(LOW, HIGH + 1) for k in range(len(padded) - n + 1)]
            cut[w] = np.array([at.setdefault(g, len(at)) for g in grams] if new else [at[g] for g in grams if g in at], dtype=np.int64)
    known = [cut[w] for w in coded.dictionary.to_pylist()]
    sizes, flat = np.array([len(x) for x in known], dtype=np.int64), np.concatenate([np.zeros(0, np.int64), *known])
    word = coded.indices.to_numpy()
    n = sizes[word]
    rows = np.repeat(np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False)), n)
    grams = flat[np.repeat((np.cumsum(sizes) - sizes)[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    keys, tf = np.unique(rows * max(len(at), 1) + grams, return_counts=True)
    return keys // max(len(at), 1), keys % max(len(at), 1), tf


def _gram_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each n-gram of a group, summed over a slice of texts: rows, occurrences, and a mark of its counts by text in two halves."""
    at: dict[str, int] = {}
    cut: dict[str, np.ndarray] = {}
    for batch in batches:
        for piece, words in _pieces(batch, "text"):
            if len(at) > 1_000_000:
                at, cut = {}, {}
            row, gram, tf = _counts(words, at, cut, True)
            if not len(row):
                continue
            group = piece.column("group").dictionary_encode()
            key = group.indices.to_numpy()[row].astype(np.int64) * len(at) + gram
            order = np.argsort(key, kind="stable")
            row, tf = row[order], tf[order]
            key, first = np.unique(key[order], return_index=True)
            copies = piece.column("copies").to_numpy()[row]
            mark = np.add.reduceat(piece.column("mark").to_numpy().view(np.uint64)[row] * tf.astype(np.uint64), first)
            names = pa.array(list(at), pa.string())
            yield pa.RecordBatch.from_arrays(
                [group.dictionary.take(pa.array(key // len(at))), names.take(pa.array(key % len(at))), pa.array(np.add.reduceat(copies, first)), pa.array(np.add.reduceat(copies * tf, first)), pa.array((mark & np.uint64(HALF)).astype(np.int64)), pa.array((mark >> np.uint64(32)).astype(np.int64))],
                names=["group", "gram", "df", "all", "low", "high"],
            )


def gram_classes(texts: DataFrame, totals: DataFrame, min_df: int, max_features: int) -> DataFrame:
    """(group, gram, df, w) of (group, id, copies, text): the n-grams that count, with their idf.

    N-grams that every text of the group holds equally often add the same product to a cosine, so the
    first stands for all of them, with the square root of their number in its weight. They are told by the sum
    of a 64-bit mark of the texts, each times its count, modulo 2^64.
    """
    parts = spread(texts.select("group", "copies", "text", F.xxhash64("id").alias("mark"))).mapInArrow(_gram_table, "`group` string, gram string, df bigint, all bigint, low bigint, high bigint")
    table = parts.groupBy("group", "gram").agg(*[F.sum(c).alias(c) for c in ("df", "all", "low", "high")]).filter(F.col("df") >= min_df)
    table = table.withColumn("_at", F.row_number().over(Window.partitionBy("group").orderBy(F.desc("all"), "gram"))).filter(F.col("_at") <= max_features)
    low, high = F.col("low").bitwiseAND(F.lit(HALF)), (F.col("high") + F.shiftright("low", 32)).bitwiseAND(F.lit(HALF))
    same = table.groupBy("group", "df", "all", low.alias("low"), high.alias("high")).agg(F.min("gram").alias("gram"), F.count(F.lit(1)).alias("like"))
    idf = F.log((1 + F.col("total")) / (1 + F.col("df"))) + 1
    return same.join(totals, "group").select("group", "gram", "df", (idf * F.sqrt("like")).alias("w"))


class _Weights:
    """Unit vectors of texts over a table of n-grams, which are numbered from the most frequent on."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("df", "descending"), ("gram", "ascending")])
        self.w = table.column("w").to_numpy()
        self.at, self.cut = {g: i for i, g in enumerate(table.column("gram").to_pylist())}, {}

    def of(self, words: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, gram, tf = _counts(words, self.at, self.cut, False)
        w = tf * self.w[gram]
        return row, gram, w / np.sqrt(np.bincount(row, w * w, len(words)))[row]


def _packed(values: np.ndarray) -> pa.Array:
    """Rows of numbers from 0 to 1 in a byte each, rounded up, behind a byte for the scale of the row."""
    scale = np.clip(np.ceil(values.max(axis=1, initial=0, keepdims=True) * 255), 1, 255)
    codes = np.concatenate([scale, np.minimum(np.ceil(values * 65025 / scale), 255)], axis=1).astype(np.uint8)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(codes.shape[1]), len(codes), [None, pa.py_buffer(codes.tobytes())]).cast(pa.binary())


def _unpacked(codes: list[bytes]) -> np.ndarray:
    codes = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1).astype(np.float32)
    return codes[:, 1:] * (codes[:, :1] / np.float32(65025))


def _rare(least: float, schema: pa.Schema):
    """Of each text the n-grams (by their numbers in the table) from the rarest on until the others keep less than `least`, each with a sketch of the text."""

    def run(texts: pa.Table, table: pa.Table) -> pa.Table:
        found, weights = [], _Weights(table)
        for piece, words in _pieces(texts, "text"):
            row, gram, w = weights.of(words)
            total = np.cumsum(w * w)
            before = np.concatenate([[0.0], total])[np.searchsorted(row, np.arange(len(piece)))]
            upto = np.sqrt(total - before[row])
            bucket = (gram * 2654435761 >> 7) % SKETCH
            sketch = _packed(np.sqrt(np.bincount(row * SKETCH + bucket, w * w, len(piece) * SKETCH)).reshape(-1, SKETCH))
            kept = upto >= least
            take = pa.array(row[kept])
            found.append(pa.table([piece.column("group").take(take), pa.array(gram[kept]), piece.column("id").take(take), pa.array(upto[kept]), sketch.take(take)], schema=schema))
        return pa.concat_tables(found) if found else schema.empty_table()

    return run


def _close(least: float):
    """Pairs of a bucket's n-grams of which neither the product of lengths nor the sketches exclude the cosine `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).sort_by([("gram", "ascending"), ("id", "ascending")])
        gram, ids, group = (rows.column(x).combine_chunks() for x in ("gram", "id", "group"))
        upto, own = rows.column("upto").to_numpy(), rows.column("own").to_numpy()
        across = bool(rows.column("low")[0].as_py() != rows.column("high")[0].as_py())
        sketch = _unpacked(rows.column("sketch").to_pylist())
        starts = np.flatnonzero(np.concatenate([[True], pc.not_equal(gram[1:], gram[:-1]).to_numpy(zero_copy_only=False)]))
        for start, end in zip(starts, [*starts[1:], len(rows)], strict=True):
            for i in range(start, end, 1000):
                here = slice(i, min(i + 1000, end))
                near = (sketch[here] @ sketch[i:end].T >= least - 1e-4) & (np.multiply.outer(upto[here], upto[i:end]) >= least)
                if across:
                    near &= np.not_equal.outer(own[here], own[i:end])
                a, b = np.nonzero(np.triu(near, 1))
                if len(a):
                    yield pa.RecordBatch.from_arrays([group.take(pa.array(a + i)), ids.take(pa.array(a + i)), ids.take(pa.array(b + i))], names=["group", "a", "b"])

    return run


def _texts(df: DataFrame, id_col: str, text_col: str, group_col: str | None) -> DataFrame:
    """(group, id, text): null ids and texts take no part; a null group is a group of its own."""
    group = F.lit("") if group_col is None else F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    return df.select(group.alias("group"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")


def equal_texts(df: DataFrame, id_col: str, text_col: str, group_col: str | None = None) -> DataFrame:
    """(group, id, text, rep): each text with the smallest id of the same text in its group.

    The text meets its representative by a digest, so a text that a third of all rows hold is aggregated before
    it is shuffled.
    """
    rows = materialize(_texts(df, id_col, text_col, group_col).withColumn("same", F.unhex(F.sha2("text", 256))), "texts")
    reps = materialize(rows.groupBy("group", "same").agg(F.min("id").alias("rep")), "reps")
    return bounded_join(rows, reps, ["group", "same"], by=["id"], how="inner").select("group", "id", "text", "rep")


def _cosines(threshold: float, schema: pa.Schema):
    def run(pairs: pa.Table, table: pa.Table) -> pa.Table:
        found, weights = [], _Weights(table)
        for piece, left, right in _pieces(pairs, "text_a", "text_b"):
            (ra, ga, wa), (rb, gb, wb) = weights.of(left), weights.of(right)
            _, i, j = np.intersect1d(ra * len(table) + ga, rb * len(table) + gb, assume_unique=True, return_indices=True)
            sums = np.bincount(ra[i], wa[i] * wb[j], len(piece))
            take = pa.array(np.flatnonzero(sums >= threshold))
            found.append(pa.table([*(piece.column(x).take(take) for x in ("group", "a", "b")), pa.array(sums).take(take)], schema=schema))
        return pa.concat_tables(found) if found else schema.empty_table()

    return run


def _sliced(df: DataFrame, table: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows and n-gram tables of their groups by group and slice of SLICE_TEXTS rows; each slice gets the table."""
    sizes = materialize(df.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / SLICE_TEXTS).cast("int").alias("slices")), "sizes")
    rows = bounded_join(df, sizes, ["group"], by=by, how="inner").withColumn("slice", F.pmod(F.xxhash64(*by), "slices").cast("int")).drop("slices")
    tables = bounded_join(table, sizes, ["group"], by=["gram"], how="inner").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    return rows, tables


def _candidates(reps: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """(group, a, b), a < b: the pairs of texts, by their numbers, whose cosine may reach `least`."""
    schema = pa.schema([("group", pa.string()), ("gram", pa.int64()), ("id", pa.int64()), ("upto", pa.float64()), ("sketch", pa.binary())])
    rows, tables = _sliced(reps.select("group", F.col("n").alias("id"), "text"), table, ["id"])
    on = ["group", "slice"]
    prefix = materialize(rows.groupBy(*on).cogroup(tables.groupBy(*on)).applyInArrow(_rare(least, schema), "`group` string, gram bigint, id bigint, upto double, sketch binary"), "prefix")
    counts = materialize(prefix.groupBy("group", "gram").agg(F.count(F.lit(1)).alias("rows")), "counts")
    loads = materialize(counts.groupBy("group").agg(F.ceil(F.greatest(F.sum("rows") / BUCKET_ROWS, F.sum(F.col("rows").cast("double") * F.col("rows")) / BUCKET_PAIRS)).cast("int").alias("buckets")), "loads")
    # only the groups and the hot n-grams are joined: a table of all n-grams would be repeated, and the sketches shuffled twice
    hot = materialize(counts.filter(F.col("rows") > ROWS_PER_SALT).select("group", "gram", F.ceil(F.col("rows") / ROWS_PER_SALT).cast("int").alias("slices")), "hot")
    rows = bounded_join(bounded_join(prefix, loads, ["group"], by=["id"], how="inner"), hot, ["group", "gram"], by=["id"]).withColumn("slices", F.coalesce("slices", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), "slices").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    # a hot n-gram has its own buckets, one for each two of its slices
    rows = rows.select("group", "gram", "id", "upto", "sketch", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), F.pmod(F.xxhash64("gram"), "buckets").cast("int").alias("bucket"), F.when(F.col("slices") > 1, F.col("gram")).otherwise(-1).alias("hot"))
    return rows.groupBy("group", "bucket", "hot", "low", "high").applyInArrow(_close(least), "`group` string, a bigint, b bigint").distinct()


def _similar(texts: DataFrame, threshold: float, min_df: int, max_features: int) -> DataFrame:
    """(group, a, b, similarity) of the different texts (group, id, copies, text), see similar_texts."""
    words = F.array_join(F.filter(F.split(F.lower("text"), r"(?U)\s+"), lambda w: w != ""), " ")
    reps = materialize(texts.select("group", "id", "copies", words.alias("text"), F.monotonically_increasing_id().alias("n")), "reps")
    totals = materialize(reps.groupBy("group").agg(F.sum("copies").alias("total")), "totals")
    table = materialize(gram_classes(reps, totals, min_df, max_features), "idf")
    ids, kind = to_arrow_type(reps.schema["id"].dataType), reps.schema["id"].dataType.simpleString()
    pairs = materialize(_candidates(reps, table, threshold - 1e-9), "pairs")
    need = materialize(pairs.select(F.explode(F.array("a", "b")).alias("n")).distinct(), "need")
    # rows of one number: ten times as many as of others may be broadcast, so that the texts stay where they are
    need = F.broadcast(need) if small(need, 10 * BROADCAST_ROWS) else need
    used = materialize(reps.join(need, "n", "left_semi").select("n", "id", "text"), "used")
    half = lambda x: used.select(F.col("n").alias(x), F.col("id").alias(f"id_{x}"), F.col("text").alias(f"text_{x}"))
    whole = pairs.join(half("a"), "a").join(half("b"), "b").select("group", F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), "text_a", "text_b")
    rows, tables = _sliced(whole, table, ["a", "b"])
    schema = pa.schema([("group", pa.string()), ("a", ids), ("b", ids), ("similarity", pa.float64())])
    on = ["group", "slice"]
    return rows.groupBy(*on).cogroup(tables.groupBy(*on)).applyInArrow(_cosines(threshold, schema), f"`group` string, a {kind}, b {kind}, similarity double")


def similar_texts(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.95, group_col: str | None = None, min_df: int = 2, max_features: int = 100_000, neighbours: int | None = None) -> DataFrame:
    """(group, a, b, similarity), a < b: different texts of a group with a TF-IDF cosine of at least the threshold.

    a and b are the smallest ids of their texts; copies of a text are not spelled out, but
    count in the weights. Character n-grams, smooth idf, unit length; of the n-grams in `min_df` texts of the
    group the most frequent `max_features`. That cap and `neighbours` (only each text's k nearest, ties to the
    smaller id) belong to the result, as the reference has them; without `neighbours` no link is lost.

    The join takes the n-grams of a text from the rarest on. Of the rarest n-gram that a pair shares, neither
    text shares any rarer one, so by the Cauchy-Schwarz inequality the cosine is at most the product of the
    lengths that both keep from there on; over any split of the n-grams it is at most the sum of the products of
    the lengths in each part (the sketch). A pair is a candidate if for one shared n-gram both reach the threshold,
    so none is lost. The exact cosine decides, from vectors that are made again of the candidates' texts:
    no table holds an n-gram of each text.
    """
    # the texts are aggregated, not joined with their representatives: nothing here needs the copies' ids
    texts = _texts(df, id_col, text_col, group_col).groupBy("group", "text").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    return _links(texts, threshold, min_df, max_features, neighbours)


def _links(texts: DataFrame, threshold: float, min_df: int, max_features: int, neighbours: int | None) -> DataFrame:
    found = _similar(texts, threshold, min_df, max_features)
    if neighbours is None:
        return found
    found = materialize(found, "links")
    both = found.unionByName(found.select("group", F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    near = both.withColumn("_at", F.row_number().over(Window.partitionBy("group", "a").orderBy(F.desc("similarity"), "b"))).filter(F.col("_at") <= neighbours)
    return near.select("group", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity").dropDuplicates(["group", "a", "b"])


def near_duplicates(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.95, group_col: str | None = None, neighbours: int | None = None) -> DataFrame:
    """Adds `component` (smallest id of the near-duplicate group, the own id without one) and `keep`.

    Equal texts of a group are one near-duplicate group; rows without a text are none.
    """
    texts = materialize(equal_texts(df, id_col, text_col, group_col), "equal")
    different = texts.groupBy("group", "rep").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text")).withColumnRenamed("rep", "id")
    links = _links(different, threshold, 2, 100_000, neighbours).select("a", "b")
    groups = materialize(components(links).select(F.col("node").alias("rep"), F.col("component").alias("_component")), "groups")
    members = texts.select(F.col("id").alias(id_col), "rep")
    found = bounded_join(members, groups, ["rep"], by=[id_col]).select(id_col, F.coalesce("_component", "rep").alias("component"))
    return df.join(found, id_col, "left").withColumn("component", F.coalesce("component", F.col(id_col))).withColumn("keep", F.col("component") == F.col(id_col))
