"""Exact and inverted-list nearest neighbours of a stated query set, in blocks of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trisieve.runtime import materialize

#: Vectors in a block; a task holds one block of queries and one of the corpus.
BLOCK = 4096
#: Queries on which the number of probes is measured, and the share of their true neighbours it must find.
#: The target is above the 0.9 that is asked for, as the other queries may differ.
SAMPLE = 100
TARGET = 0.95


def usable(df: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """(id, vec) of vectors with `dim` finite numbers, not all zero."""
    v = F.col(vec_col)
    fine = (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.filter(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("bigint").alias("id"), v.cast("array<float>").alias("vec"))


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = np.asarray(flat, dtype=np.float64).reshape(len(table), -1)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _search(k: int):
    def run(table: pa.Table) -> pa.Table:
        mark = table.column("is_query")
        query, corpus = table.filter(mark), table.filter(pa.compute.invert(mark)).sort_by("id")
        if not len(query) or not len(corpus):
            return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids, scores = corpus.column("id").to_numpy(), _matrix(query) @ _matrix(corpus).T
        scores = np.round(scores, 10)
        take = min(k, len(ids))
        # at a tie the smaller id comes first: the columns are in id order and the sort is stable
        best = np.argsort(-scores, axis=1, kind="stable")[:, :take]
        return pa.table({"query_id": np.repeat(query.column("id").to_numpy(), take), "id": ids[best].ravel(), "score": np.take_along_axis(scores, best, axis=1).ravel()})

    return run


def _blocks(queries: DataFrame, corpus: DataFrame, on: list[str], k: int, q_blocks: int, c_blocks: int) -> DataFrame:
    pick = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.withColumn("_q", pick(q_blocks)).withColumn("_c", every(c_blocks)).withColumn("is_query", F.lit(True))
    c = corpus.withColumn("_c", pick(c_blocks)).withColumn("_q", every(q_blocks)).withColumn("is_query", F.lit(False))
    found = q.unionByName(c).groupBy(*on, "_q", "_c").applyInArrow(_search(k), "query_id bigint, id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def exact_top_k(queries: DataFrame, corpus: DataFrame, k: int = 16, block: int = BLOCK) -> DataFrame:
    """(query_id, id, score, rank): the k most similar corpus vectors of each query by cosine, itself included.

    Both sides are (id, vec) as usable() gives them. The work is cut into pairs of a query block and a
    corpus block, so neither side has to fit one task.
    """
    q_blocks, c_blocks = (max(1, -(-x.count() // block)) for x in (queries, corpus))
    return _blocks(queries, corpus, [], k, q_blocks, c_blocks)


def centroids(corpus: DataFrame, lists: int, train_rows: int = 20_000, steps: int = 10) -> np.ndarray:
    """Spherical k-means on a bounded sample of the corpus (the `train_rows` smallest id hashes)."""
    sample = corpus.orderBy(F.xxhash64("id"), "id").limit(train_rows).select("vec").toPandas()
    x = np.array(sample["vec"].to_list(), dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    c = x[np.random.default_rng(3).choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(steps):
        home = (x @ c.T).argmax(axis=1)
        for i in range(len(c)):
            if (mine := x[home == i]).size:
                c[i] = mine.mean(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1), 1e-12)[:, None]
    return c


def _assign(c: np.ndarray, probes: int):
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lists = np.argsort(-(_matrix(table) @ c.T), axis=1, kind="stable")[:, :probes].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(np.arange(0, lists.size + 1, lists.shape[1], dtype=np.int32)), pa.array(lists.ravel()))], names=[*batch.schema.names, "lists"])

    return run


def enough_probes(queries: DataFrame, corpus: DataFrame, homes: DataFrame, c: np.ndarray, k: int, block: int) -> int:
    """The fewest probes with which SAMPLE queries (the smallest id hashes) find TARGET of their exact neighbours."""
    sample = materialize(queries.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(SAMPLE), "probe")
    rows = sample.toPandas()
    if not len(rows):
        return 1
    x = np.array(rows["vec"].to_list(), dtype=np.float64)
    near = np.argsort(-((x / np.linalg.norm(x, axis=1)[:, None]) @ c.T), axis=1, kind="stable")
    at = dict(zip(rows["id"], near.argsort(axis=1), strict=True))
    true = exact_top_k(sample, corpus, k, block).join(homes.select("id", "list"), "id").select("query_id", "list").collect()
    needed = np.sort([at[r.query_id][r.list] for r in true])  # at most SAMPLE x k numbers
    return int(needed[int(np.ceil(TARGET * len(needed))) - 1]) + 1 if len(needed) else 1


def ivf_top_k(queries: DataFrame, corpus: DataFrame, k: int = 16, lists: int | None = None, probes: int | None = None, block: int = BLOCK) -> DataFrame:
    """As exact_top_k, but a query meets only the `probes` inverted lists nearest to it.

    By default there are min(1024, n / 100) lists and as many probes as enough_probes() measures,
    but at least 16. Lists above the block size are worked off in blocks.
    """
    n = corpus.count()
    lists = lists or min(1024, max(1, n // 100))
    c = centroids(corpus, lists)
    schema = "id bigint, vec array<float>, lists array<int>"
    homes = materialize(corpus.select("id", "vec").mapInArrow(_assign(c, 1), schema).select("id", "vec", F.col("lists")[0].alias("list")), "ivf")
    largest = homes.groupBy("list").count().agg(F.max("count")).first()[0] or 1
    probes = probes or max(16, enough_probes(queries, corpus, homes, c, k, block))
    wanted = queries.select("id", "vec").mapInArrow(_assign(c, min(probes, len(c))), schema).select("id", "vec", F.explode("lists").alias("list"))
    return _blocks(wanted, homes, ["list"], k, max(1, -(-queries.count() // block)), max(1, -(-largest // block)))


def hard_negatives(neighbours: DataFrame, texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """(query_id, negative_id, score): the first neighbour with another id, a text, and not the own positive.

    `texts` is (id, text) of the corpus, `anchors` (query_id, positive). Queries without one give no row.
    """
    joined = neighbours.join(texts, "id").join(anchors, "query_id")
    good = joined.filter((F.col("id") != F.col("query_id")) & (F.trim("text") != "") & (F.col("text") != F.col("positive")))
    best = good.groupBy("query_id").agg(F.min_by(F.struct("id", "score"), "rank").alias("x"))
    return best.select("query_id", F.col("x.id").alias("negative_id"), F.col("x.score").alias("score"))


def ranks(queries: DataFrame, corpus: DataFrame, positives: DataFrame, block: int = BLOCK, own: bool = True) -> DataFrame:
    """(query_id, rank): one plus the number of corpus vectors that score higher than the positive.

    `positives` is (query_id, id), one for each query; ties do not count against it. Without `own`, the
    query's own id in the corpus does not count either.
    """
    q_blocks, c_blocks = (max(1, -(-x.count() // block)) for x in (queries, corpus))
    target = positives.join(corpus.withColumnRenamed("vec", "_target"), "id").select(F.col("query_id").alias("id"), "_target")
    asked = queries.join(target, "id")

    def count(table: pa.Table) -> pa.Table:
        mark = table.column("is_query")
        query, rest = table.filter(mark), table.filter(pa.compute.invert(mark))
        if not len(query) or not len(rest):
            return pa.table({"query_id": pa.array([], pa.int64()), "above": pa.array([], pa.int64())})
        q, c = _matrix(query), _matrix(rest)
        t = _matrix(query.drop_columns(["vec"]).rename_columns([("vec" if x == "_target" else x) for x in query.drop_columns(["vec"]).column_names]))
        scores, least = np.round(q @ c.T, 10), np.round((q * t).sum(axis=1), 10)
        above = scores > least[:, None]
        if not own:
            above &= query.column("id").to_numpy()[:, None] != rest.column("id").to_numpy()[None, :]
        return pa.table({"query_id": query.column("id").to_numpy(), "above": above.sum(axis=1)})

    pick = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = asked.withColumn("_q", pick(q_blocks)).withColumn("_c", every(c_blocks)).withColumn("is_query", F.lit(True))
    c = corpus.withColumn("_target", F.lit(None).cast("array<float>")).withColumn("_c", pick(c_blocks)).withColumn("_q", every(q_blocks)).withColumn("is_query", F.lit(False))
    return q.unionByName(c).groupBy("_q", "_c").applyInArrow(count, "query_id bigint, above bigint").groupBy("query_id").agg((F.sum("above") + 1).alias("rank"))
