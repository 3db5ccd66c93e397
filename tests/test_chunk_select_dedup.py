import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trisieve.operators import chunk, dedup, evaluate, lexical, select, upsert, vectors
from trisieve.plans import catalog
from trisieve.runtime import bounded_join, materialize


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")


def test_windows(spark):
    df = texts(spark, ["", "x" * 384, "abc", None, "ab" * 700])
    fixed = {r.id: r.x for r in df.select("id", chunk.fixed_windows(F.col("text")).alias("x")).collect()}
    assert fixed[0] == [] and [len(x) for x in fixed[1]] == [384, 48] and fixed[2] == ["abc"] and fixed[3] in (None, [])
    whole = fixed[4]
    assert whole[0] + "".join(x[48:] for x in whole[1:]) == "ab" * 700
    stride = {r.id: r.x for r in df.select("id", chunk.stride_windows(F.col("text"), 1200, 150).alias("x")).collect()}
    assert [(x.start, len(x.text)) for x in stride[4]] == [(0, 1200), (1050, 350)] and len(stride[1]) == 1 and stride[0] == []
    spans = df.filter("id = 4").select(chunk.answer_windows(F.col("text"), F.array(F.lit(0), F.lit(10), F.lit(1390)), F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("x")).first().x
    assert [(x.start, len(x.text)) for x in spans] == [(0, 1200), (200, 1200)]


def test_python_chunkers(spark):
    rng = random.Random(1)
    values = ["".join(rng.choices(["chữ ", "dài. ", "x" * 90 + " ", "\n", "; "], k=rng.randint(0, 200))) for _ in range(30)] + ["y" * 1000, "   ", ""]
    df = texts(spark, values)
    for r in df.select("text", chunk.lossless_pieces(100)(F.col("text")).alias("x")).collect():
        assert "".join(r.x) == r.text and all(len(p) <= 100 for p in r.x)
        assert all(len(p) >= 50 for p in r.x[:-1])
    for r in df.select("text", chunk.word_chunks(100, 20, 1)(F.col("text")).alias("x")).collect():
        assert all(len(p) <= 100 or " " not in p for p in r.x)
        assert set(" ".join(r.x).split()) == set(r.text.split())
    for r in df.select("text", chunk.boundary_chunks(100, 50, 10)(F.col("text")).alias("x")).collect():
        assert all(len(p.text) <= 100 for p in r.x) and (not r.text.strip() or r.x[0].start == 0)
        assert all(b.start > a.start for a, b in zip(r.x, r.x[1:]))
    short = texts(spark, ["một hai " * 3]).select(chunk.word_chunks()(F.col("text")).alias("x")).first().x
    assert short == []


def test_stitching_gives_the_document_back(spark):
    body = " ".join(f"từ{i}" for i in range(400))
    windows = [body[i : i + 384] for i in range(0, len(body), 336)]
    rows = [(f"{i:03}", "s", "T", w) for i, w in enumerate(windows)] + [("500", "s", " ", "x"), ("501", "s", " ", "y"), ("502", "s", "T", None)]
    df = spark.createDataFrame(rows, "data_id string, source string, title string, positive string")
    got = chunk.stitch(chunk.islands(df, ["title"], ["data_id"], ["source"], blank_key="title"), ["source", "island"], ["data_id"], "positive").orderBy("island").collect()
    assert [r.document for r in got] == [body, "x", "y", ""] and got[0].chunks == len(windows)


def test_row_index_and_samples(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("key")).repartition(7)
    got = select.row_index(df, ["key"]).collect()
    assert [r.key for r in sorted(got, key=lambda r: r.row_index)] == sorted(r.key for r in got) and {r.row_index for r in got} == set(range(1000))
    assert 200 < select.hash_sample(df, "key", 0.25).count() < 300
    assert select.adaptive_sample(df, "key", 100).count() == 100
    with pytest.raises(ValueError):
        select.adaptive_sample(df, "key", 100, least=200)
    for n, k, want in [(0, 3, []), (1, 5, [0]), (10, 1, [5]), (10, 4, [0, 3, 6, 9]), (5, 3, [0, 2, 4]), (6, 3, [0, 2, 5])]:
        assert spark.range(1).select(select.even_indices(F.lit(n), k).alias("x")).first().x == want
    assert select.quotas(7, 3) == [3, 2, 2]


def test_two_tiers_and_quotas(spark):
    df = spark.createDataFrame([(i, "a" if i < 3 else "b") for i in range(20)], "id int, source string")
    got = select.two_tier(df, "source", "a", "b", [F.col("id")], 5).collect()
    assert sorted(r.id for r in got) == [0, 1, 2, 3, 4]
    assert select.two_tier(df, "source", "b", "a", [F.col("id")], 5).count() == 5
    quota = spark.createDataFrame([("a", 1), ("b", 0), ("c", 4)], "source string, quota int")
    assert [r.id for r in select.quota_select(df, quota, "source", [F.desc("id")]).collect()] == [2]


def test_scored_lists(spark):
    rows = [(1, [5, 6, 7], [0.2, 0.9, 0.9], [6, 8, 9], [0.99, 0.7, float("nan")]), (2, [1], [0.5], [2], [0.5]), (3, [], [], [2], [0.9]), (4, [1], [0.5], [1], [0.9]), (5, [1], [0.5, 0.6], [2], [0.9]), (6, None, [0.5], [2], [0.9])]
    df = spark.createDataFrame(rows, "qid bigint, pos array<bigint>, pos_score array<double>, neg array<bigint>, neg_score array<double>")
    got = {r.qid: r for r in select.mined_pairs(df).collect()}
    assert (got[1].positive_doc_id, got[1].hard_negative_doc_id, got[1].reason) == (6, 8, None)
    assert [got[i].reason for i in range(2, 7)] == ["below_threshold", "no_positive", "no_negative", "unaligned_scores", "invalid_schema"]


def test_merges_are_idempotent(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3), ("c", 4), (None, 5)], "k string, v int")
    once = upsert.insert_if_absent(old, new, "k", [F.col("v")])
    assert {(r.k, r.v, r.inserted) for r in once.collect()} == {("a", 1, False), ("b", 2, False), ("c", 3, True)}
    assert upsert.insert_if_absent(once.drop("inserted"), new, "k", [F.col("v")]).filter("inserted").count() == 0
    best = upsert.upsert_better(old, new.filter("k IS NOT NULL"), "k", "v", [F.col("v")])
    assert {(r.k, r.v) for r in best.collect()} == {("a", 1), ("b", 9), ("c", 4)}
    assert {(r.k, r.v) for r in upsert.upsert_better(best, new.filter("k IS NOT NULL"), "k", "v", [F.col("v")]).collect()} == {("a", 1), ("b", 9), ("c", 4)}


@pytest.mark.parametrize("parts", [1, 8])
def test_greedy_is_the_sequential_scan(spark, parts):
    rng = random.Random(2)
    rows = [(i, *(str(0 if rng.random() < 0.3 else rng.randint(0, 60)) for _ in "abc")) for i in range(200)]
    seen, kept = [set(), set(), set()], set()
    for i, *keys in rows:
        if not any(k in s for k, s in zip(keys, seen)):
            kept.add(i)
            for k, s in zip(keys, seen):
                s.add(k)
    df = spark.createDataFrame(rows, "id int, a string, b string, c string").repartition(parts)
    got = dedup.greedy_keep(df, "id", {x: F.col(x) for x in "abc"}, ["id"])
    assert {r.id for r in got.filter("keep").collect()} == kept and got.count() == 200
    assert dedup.greedy_keep(df.limit(0), "id", {"a": F.col("a")}, ["id"]).count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)] + [(7, 7), (None, 3)]
    parent: dict = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in dedup.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_similar_texts_against_dense_tfidf(spark):
    rng = random.Random(4)
    words = [f"{x}{y}" for x in ("sông", "núi", "chợ", "đình", "kho") for y in "abcdefgh"]
    values = [" ".join(rng.choices(words, k=8)) for _ in range(40)]
    values += [v.replace("a", "b", 1) for v in values[:20]] + [values[0], values[0].upper()]
    counts, docs = [], defaultdict(set)
    for i, v in enumerate(values):
        tf = defaultdict(int)
        for w in v.lower().split():
            p = f" {w} "
            for n in (3, 4, 5):
                for j in range(len(p) - n + 1):
                    tf[p[j : j + n]] += 1
                    docs[p[j : j + n]].add(i)
        counts.append(tf)
    vocabulary = {g: k for k, g in enumerate(g for g, d in docs.items() if len(d) >= 2)}
    x = np.zeros((len(values), len(vocabulary)))
    for i, tf in enumerate(counts):
        for g, n in tf.items():
            if g in vocabulary:
                x[i, vocabulary[g]] = n * (np.log((1 + len(values)) / (1 + len(docs[g]))) + 1)
    x /= np.linalg.norm(x, axis=1)[:, None]
    s = x @ x.T
    first = [i for i, v in enumerate(values) if values.index(v) == i]
    want = {(i, j) for i in first for j in first if i < j and s[i, j] >= 0.9}
    got = dedup.similar_texts(texts(spark, values), "id", "text", threshold=0.9).collect()
    assert {(r.a, r.b) for r in got} == want and all(abs(r.similarity - s[r.a, r.b]) < 1e-9 for r in got)
    kept = dedup.near_duplicates(texts(spark, values), "id", "text", 0.9).filter("keep").count()
    assert kept < len(values)


def test_vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8)) + 3 * rng.normal(size=(6, 8))[rng.integers(6, size=300)]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 8), (902, [1.0])]
    corpus = vectors.usable(spark.createDataFrame(rows, "i bigint, v array<float>"), "i", "v", 8)
    assert corpus.count() == 300
    queries = corpus.filter("id % 10 = 0")
    u = np.array([r[1] for r in rows[:300]], dtype=np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    s = np.round(u @ u.T, 10)
    want = {i: np.argsort(-s[i], kind="stable")[:5].tolist() for i in range(0, 300, 10)}
    for block in (4096, 37):
        got = defaultdict(list)
        for r in sorted(vectors.exact_top_k(queries, corpus, 5, block).collect(), key=lambda r: r["rank"]):
            got[r.query_id].append(r.id)
        assert got == want
    full = vectors.ivf_top_k(queries, corpus, 5, lists=12, probes=12)
    half = vectors.ivf_top_k(queries, corpus, 5, lists=12, probes=6)
    hits = lambda df: sum(r.id in want[r.query_id] for r in df.collect()) / 150
    assert hits(full) == 1.0 and hits(half) >= 0.9
    positives = spark.createDataFrame([(i, (i + 1) % 300) for i in range(0, 300, 10)], "query_id bigint, id bigint")
    ranks = {r.query_id: r["rank"] for r in vectors.ranks(queries, corpus, positives, block=50).collect()}
    assert ranks == {i: 1 + int((s[i] > s[i, (i + 1) % 300]).sum()) for i in range(0, 300, 10)}


def test_inverted_lists_recall_of_the_defaults(spark):
    x = np.random.default_rng(11).normal(size=(20_000, 64)).astype(np.float32)
    corpus = spark.createDataFrame(list(zip(range(len(x)), x.tolist(), strict=True)), "id bigint, vec array<float>").repartition(4)
    queries = corpus.filter("id % 50 = 0")
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    want = {i: set(np.argsort(-(u[i] @ u.T), kind="stable")[:16].tolist()) for i in range(0, len(x), 50)}
    got = vectors.ivf_top_k(queries, corpus).collect()
    assert len(got) == 16 * len(want) and sum(r.id in want[r.query_id] for r in got) >= 0.9 * len(got)


def test_ranks_in_the_whole_table(spark, tmp_path):
    x = np.random.default_rng(12).normal(size=(400, 64)).astype(np.float32)
    labels = ["alone" if i == 300 else f"l{i % 7}" for i in range(400)]
    spark.createDataFrame([(i, labels[i], v) for i, v in enumerate(x.tolist())], "vec_id bigint, label string, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    s = np.round(u @ u.T, 10)
    want = {}
    for q in (0, 100, 200):
        positive = min(i for i in range(400) if i != q and labels[i] == labels[q])
        want[q] = 1 + sum(s[q, i] > s[q, positive] for i in range(400) if i != q)
    got = {r.query_id: r["rank"] for r in catalog.QUERIES["query_ranks"](spark, str(tmp_path)).collect()}
    assert got == want
    assert catalog.QUERIES["retrieval_metrics"](spark, str(tmp_path)).first().mean_rank == pytest.approx(sum(want.values()) / 3, abs=1e-6)


def test_title_children_of_all_sources(spark, tmp_path):
    rows = [(f"{i * 7919 % 5000:05}", f"s{i % 3}", "nóng" if i % 2 else [None, "", "a", "b"][i // 2 % 4]) for i in range(3000)]
    df = spark.createDataFrame(rows, "data_id string, source string, title string")
    df.write.parquet(f"{tmp_path}/general.parquet")
    groups = defaultdict(list)
    for i, _, title in sorted(rows, key=lambda r: r[0]):
        groups[title].append(i)
    want = sorted((str(t), k, i) for t, ids in groups.items() for k, i in enumerate(ids))
    for got in (catalog.QUERIES["title_children"](spark, str(tmp_path)), select.numbered(df, "title", ["data_id"], "k", slice_=100).select("title", "k", "data_id")):
        assert sorted((str(r.title), r.k, r.data_id) for r in got.collect()) == want


def test_metrics_and_expectations(spark):
    ranks = spark.createDataFrame([(1, 1), (2, 3), (3, 20)], "query_id int, rank int")
    m = evaluate.retrieval_metrics(ranks).first()
    assert m.recall_at_1 == pytest.approx(1 / 3) and m.mrr_at_10 == pytest.approx((1 + 1 / 3) / 3) and m.ndcg_at_5 == pytest.approx((1 + 0.5) / 3) and m.median_rank == 3
    df = spark.createDataFrame([("a", "x", "train"), ("a", " ", "test")], "id string, text string, split string")
    got = {r.check: r.passed for r in evaluate.expectations(df, unique=["id"], filled=["text"], rows=2, pure={"split": "train"}).collect()}
    assert got == {"rows": True, "unique id": False, "filled text": False, "pure split": False}
    with pytest.raises(evaluate.ExpectationError):
        evaluate.expectations(df, unique=["id"], fail=True)
    with pytest.raises(evaluate.ExpectationError):
        evaluate.many_to_one(df, df, "id")


def test_holdout_is_disjoint(spark):
    word = lambda i: f"câu hỏi số {i} dài"
    rows = [(f"s{k}", word(i % 90), f"đoạn đúng {i} " * 10, f"đoạn sai {i} " * 10, f"{k}{i:04}") for k in range(2) for i in range(200)]
    shards = spark.createDataFrame(rows, "shard string, query string, positive string, negative string, data_id string")
    train = spark.createDataFrame([(word(i).upper(),) for i in range(0, 90, 2)], "query string")
    got = evaluate.holdout_rows(shards, train, 12, 4, 20, ["data_id"])
    picked = got.collect()
    queries = [r.query for r in picked]
    assert len(queries) == len(set(queries)) == 22 and not {q.upper() for q in queries} & {r[0] for r in train.collect()}
    q, docs, qrels = evaluate.holdout_tables(got)
    assert (q.count(), docs.count(), qrels.count()) == (22, 44, 22)
    assert qrels.join(docs, qrels.corpus_id == docs.id, "left_anti").count() == 0


def test_lexical_negatives(spark):
    rows = [(i, f"sông {i % 7} núi" if i % 5 else f"riêng{i}", f"văn bản {i}", f"văn bản {i}" if i != 3 else "văn bản 2") for i in range(60)] + [(99, None, "không tên", "không tên")]
    df = spark.createDataFrame(rows, "id int, title string, text string, passage string")
    got = lexical.lexical_negatives(df, "id", "title", "text", "passage").collect()
    by_title = {r[0]: r[1] for r in rows}
    assert len(got) == 61 and all(r.negative_id is not None and by_title[r.negative_id] != by_title[r.id] for r in got)
    alone = lexical.lexical_negatives(df.limit(1), "id", "title", "text", "passage").collect()
    assert len(alone) == 1 and alone[0].negative_id is None


def test_exact_quotas(spark):
    df = spark.createDataFrame([("1", "a", "x"), ("2", "a", "y"), ("3", "b", "X"), ("4", "b", "z")], "id string, source string, anchor string")
    quota = lambda *rows: spark.createDataFrame(list(rows), "source string, quota int")
    assert {r.id for r in select.exact_quotas(df, quota(("a", 1), ("b", 0)), "source", [F.col("id")], [["id"], ["anchor"]]).collect()} == {"1"}
    with pytest.raises(ValueError, match="selected 2 rows where 3"):
        select.exact_quotas(df, quota(("a", 3)), "source", [F.col("id")], [])
    with pytest.raises(ValueError, match="selected 0 rows"):
        select.exact_quotas(df, quota(("c", 1)), "source", [F.col("id")], [])
    with pytest.raises(ValueError, match="repeats anchor"):
        select.exact_quotas(df, quota(("a", 1), ("b", 1)), "source", [F.col("id")], [["anchor"]])


def test_errors_as_the_reference_has_them(spark):
    from trisieve.functions import text as t

    with pytest.raises(Exception, match="only artifacts"):
        texts(spark, ["[[ ]]"]).select(t.drop_artifacts(F.col("text"))).collect()
    assert [r[0] for r in texts(spark, ["e\u0301 [[", "", None]).orderBy("id").select(t.drop_artifacts(F.col("text"))).collect()] == ["\u00e9", "", None]
    with pytest.raises(Exception, match="answer is longer"):
        texts(spark, ["abc"]).select(chunk.answer_windows(F.col("text"), F.array(F.lit(0)), F.array(F.lit("x" * 9)), 8)).collect()


def test_encoder_interface_and_mean_score(spark):
    from trisieve.functions import encoding

    seen = lambda batch: [[float(len(x)), 0.0] if x.startswith("query: ") else [0.0, 0.0] for x in batch]
    df = texts(spark, ["ab", None, ""])
    assert [r.vec for r in encoding.encode(df, "text", "query", seen, batch=1).orderBy("id").collect()] == [[1.0, 0.0], None, [1.0, 0.0]]
    assert encoding.encode(df.limit(0), "text", "passage", seen).count() == 0
    with pytest.raises(ValueError):
        encoding.encode(df, "text", "other", seen)
    scores = spark.createDataFrame([(0.5,), (1.0,), (None,)], "score double")
    assert tuple(evaluate.mean_score(scores, "score").first()) == (0.75, 2)


def test_near_duplicates_by_domain_and_neighbours(spark):
    base = "một câu hỏi khá dài về con sông lớn chảy qua vùng đồng bằng rộng"
    rows = [(f"{i:02}", "d" if i < 12 else None, base + " " * (i % 2) + (" x" if i == 3 else "")) for i in range(16)] + [("90", "d", None), ("91", "d", ""), ("92", "d", "khác hẳn")]
    df = spark.createDataFrame(rows, "id string, domain string, text string")
    found = dedup.similar_texts(df, "id", "text", 0.9, group_col="domain").collect()
    assert {(r.a, r.b) for r in found} == {("00", "01"), ("00", "03"), ("01", "03"), ("12", "13")}
    few = dedup.similar_texts(df, "id", "text", 0.9, group_col="domain", neighbours=1).collect()
    assert {(r.a, r.b) for r in few} <= {(r.a, r.b) for r in found} and ("12", "13") in {(r.a, r.b) for r in few}
    kept = dedup.near_duplicates(df, "id", "text", 0.9, group_col="domain").filter("keep").collect()
    assert sorted(r.id for r in kept) == ["00", "12", "90", "91", "92"]
    assert dedup.near_duplicates(df.limit(0), "id", "text").count() == 0


def _scratch_rows(monkeypatch):
    """The row counts of all scratch tables that `dedup` writes from now on."""
    rows, write = [], dedup.materialize

    def counted(df, label="t"):
        table = write(df, label)
        rows.append(table.count())
        return table

    monkeypatch.setattr(dedup, "materialize", counted)
    return rows


def _wordy(spark, n=60):
    """Long texts of few words, some of them almost equal to another."""
    rng = random.Random(7)
    names = ["".join(rng.choices("abcdefghiklmnoprstuvyăâêôơư", k=rng.randint(2, 9))) for _ in range(300)]
    values = [" ".join(rng.choices(names, k=40)) for _ in range(n)]
    return texts(spark, values + [f"{v} {rng.choice(names)}" for v in values[::2]] + [v.replace(" ", "  ", 3) for v in values[::5]])


def test_near_dup_pairs_store_no_gram_of_each_text(spark, monkeypatch):
    df = _wordy(spark)
    for name, value in (("SLICE_TEXTS", 40), ("ROWS_PER_SALT", 3), ("BUCKET_ROWS", 30)):
        monkeypatch.setattr(dedup, name, value, raising=False)
    rows = _scratch_rows(monkeypatch)
    got = {(r.a, r.b): r.similarity for r in dedup.similar_texts(df, "id", "text", 0.9).collect()}
    # about 250 different n-grams are in each of the 102 texts
    assert max(rows) < 30 * 102
    counts = {r.id: Counter(p[k : k + n] for w in r.text.split() for p in (f" {w} ",) for n in (3, 4, 5) for k in range(len(p) - n + 1)) for r in df.collect()}
    dfs = Counter(g for x in counts.values() for g in x)
    unit = {}
    for i, x in counts.items():
        w = {g: tf * (math.log((1 + len(counts)) / (1 + dfs[g])) + 1) for g, tf in x.items() if dfs[g] > 1}
        unit[i] = {g: v / math.sqrt(sum(y * y for y in w.values())) for g, v in w.items()}
    want = {(a, b): s for a in unit for b in unit if a < b and (s := sum(v * unit[b].get(g, 0) for g, v in unit[a].items())) >= 0.9}
    assert len(want) > 40 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_components_of_stars_take_no_round(spark, monkeypatch):
    stars = spark.range(400).select(F.concat(F.lit("o"), "id").alias("a"), F.concat(F.lit("c"), F.col("id") % 7).alias("b"))
    rows = _scratch_rows(monkeypatch)
    got = {(r.node, r.component) for r in dedup.components(stars).collect()}
    assert got == {(f"o{i}", f"c{i % 7}") for i in range(400)} | {(f"c{i}", f"c{i}") for i in range(7)} and len(rows) == 1


def test_components_slice_hot_nodes_only(spark, monkeypatch):
    monkeypatch.setattr(dedup, "ROWS_PER_SALT", 5)
    rng = random.Random(3)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(70)] + [(90, i) for i in range(40)] + [(i, i + 1) for i in range(200, 240)]
    parent = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r.node: r.component for r in dedup.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {n: c for n, c in parent.items() if n in {x for a, b in edges if a != b for x in (a, b)}}


def test_bounded_join_repeats_no_broadcast(spark):
    right = materialize(spark.range(100_001).select("id", (F.col("id") % 3).alias("x")))
    plan = bounded_join(spark.range(10), right, ["id"], by=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_near_dup_neighbours_store_no_gram_of_each_text(spark, monkeypatch):
    df = _wordy(spark)
    rows = _scratch_rows(monkeypatch)
    near = {(r.a, r.b) for r in dedup.similar_texts(df, "id", "text", 0.9, neighbours=1).collect()}
    assert max(rows) < 30 * 102
    best = {}
    for r in dedup.similar_texts(df, "id", "text", 0.9).collect():
        for x, y in ((r.a, r.b), (r.b, r.a)):
            best[x] = max(best.get(x, (-1.0, 0)), (round(r.similarity, 9), -y))
    assert near == {(min(x, -y), max(x, -y)) for x, (_, y) in best.items()}


def test_near_dup_neighbours_repeat_no_text_and_no_gram(spark, monkeypatch):
    df, sides, join = _wordy(spark), [], dedup.bounded_join
    want = {(r.a, r.b) for r in dedup.similar_texts(df, "id", "text", 0.9, neighbours=1).collect()}

    def counted(left, right, *args, **kwargs):
        sides.append(right.count())
        return join(left, right, *args, **kwargs)

    monkeypatch.setattr(dedup, "bounded_join", counted)
    assert {(r.a, r.b) for r in dedup.similar_texts(df, "id", "text", 0.9, neighbours=1).collect()} == want
    # beyond the limits of a broadcast a right side is shuffled once for each salt: here they hold a row a group, none a text or an n-gram
    assert len(want) > 20 and max(sides) <= 1


def test_sketches_keep_the_bound():
    rng = np.random.default_rng(5)
    values = rng.random((50, dedup.SKETCH)) ** 3
    values /= np.linalg.norm(values, axis=1, keepdims=True)
    values[0], values[1] = 0, np.eye(dedup.SKETCH)[3]
    codes = dedup._packed(values).to_pylist()
    got = dedup._unpacked(codes)
    assert len(codes[0]) == dedup.SKETCH + 1 and (got >= values - 1e-6).all() and (got <= values + 0.005).all()


def test_near_dup_components_digest_the_texts_once(spark, monkeypatch):
    df, calls, equal = _wordy(spark), [], dedup.equal_texts
    monkeypatch.setattr(dedup, "equal_texts", lambda *a, **k: calls.append(a) or equal(*a, **k))
    rows = _scratch_rows(monkeypatch)
    got = {r.id: r.component for r in dedup.near_duplicates(df, "id", "text", 0.9).collect()}
    assert len(calls) == 1 and max(rows) < 30 * 102
    assert len(got) == 102 and all(got[i] == i for i in range(60)) and all(got[60 + i] == 2 * i for i in range(30)) and all(got[90 + i] == 5 * i for i in range(12))
