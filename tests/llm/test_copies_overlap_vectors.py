import random
import unicodedata
from collections import defaultdict

import numpy as np
import pytest

from trisieve import runtime
from trisieve.llm import p3_neighbours, p6_copies, p7_overlap


def canon(v):
    return "".join(c for c in (v or "").casefold() if not c.isspace() and unicodedata.category(c)[0] != "P")


@pytest.mark.parametrize("bucket_rows", [2, 200_000])
def test_copies_against_brute_force(spark, bucket_rows):
    rng = random.Random(1)
    base = [[f"câu {i} có chữ", f"đoạn {i}", f"khác {i}" if i % 3 else None] for i in range(40)]
    data = []
    for n in range(300):
        fields = list(base[0 if n % 3 == 0 else rng.randrange(40)])
        rng.shuffle(fields)
        fields = [v if v is None or rng.random() < 0.5 else rng.choice([v.upper(), v.replace(" ", "  "), v + "!", "«" + v + "»"]) for v in fields]
        fields = ["" if v is None and rng.random() < 0.5 else v for v in fields]
        data.append((f"{n:04}", *fields, "k", 1))
    table = spark.createDataFrame(data, "data_id string, a string, b string, c string, key string, n int")
    groups = defaultdict(list)
    for r in data:
        groups[tuple(sorted(canon(v) for v in r[1:4]))].append(r[0])
    got = {(r.keep_id, r.copy_id) for r in p6_copies.copies(table, "data_id", ["a", "b", "c"], bucket_rows).collect()}
    assert got == {(min(g), x) for g in groups.values() for x in g if x != min(g)}
    records = {(r.keep_id, r.copies) for r in p6_copies.distinct_records(table, "data_id", ["a", "b", "c"], bucket_rows).collect()}
    assert records == {(min(g), len(g)) for g in groups.values()}


def test_copies_edges(spark):
    table = spark.createDataFrame([("1", None, "", " "), ("2", "!", None, "\t"), ("3", "a²", "b", None), ("4", "a2", "b", None), ("5", "x" * 40_000, "", ""), ("6", "", "", "X " * 40_000)], "data_id string, a string, b string, c string")
    assert {(r.keep_id, r.copy_id) for r in p6_copies.copies(table, "data_id", ["a", "b", "c"]).collect()} == {("1", "2"), ("5", "6")}
    assert p6_copies.copies(table.limit(0), "data_id", ["a", "b", "c"]).count() == 0


def test_trie_counts():
    rng = random.Random(2)
    keys = [bytes(rng.choices(b"ab", k=rng.randint(0, 6))) for _ in range(500)]
    trie = p6_copies.Trie()
    for i, k in enumerate(keys):
        trie.add(k, 1, f"{i:03}")
    assert {k: (n, least, e) for k, n, least, e in trie.items()} == {k: (keys.count(k), f"{keys.index(k):03}", keys.count(k)) for k in keys}
    assert len(list(trie.items())) == len(set(keys))


def test_buckets_split_until_they_fit(spark):
    head = "rất dài chung " * 12
    data = [(f"{i:04}", (head if i % 3 else "") + f"câu {i % 400:03}") for i in range(1200)] + [(f"x{i:03}", "một câu lặp lại") for i in range(300)]
    table = spark.createDataFrame(data, "data_id string, a string").repartition(7)
    folded = p6_copies.folded_records(table, "data_id", ["a"])
    sizes = p6_copies.radix_buckets(folded, 40).groupBy("bucket").count().collect()
    assert max(r["count"] for r in sizes) <= 40 and max(len(r.bucket) for r in sizes) > p6_copies.HEAD
    got = {r.keep_id: r.copies for r in p6_copies.distinct_records(table, "data_id", ["a"], 40).collect()}
    groups = defaultdict(list)
    for i, a in data:
        groups[a].append(i)
    assert got == {min(g): len(g) for g in groups.values()}


def test_production_limit_splits_at_the_driver_s_size(spark):
    rows = spark.range(45_000).selectExpr("concat('r', id) AS data_id", "concat('câu hỏi số ', id % 44000) AS a")
    folded = p6_copies.folded_records(rows, "data_id", ["a"])
    sizes = [r["count"] for r in p6_copies.radix_buckets(folded, p6_copies.BUCKET_ROWS).groupBy("bucket").count().collect()]
    assert max(sizes) <= p6_copies.BUCKET_ROWS and len(sizes) > 1
    assert p6_copies.copies(rows, "data_id", ["a"]).count() == 1000


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(3000):
        a, b = (rng.choices("abc", k=rng.randint(0, 8)) for _ in "ab")
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        k = rng.randint(0, 5)
        assert p7_overlap.within(a, b, k) == (row[-1] <= k)


def test_overlaps_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(runtime, "ROWS_PER_SALT", 7)
    rng = random.Random(5)
    vocabulary = [f"từ{i}" for i in range(300)]
    base = [rng.choices(vocabulary, k=rng.randint(12, 60)) for _ in range(30)]
    data = []
    for n in range(240):
        words = list(base[0 if n % 3 == 0 else rng.randrange(30)])
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        text = " ".join(words)
        data.append((f"{n:03}", rng.choice(["train", "train", "test", None]), "s", rng.choice([text.upper(), text + "?", text.replace(" ", ", ")]), rng.choice([None, "", "?!"]), "c"))
    table = spark.createDataFrame(data, "data_id string, split string, source string, anchor string, positive string, cls string")
    want = set()
    for field in (3, 4):
        items = [(r[0], r[1], [w for w in "".join(c if c.isalnum() else " " for c in r[field].lower()).split()]) for r in data if r[field] is not None and r[1]]
        for i, sa, a in items:
            for j, sb, b in items:
                if i < j and (sa == "train") != (sb == "train") and p7_overlap.within(a, b, max(len(a), len(b)) // 10):
                    want.add((["anchor", "positive"][field - 3], i, j))
    got = {tuple(r) for r in p7_overlap.overlap_pairs(table, "data_id", "split", ["anchor", "positive"]).collect()}
    assert got <= want and len(got) >= 0.99 * len(want)
    report = p7_overlap.overlap_report(table, "data_id", "split", "source", ["anchor", "positive"]).collect()
    assert all(r.split == "test" and r.overlapping <= r.rows for r in report)
    assert p7_overlap.overlap_pairs(table.limit(0), "data_id", "split", ["anchor"]).count() == 0


def even_edits(n):
    """(a, b) of about n words, with as many edits as are allowed, one in every ten words, or one too many."""
    rng = random.Random(n)
    for i in range(24):
        a = [f"w{rng.randrange(5000)}" for _ in range(n)]
        b = list(a)
        for k in range((n + 1) // 10 if i % 2 else n // 10):
            at = len(a) - 1 - (k * 10 + 4) % n
            if i % 2:
                b.insert(at, "neu")
            else:
                b[at] = "neu"
        yield (b, a) if i % 4 > 1 else (a, b)


def test_overlaps_with_edits_at_even_distances(spark):
    data, want = [], set()
    for n in (9, 10, 11, 19, 20, 60, 200, 800):
        for i, (a, b) in enumerate(even_edits(n)):
            data += [(f"a{n}-{i:02}", "train", " ".join(a)), (f"b{n}-{i:02}", "test", " ".join(b))]
            if p7_overlap.within(a, b, max(len(a), len(b)) // 10):
                want.add(("text", f"a{n}-{i:02}", f"b{n}-{i:02}"))
    table = spark.createDataFrame(data, "data_id string, split string, text string")
    assert len(want) >= 100
    assert {tuple(r) for r in p7_overlap.overlap_pairs(table, "data_id", "split", ["text"]).collect()} == want


def brute(data, k):
    want = {}
    for group in {g for _, g, _ in data}:
        rows = sorted((i, np.asarray(v, np.float32).astype(float)) for i, g, v in data if g == group and v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v) and any(v))
        x = np.array([v for _, v in rows])
        x /= np.linalg.norm(x, axis=1)[:, None]
        s = np.round(x @ x.T, 12)
        np.fill_diagonal(s, -9)
        for r, (i, _) in enumerate(rows):
            want[i] = [rows[c][0] for c in np.argsort(-s[r], kind="stable")[:k]]
    return want


@pytest.mark.parametrize("bucket", [20, 4096])
def test_neighbours_against_brute_force(spark, bucket):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 64))
    data = []
    for i in range(600):
        v = centres[0 if i % 3 == 0 else rng.integers(12)] + 0.25 * rng.normal(size=64)
        data.append((i, "ab"[i % 2], (v * rng.choice([0.5, 1, 2])).astype(np.float32).tolist()))
    same = data[1][2]
    data += [(1000 + i, "b", same) for i in range(9)]
    data += [(2000, "a", None), (2001, "a", [0.0] * 64), (2002, "a", [float("nan")] * 64), (2003, "a", [1.0] * 63), (2004, "a", [None] * 64)]
    table = spark.createDataFrame([(*r, 1, "x") for r in data], "vec_id bigint, field_name string, vec array<float>, rep int, raw string")
    want = brute(data, 5)
    got = defaultdict(list)
    for r in sorted(p3_neighbours.nearest(table, "vec_id", "field_name", "vec", bucket=bucket).collect(), key=lambda r: r["rank"]):
        got[r.vec_id].append(r.neighbour)
    hits = sum(len(set(got[i]) & set(v)) for i, v in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9
    assert all(got[i] == want[i] for i in [1, *range(1000, 1009)])
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())


def test_neighbours_edges(spark):
    table = spark.createDataFrame([(1, "a", [1.0] * 64), (2, "b", [1.0] * 64), (None, "a", [1.0] * 64)], "vec_id bigint, field_name string, vec array<float>")
    assert p3_neighbours.neighbour_pairs(table, "vec_id", "field_name", "vec").count() == 0
    assert p3_neighbours.neighbour_pairs(table.limit(0), "vec_id", "field_name", "vec").count() == 0
