import numpy as np

from trisieve.llm import p8_packing, p9_mixing, p10_levels, tokens


def docs(spark, values):
    return spark.createDataFrame([(*v, 1, "x") for v in values], "doc_id bigint, text string, lang string, source string, bin int, tokens string")


def test_sum_of_squares():
    sizes = np.array([5, 5, 10, 3, 7, 10, 1, 9])
    where, place, offset = p8_packing.pack(sizes, 10)
    assert where.max() + 1 == 5
    for b in set(where):
        inside = sorted(zip(place[where == b], offset[where == b], sizes[where == b]))
        assert [p for p, _, _ in inside] == list(range(len(inside)))
        assert [o for _, o, _ in inside] == [sum(s for _, _, s in inside[:i]) for i in range(len(inside))]
        assert sum(s for _, _, s in inside) <= 10
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 900, 5000)
    where, _, _ = p8_packing.pack(sizes, 2048)
    assert np.bincount(where, sizes).max() <= 2048 and sizes.sum() / 2048 / (where.max() + 1) > 0.98


def test_packing_operator(spark):
    values = [(i, "chữ số " * (1 + i % 50), "vi", "s") for i in range(300)] + [(1000, "từ " * 6000, "vi", "s"), (1001, None, None, None), (1002, " \n", "vi", "s"), (5, "thêm", "vi", "s")]
    table = docs(spark, values)
    counts = {(r.doc_id, r.tokens) for r in tokens.token_counts(table, "doc_id", "text", []).collect()}
    assert len(counts) == 302
    placed = p8_packing.pack_documents(table, "doc_id", "text", capacity=512, shard_items=100).toPandas()
    assert placed.groupby("container").tokens.sum().max() <= 512
    assert sorted(placed.groupby("container").tokens.sum() / 512) == sorted(placed.groupby("container").fill.first())
    assert set(placed.container) == set(range(placed.container.nunique()))
    assert placed.tokens.sum() == sum(n for _, n in counts)
    assert (placed[placed.doc_id < 1000].part == 0).all()
    long = placed[placed.doc_id == 1000].sort_values("part")
    assert (long.tokens[:-1] == 512).all() and list(long.first_token) == [512 * i for i in range(len(long))]
    assert p8_packing.pack_documents(table.limit(0), "doc_id", "text").count() == 0


def test_mixing(spark):
    values = [(i, "chữ " * (1 + i % 40), "vi", "big" if i % 3 else "small") for i in range(900)] + [(5000, None, "vi", "big"), (5001, "x", "vi", None), (5002, "x", "vi", "other")]
    targets = spark.createDataFrame([("big", 0.3, 1, "h"), ("small", 0.5, 3, "h"), ("none", 0.1, 2, "h"), ("big", None, None, "h"), ("tiny", 0.0, 1, "h")], "source string, target_share double, max_repeats int, h string")
    chosen, report = p9_mixing.mix(docs(spark, values), targets)
    picked, rows = chosen.toPandas(), {r.source: r for r in report.collect()}
    assert set(rows) == {"big", "small", "none", "tiny"}
    total = sum(r.available for r in rows.values())
    for s in ("big", "small"):
        assert abs(rows[s].tokens - rows[s].target_share * total) <= 45 and rows[s].reached
        assert (picked[picked.source == s].tokens * picked[picked.source == s].repeats).sum() == rows[s].tokens
    assert picked[picked.source == "big"].repeats.max() == 1 and picked[picked.source == "small"].repeats.max() <= 3
    assert not rows["none"].reached and rows["none"].tokens == 0
    assert abs(sum(r.actual_share for r in rows.values()) - 1) < 1e-9
    capped = {r.source: r for r in p9_mixing.mix(docs(spark, values), targets, total_tokens=10 * total)[1].collect()}
    assert not capped["small"].reached and capped["small"].tokens == 3 * capped["small"].available
    assert p9_mixing.mix(docs(spark, values).limit(0), targets)[0].count() == 0
    assert p9_mixing.mix(docs(spark, values), targets.limit(0))[1].count() == 0


def test_levels_on_held_out_documents(spark):
    rng = np.random.default_rng(3)
    level_words = [[f"{chr(97 + k)}{a}{b}" for a in "aeiou" for b in "bcdgh"] for k in range(4)]
    values, ratings = [], []
    for i in range(400):
        level = 1 + i % 4
        picks = [str(rng.choice(level_words[max(0, level - 1 - int(rng.integers(0, 2)) * (rng.random() < 0.4))])) for _ in range(60)]
        values.append((i, " ".join(picks), "VI", "s"))
        if i < 200:
            ratings += [(i, level, "r"), (i, min(4, level + (rng.random() < 0.1)), "q")]
    values += [(900, None, "vi", "s"), (901, " ", "vi", "s"), (902, "12 34", None, None), (903, "aab " * 20_000, "vi", "s"), (0, values[0][1], "vi", "s")]
    ratings += [(5, 9, "r"), (None, 1, "r"), (7777, 2, "r"), (6, None, "r")]
    rated = spark.createDataFrame(ratings, "doc_id bigint, reading_level int, rater string")
    got = p10_levels.reading_levels(docs(spark, values), rated).collect()
    assert len(got) == 403
    held = [r.reading_level == 1 + r.doc_id % 4 for r in got if 200 <= r.doc_id < 400]
    assert np.mean(held) > 0.9
    profile = p10_levels.level_profile(p10_levels.reading_levels(docs(spark, values), rated)).collect()
    assert sum(r.documents for r in profile) == 403 and {r.lang for r in profile} == {"vi", None}
    assert p10_levels.reading_levels(docs(spark, values).limit(0), rated).count() == 0
    assert {r.reading_level for r in p10_levels.reading_levels(docs(spark, values), rated.limit(0)).collect()} == {2}
