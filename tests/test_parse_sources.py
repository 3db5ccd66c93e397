import json
import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisieve.operators import evaluate, parse
from trisieve.plans import pipelines
from trisieve.sources import readers, sinks
from trisieve.streaming import incremental


def test_faq_tables_and_classes():
    page = """<table><tr><th>STT</th><th>Câu hỏi</th><th>Trả lời</th></tr><tr><td>1</td><td>Cái <b>gì</b>?</td><td>Cái &amp; này</td></tr><tr><td>x</td></tr></table>
    <table><tr><th>Tên</th></tr><tr><td>a</td><td>b</td></tr></table><div class="faq-question">Hỏi 2</div><p class="long-answer-box">Đáp 2</p>"""
    assert parse.faq_from_page(page) == [("Cái gì ?", "Cái & này", ""), ("Hỏi 2", "Đáp 2", "")]
    accordion = '<details class="x-faq__item" data-categories="thẻ,vay"><summary class="x-faq__qtext">Q</summary><div class="x-faq__a">A <script>no</script></div></details>'
    assert parse.faq_from_accordion(accordion) == [("Q", "A", "thẻ > vay")]
    detail = '<div class="DetailQuestion"><div class="divFirst">Câu hỏi: Q?</div><fieldset><legend>tên</legend>A.</fieldset></div>'
    assert parse.faq_from_detail(detail) == [("Q?", "A.", "")]
    assert parse.faq_from_detail(detail.replace("A.", "Chưa trả lời")) == []


def test_faq_operator(spark):
    html = "<table><tr><th>Câu hỏi</th><th>Đáp</th></tr><tr><td>Q</td><td>A</td></tr><tr><td>Q </td><td>A</td></tr><tr><td></td><td>A</td></tr></table>"
    pages = spark.createDataFrame([("u", "s", "g", html), ("v", "s", "g", None), ("w", "s", "g", "<" * 50)], "url string, source string, source_group string, html string")
    got = parse.faq_rows(pages).collect()
    assert [(r.question, r.answer, r.error) for r in got] == [("Q", "A", None)] and len(got[0].id) == 64


def test_text_pairs_links_and_json(spark):
    df = spark.createDataFrame([("Câu hỏi 1: Một là gì? Trả lời: Là một. Hỏi: Hai? Đáp: Là hai.", 1), ("không có", 2)], "text string, id int")
    assert [(r.question, r.answer) for r in parse.text_pairs(df, "text").collect()] == [("Một là gì?", "Là một."), ("Hai?", "Là hai.")]
    one = lambda x: spark.range(1).select(x.alias("x")).first().x
    assert tuple(one(parse.postback(F.lit("javascript:__doPostBack('a$b', '7')")))) == ("a$b", "7") and one(parse.postback(F.lit("/x"))) is None
    assert one(parse.last_page(F.array(F.lit("/?Page=3&x=1"), F.lit("/?Page=12"), F.lit("/?p=99")))) == 12 and one(parse.last_page(F.array().cast("array<string>"))) == 1
    assert one(parse.without_fence(F.lit("```json\n[1]\n```"))) == "[1]" and one(parse.without_fence(F.lit(" [1] "))) == "[1]"
    good = {"q": "a }{", "a": "b"}
    broken = "[" + json.dumps(good) + ', {"q": 1}, {bad}, {"q": "x", "a": " y "}, {"q": "cut'
    rows = spark.createDataFrame([(broken, 5), (json.dumps([good, good]), 1), ("nothing", 1)], "content string, expected int")
    got = parse.salvaged(rows, "content", ["q", "a"], limit="expected").collect()
    assert [(r.q, r.a) for r in got] == [("a }{", "b"), ("x", "y"), ("a }{", "b")]


def test_readers(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    (tmp_path / "l.jsonl").write_text('{"a": 1, "b": "x"}\n\n{"a": \n{"b": "y"}\n')
    rows = readers.json_lines(spark, str(tmp_path / "l.jsonl"), schema).collect()
    assert sorted((r.a or 0, r.b or "", r.error is not None) for r in rows) == [(0, "", True), (0, "y", False), (1, "x", False)]
    (tmp_path / "a.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert readers.json_state(spark, str(tmp_path / "a.json"), schema).count() == 2
    with sqlite3.connect(tmp_path / "t.db") as con:
        con.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, name TEXT, score REAL)")
        con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, f"n{i}" if i % 7 else None, i / 2) for i in range(100)])
    table = readers.sqlite(spark, str(tmp_path / "t.db"), "t")
    assert table.count() == 100 and table.filter("name IS NULL").count() == 15 and dict(table.dtypes) == {"id": "bigint", "name": "string", "score": "double"}
    spark.range(3).write.parquet(str(tmp_path / "s"))
    named = readers.shards(spark, str(tmp_path / "s"), ["id"], revision="r1")
    assert named.columns == ["id", "shard", "revision"] and named.filter("shard LIKE 'part-%'").count() == 3


def test_schema_checks(spark):
    df = spark.createDataFrame([("a", 1)], "x string, n int")
    assert readers.assert_schema(df, ["x"]) is df
    for expected, mode in ((["x", "z"], "subset"), (["x"], "exact"), (T.StructType([T.StructField("x", T.StringType()), T.StructField("n", T.LongType())]), "equal")):
        with pytest.raises(readers.SchemaError):
            readers.assert_schema(df, expected, mode)
    assert readers.resolve_columns(df, {"text": ["question", "x"]}).columns == ["text"]
    with pytest.raises(readers.SchemaError):
        readers.resolve_columns(df, {"text": ["question"]})


def test_publishing(spark, tmp_path):
    path, df = str(tmp_path / "out"), spark.range(10).withColumn("s", F.lit("x"))
    assert sinks.publish(df, path, dictionary=["s"]) is None
    with pytest.raises(FileExistsError):
        sinks.publish(df, path)

    def fail(_):
        raise ValueError("bad")

    with pytest.raises(ValueError):
        sinks.publish(spark.range(1), path, fail, replace=True)
    assert spark.read.parquet(path).count() == 10 and len(list(tmp_path.iterdir())) == 1
    backup = sinks.publish(spark.range(3), path, replace=True)
    assert spark.read.parquet(path).count() == 3 and spark.read.parquet(backup).count() == 10
    assert all(len(v) == 64 for v in sinks.file_digests(df, path).values())
    target = str(tmp_path / "keyed")
    first = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    assert sinks.append_new(first, target, "k") == 2 and sinks.append_new(first, target, "k") == 0
    with pytest.raises(FileExistsError):
        sinks.refuse_filled(df)
    assert sinks.copy_to_sqlite(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), str(tmp_path / "c.db"), "t", "k") == 2
    sinks.write_json_lines(df, str(tmp_path / "j"))
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "j")).count() == 10


def test_reusable_tables_and_markers(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(len(built))

    path = str(tmp_path / "index")
    assert [sinks.reusable(spark, path, m, build).count() for m in ({"k": 1}, {"k": 1}, {"k": 2})] == [1, 1, 2] and len(built) == 2
    rows = spark.createDataFrame([("Bench-VI",), ("ok",)], "source string")
    assert [r.observed for r in evaluate.expectations(rows, absent={"source": ["bench"]}).collect()] == [1]


def test_incremental_stream(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").write.parquet(source)
    stream = lambda: spark.readStream.schema("k string, v int").parquet(source)
    incremental.load_incrementally(stream(), target, "k", check).awaitTermination()
    spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int").write.mode("append").parquet(source)
    incremental.load_incrementally(stream(), target, "k", check).awaitTermination()
    assert {(r.k, r.v) for r in spark.read.parquet(target).collect()} == {("a", 1), ("b", 2), ("c", 3)}


def test_pipelines(spark):
    long_a, long_b = "what is the red thing " * 2, "the red thing is a passage that is long enough to keep here. " * 2
    rows = [("1", "S", "r", "train", 1, "d", "t", long_a, long_b, "other red words in a passage that is long enough to be kept. " * 2), ("2", "S", "r", "train", 2, "d", "t", long_a.upper(), long_b, "nothing of it at all in this passage that is long enough too. " * 2), ("3", "S", "r", "train", 3, "d", "t", "x", long_b, long_b)]
    df = spark.createDataFrame(rows, "data_id string, source string, source_revision string, source_split string, source_row_index int, domain string, task_type string, anchor string, positive string, hard_negative string")
    cleaned = pipelines.clean_english(df)
    assert {r.data_id: r.reason for r in cleaned.collect()} == {"1": None, "2": None, "3": "anchor_length"}
    best = pipelines.best_english(cleaned).collect()
    assert [r.data_id for r in best] == ["1"] and best[0].clean_id.startswith("en_clean_") and best[0].source_row_index == "1"
    body = lambda i: " ".join(f"chữ{i}_{j}" for j in range(150))
    general = [(f"{i}_{k:03}", "s", f"Bài {i}", "t", "a", body(i)[o : o + 384], None) for i in range(3) for k, o in enumerate(range(0, len(body(i)), 336))]
    g = spark.createDataFrame(general, "data_id string, source string, title string, topic string, anchor string, positive string, hard_negative string")
    out = pipelines.rebuild_documents(g).collect()
    assert {r.anchor for r in out} == {f'"Bài {i}" là gì?' for i in range(3)} and all(len(r.positive) <= 384 and r.hard_negative for r in out)
    assert all(r.hard_negative.split("_")[0] != r.positive.split("_")[0] for r in out)
    exported = pipelines.clean_export(df.select("data_id", "source", "anchor", "positive", "hard_negative"), ["source", "data_id"]).collect()
    assert len(exported) == 3


def test_generated_and_stored_documents(spark):
    rows = [("1", '[{"a": " x ", "source": "cổng 1"}, {"a": "", "source": "s"}, {"a": "y", "source": "s"}]'), ("2", None), ("3", "kein JSON")]
    df = spark.createDataFrame(rows, "id string, content string")
    assert [tuple(r) for r in parse.generated_documents(df, "content", ["a", "source"], 2, ["Cổng"]).select("id", "a", "source").collect()] == [("1", "x", "Cổng")]
    lines = ['{"a": "x", "b": "y"}', '{"a": "x", "b": "y", "answer": "z"}', '{"a": "x"}', '{"a": "x", "b": " "}', '{"a": 1, "b": "y"}', "[]", "{", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "id int, line string")
    assert [r.error for r in parse.stored_documents(df, "line", ["a", "b"]).orderBy("id").collect()] == [None, None, "incompatible", "invalid", "invalid", "incompatible", "incompatible", "incompatible"]


def test_append_new_keeps_the_first_in_order(spark, tmp_path):
    rows = spark.createDataFrame([("k", 2), ("k", 1), ("l", 5)], "k string, v int")
    target = str(tmp_path / "t")
    assert sinks.append_new(rows, target, "k") == 2
    assert {tuple(r) for r in spark.read.parquet(target).collect()} == {("k", 1), ("l", 5)}
