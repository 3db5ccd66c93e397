import unicodedata

import pytest
from pyspark.sql import functions as F

from trisieve.functions import keys, similarity
from trisieve.functions import text as t
from trisieve.operators import quality


def one(spark, column, *values):
    names = ["a", "b", "c", "d", "e"][: len(values)]
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return df.select(column.alias("x")).first().x


a, b, c = F.col("a"), F.col("b"), F.col("c")


@pytest.mark.parametrize(
    ("change", "value", "want"),
    [
        (t.collapse, "  a \t b\x1c c\n", "a b c"), (t.strip, "　 a  b \n", "a  b"), (t.nfc_collapsed, "ế  x", "ế x"), (t.nfc_stripped, " é  x ", "é  x"),
        (t.folded, "STRASSE straße", "strasse strasse"), (t.casefold, "ẞß", "ssss"), (t.plain_text, "a&amp;b​c\x07  d", "a&b c d"), (t.unescaped, "&nbsp; a &lt;b&gt; ", "a <b>"),
        (t.compatible, "ﬁ  ２", "fi 2"), (t.text_key, "Đây, LÀ… ﬁ!", "đây là fi"), (t.anchor_key, " Cái GÌ  đây?! ", "cái gì đây"), (t.mended, "9Â½ cafÃ©", "9½ café"), (t.mended, "đúng É", "đúng É"),
        (t.drop_artifacts, "a [[b]]  c", "a b c"), (t.drop_artifacts, "a  c", "a  c"), (t.document_kind, "Theo NGHỊ ĐỊNH 5 và Luật", "Nghị định"), (t.document_kind, "Văn bản", None),
    ],
)
def test_normalisers(spark, change, value, want):
    assert one(spark, change(a), value) == want
    assert one(spark, change(a), None) is None


def test_wiki_profiles(spark):
    raw = "<!-- x -->Trang [[A|b]] và [[c]]<ref name=\"d\">e</ref> [[Tập tin:f.jpg|g]] {{h|{{i}}}} __NOTOC__ formula_12 \\alpha [3] &amp; j"
    assert one(spark, t.wiki_clean(a, "passage"), raw) == "Trang b và c & j"
    document = one(spark, t.wiki_clean(a, "document"), raw + " [[mở br>")
    assert "formula_12" in document and "__NOTOC__" not in document and "[[" not in document and "br>" not in document
    nested = "a {{1}} " * 5
    assert one(spark, t.wiki_clean(a, "chunk"), nested) == "a a a a a"


def test_shape(spark):
    assert one(spark, F.array_sort(t.word_set(a)), "Một một hai_2 – ba!") == ["ba", "hai_2", "một"]
    assert one(spark, F.array_sort(t.ascii_tokens(a, 1)), "Ab a ab12 é") == ["ab", "ab12"]
    assert one(spark, t.title_words(a), "The sông và Núi") == ["sông", "núi"]
    assert one(spark, t.title_words(a), None) == []
    assert one(spark, t.sentence_count(a), "Một. Hai! 3.5 ba? ") == 3
    assert one(spark, t.suffix_prefix_overlap(a, b, 48, 3), "xx một hai", "một hai ba") == 7
    assert one(spark, t.suffix_prefix_overlap(a, b, 48, 3), "xx ab", "ab yy") == 0
    assert one(spark, t.suffix_prefix_overlap(a, b, 48, 32), "ab", "ab") == 2
    assert one(spark, t.is_blank(a), " \t") and one(spark, t.is_blank(a), None)


def test_keys(spark):
    import hashlib

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert one(spark, keys.stable_id("hybrid_", a, b, c), "t", "s", "i") == "hybrid_" + sha("t\x1fs\x1fi")[:24]
    assert one(spark, keys.pair_hash(a, b, c), "S", "Ab", "Cß") == sha("S\x1fab\x1fcss")
    assert one(spark, keys.triplet_hash(a, b, c), "x", "y", "z") == hashlib.md5(b"x\x1ey\x1ez").hexdigest()
    assert one(spark, keys.short_sha1("l_", a, b), "x", "y") == "l_" + hashlib.sha1(b"x|y").hexdigest()[:24]
    assert one(spark, keys.numbered("n_", F.lit(12345678), 6), "x") == "n_12345678" and one(spark, keys.numbered("n_", F.lit(7), 6), "x") == "n_000007"


def test_similarity(spark):
    assert one(spark, similarity.overlap_ratio(a, b), "what is red x", "Red is") == pytest.approx(2 / 3)
    assert one(spark, similarity.overlap_ratio(a, b), "é", "x") == 0
    assert one(spark, similarity.jaccard(a, b), "một hai", "hai ba") == pytest.approx(1 / 3)
    assert one(spark, similarity.closest_topic(["văn hóa", "y tế"])(a), "Văn  hóaa") == "văn hóa"
    assert one(spark, similarity.closest_topic(["văn hóa"])(a), "thể thao") is None
    df = spark.createDataFrame([(1, " https://sen.example/ "), (2, "Sen"), (3, "khác"), (4, None)], "i int, s string")
    known = similarity.canonical_name(df, "s", ["Sen | https://sen.example"], "n").orderBy("i").collect()
    assert [r.n for r in known] == ["Sen | https://sen.example"] * 2 + [None] * 2


LONG, OTHER = "một đoạn văn đủ dài để qua bộ lọc " * 3, "an other passage that is long enough for it " * 3


@pytest.mark.parametrize(
    ("values", "want"),
    [
        (("is it fine", LONG, OTHER), None), (("is", LONG, OTHER), "anchor_length"), (("is it fine", "x", OTHER), "positive_length"), (("is it fine", LONG, "x"), "negative_length"), (("có gì thế đấy"[:2] + "ờờờờ", LONG, OTHER), None),
        (("ờờờờờờ", LONG, OTHER), "anchor_not_english"), (("is it \x07", LONG, OTHER), "control_character"), ((LONG, LONG.upper(), OTHER), "degenerate_triplet"), (("is it fine", LONG, LONG), "degenerate_triplet"), (("is it fine", None, OTHER), None),
    ],
)
def test_reject_reasons(spark, values, want):
    assert one(spark, quality.reject_reason(a, b, c), *values) == want


def test_export_reasons(spark):
    reason = quality.export_reason(a, b, c)
    assert one(spark, reason, "câu hỏi đủ dài", LONG, OTHER) is None
    assert one(spark, reason, "câu hỏi đủ dài", LONG, None) == "blank_field"
    assert one(spark, quality.export_reason(a, b, c, keep_pairs=True), "câu hỏi đủ dài", LONG, None) is None
    assert one(spark, reason, "XÃ NÀO ĐỦ DÀI", LONG, OTHER) == "encoding_artifact"
    assert one(spark, quality.export_reason(a, b, c, strict_encoding=False), "XÃ NÀO ĐỦ DÀI", LONG, OTHER) is None
    assert one(spark, reason, "câu hỏi đủ dài", LONG, LONG.upper()) == "degenerate_triplet"


def test_small_filters(spark):
    assert one(spark, quality.clean_pair(a, b), "một câu hỏi có [[ ở đây", LONG) is False
    assert one(spark, quality.clean_pair(a, b), "một câu hỏi bình thường", LONG) is True
    assert one(spark, quality.quality_mask(a, b, c), "câu hỏi dài", LONG, None) is None
    assert one(spark, quality.distinct_triple(a, b, c), LONG, OTHER, LONG) is False
    assert one(spark, quality.valid_pair(a, b), None, "x") is False
    assert one(spark, quality.title_question(a, b), " Sông ", "x") == '"Sông" là gì?' and one(spark, quality.title_question(a, b, False), "Sông", "x") == "x"
    assert one(spark, quality.is_block_page(a), "<script>captcha</script>") is False and one(spark, quality.is_block_page(a), "Access Denied") is True
    assert one(spark, quality.quality_issues(a, b, c), "[[", "{{ <b> �", "x") == 5
    assert one(spark, quality.mentions_title(a, b), " ", "x") == 0 and one(spark, quality.mentions_title(a, b), "ĐỎ", "màu đỏ") == 1
    assert one(spark, quality.chunk_index(a), "data_clean_0000001_0012") == 12 and one(spark, quality.chunk_index(a), "x") == 1_000_000
    science = quality.science_reason(F.lit("s"), F.lit("t"), a, b, c, F.lit("s"), F.lit("t"))
    assert one(spark, science, "một hai ba bốn năm", " ".join(f"w{i}" for i in range(30)) + ".", " ".join(f"v{i}" for i in range(30)) + ".") is None
    assert one(spark, science, "một hai", LONG, OTHER) == "anchor_length"
    assert unicodedata.is_normalized("NFC", one(spark, t.nfc(a), "é"))
