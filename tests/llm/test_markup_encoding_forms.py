import random
import re
import unicodedata

import pytest
import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trisieve.llm import p1_markup, p2_encoding, p4_forms, p5_pieces

SCHEMA = "data_id string, source string, anchor string, positive string, text string, host string, form string, rows int"


def rows(spark, values):
    return spark.createDataFrame([(*v, "x", "y", "z", 1) for v in values], SCHEMA)


MARKED = [
    "<p>một hai</p>", "a &amp; b", "&#7879;", "x <b>y</b>", "bị cắt <div class=", "# Tiêu đề\n\nchữ", "**đậm** chữ", "một ~~hai~~", "[chữ](https://a.example/1)",
    "- [x] việc", "> lời", "| a | b |\n|---|---|\n| 1 | 2 |", "[[Trang|chữ]] khác", "chữ]] còn", "{{mẫu|a=1}}", "''nghiêng''", "== Mục ==\nchữ", "__NOTOC__ chữ",
    r"\section{Mục} chữ", r"\(a_n \to 0\)", "$$x^2$$", r"xem~\cite{b1}", "```\nx = 1\n```", "dùng `kho.dem()` ở đó", "{| class=\"w\"\n|-\n! a\n| 1\n|}", "$x^2 + y^2 = r^2$",
]
ORDINARY = [
    "giá ($4118) và ($5)", "(x <= 7251)", "(5 < 8) và (9 > 2)", "(76 -> 213)", "(R&D) A & B", "(C#)", r"(C:\kho\tep)", "({140; 384})", "([1; 2])", "(| 9 |)", "(a_315) (ten_bien_2)", "(~86)", "(#90)",
    "(3728*) và (2 * 3)", "(2 ^ 9)", "(<< 42)", "xuống\ndòng\n\nđoạn", "", "   ", "và/hoặc 1/2", "AT&T; rồi",
]


@pytest.mark.parametrize("text", MARKED)
def test_markup_is_seen_and_gone(text):
    assert regex.search(p1_markup.SUSPECT, text)
    assert p1_markup.marks(text) > 0
    clean, pieces = p1_markup.extract(text)
    assert pieces > 0
    assert not re.search(r"</?\w+>|\*\*|\[\[|\{\{|&amp;|\\section|```", clean)


@pytest.mark.parametrize("text", ORDINARY)
def test_ordinary_signs_are_no_markup(text):
    assert p1_markup.marks(text) == 0
    assert p1_markup.extract(text)[1] == 0


def samples(pattern):
    return st.from_regex(pattern).filter(lambda x: "\x00" not in x)


@pytest.mark.parametrize("at", range(len(p1_markup.MARKS) + 1))
def test_gate_holds_all_that_the_patterns_count(at):
    pattern = [*p1_markup.MARKS, p1_markup.NAMED][at]

    @settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
    @given(samples(pattern))
    def check(text):
        if p1_markup.marks(text):
            assert regex.search(p1_markup.SUSPECT, text) and p1_markup.extract(text)[1]

    check()


@pytest.mark.parametrize("text", ['Bảng class="infobox" của tỉnh', 'href="https://a.example/b" xem', "! Tiêu đề cột", "\xa0- việc", "a\n: b"])
def test_gate_and_extraction_see_pieces_without_brackets(text):
    assert regex.search(p1_markup.SUSPECT, text)
    assert p1_markup.marks(text) and p1_markup.extract(text)[1]


KEPT = "Câu sau rất quan trọng."


@pytest.mark.parametrize("opened", ["<ref name=a>chú thích ", "<!-- ghi chú ", "{|", '{| class="a"', "{|\n| a\n| b\n", "<table>", "<table><tr><td>a", "<script>", '<div class="a">', "<pre>", "```", "<ul><li>", "{{mẫu|", "[[Trang|", "\\begin{align}", "$$", "<table><caption>x</caption>y</table>"])
def test_text_after_unclosed_markup_stays(opened):
    clean, pieces = p1_markup.extract(f"mở đầu {opened}\n\n{KEPT}")
    assert KEPT in clean and clean.startswith("mở đầu") and pieces


def test_text_of_tables_stays():
    clean = p1_markup.extract("<table>đầu<tr>lẻ<td>a<b>b</b></td><td>c</td></tr></table>")[0]
    assert clean.split() == ["đầu", "lẻ", "ab", "c"]
    assert p1_markup.extract("{|\nlời\n|-\n! a\n| b\n|}")[0].split() == ["lời", "a", "b"]


def test_structure_stays_visible():
    assert p1_markup.extract("<h2>Mục</h2><ul><li>một</li><li>hai</li></ul>")[0].split() == ["Mục", "•", "một", "•", "hai"]
    assert "1\t2" in p1_markup.extract("| a | b |\n|---|---|\n| 1 | 2 |")[0]
    assert "    let x = [1];" in p1_markup.extract("trước\n```js\nlet x = [1];\n```")[0]
    assert "(1)/(2) m v^2" in p1_markup.extract(r"\[E = \frac{1}{2} m v^{2}\]")[0]


def test_markup_operator_edges(spark):
    table = rows(spark, [("1", "h", None, "<b>x</b>"), ("2", None, "", "  "), ("3", "h", "abc", "<p>" + "dài " * 50_000 + "</p>"), ("3", "h", "abc", "abc")])
    got = p1_markup.clean_values(table, "data_id", "source", ["anchor", "positive"]).collect()
    assert len(got) == 7
    assert {(r.data_id, r.field_name) for r in got if r.marks} == {("1", "positive"), ("3", "positive")}
    assert p1_markup.clean_values(table.limit(0), "data_id", "source", ["anchor", "positive"]).count() == 0


def test_host_votes_drop_link_lists(spark):
    page = '<div class="nav{0}"><a href="/a">một hai ba</a> <a href="/b">bốn năm</a></div><div class="bai"><p>nội dung của bài {0}</p></div>'
    table = rows(spark, [(str(i), "h", "a", page.format(i)) for i in range(5)])
    got = p1_markup.clean_values(table, "data_id", "source", ["positive"]).collect()
    assert all("nội dung" in r.text and "bốn" not in r.text for r in got)
    # the same page at a host where that path holds text elsewhere: the votes decide, not the page
    text = '<div class="nav{0}"><p>một đoạn văn dài của trang</p></div>'
    other = rows(spark, [("x", "k", "a", page.format(0))] + [(str(i), "k", "a", text.format(i)) for i in range(9)])
    kept = {r.data_id: r.text for r in p1_markup.clean_values(other, "data_id", "source", ["positive"]).collect()}
    assert "bốn" in kept["x"] and "nội dung" in kept["x"]


def test_winning_parts_inside_losing_ones_stay():
    page = '<div class="a"><a href="x">liên kết</a><div class="b">chữ</div></div> sau'
    assert [p for p, _, _ in p1_markup.runs(page)] == ["div.a", "div.a/div.b", "div.a", ""]
    assert "".join(page[s:e] for _, s, e in p1_markup.runs(page)) == page
    assert p1_markup.extract(p1_markup.winning(page, {"div.a/div.b", ""}))[0].split() == ["chữ", "sau"]
    assert p1_markup.winning(page, set()) == page


GOOD = "Từ năm 1938, phòng khám hiện đại cung cấp điện năng"


@pytest.mark.parametrize("codec", ["latin-1", "cp437", "mac_roman", "cp850"])
def test_misread_utf8_comes_back(codec):
    assert p2_encoding.explain(GOOD.encode().decode(codec))[2] == GOOD


def test_chains_and_legacy_letters():
    once = "café của".encode().decode("cp1252")
    assert p2_encoding.explain(once.encode().decode("cp1252"))[2] == "café của"
    assert p2_encoding.explain("Tõ n¨m 2024, c¸nh ®ång")[2] == "Từ năm 2024, cánh đồng"
    assert p2_encoding.explain("Töø naêm 2008, khu röøng")[2] == "Từ năm 2008, khu rừng"
    assert p2_encoding.explain("đi�u ki�n")[::2] == ("lost", None)
    assert p2_encoding.explain("Москва гордая".encode().decode("latin-1"))[2] == "Москва гордая"
    assert p2_encoding.explain("bã¡o cã¡o")[2] == "báo cáo"


@pytest.mark.parametrize("text", [GOOD, GOOD.upper(), "“ÂNGORA – ÃO”", "crème brûlée, £40, ½ cup, 90 m², § 12", "Москва гордая", "BÃI BẠCH MẠCH. XÃ HẠ", "đã có… rồi", "“CHỢ XÃ”", "3 × 4"])
def test_right_texts_have_no_strong_evidence(text):
    chain, m, _ = p2_encoding.explain(text)
    assert m == 0 or p2_encoding.CHANCE[p2_encoding._kind(chain)][0] ** m > 1e-4


GATE = regex.compile(p2_encoding.suspicious())


@pytest.mark.parametrize("codec", p2_encoding.CODECS)
@pytest.mark.parametrize("change", [str, str.lower, str.upper])
def test_gate_passes_every_product_of_a_misreading(codec, change):
    if change is not str and codec not in p2_encoding.CASED:
        return
    table = p2_encoding._table(codec)
    letters = [chr(i) for i in range(0xA1, 0x530) if chr(i).isalpha()] + [chr(i) for i in range(0x1E00, 0x1F00)] + list("–—‘’“”…€₫中ก")
    for c in letters:
        for around in ("{}", "SCHR{}DINGER", "chữ {} chữ"):
            misread = around.format("".join(change(x) if len(change(x)) == 1 else x for x in (table.get(b, chr(b)) for b in c.encode())))
            if any(n for n in (p2_encoding.undo(misread, codec, v)[1] for v in (0, 1, 2))):
                assert GATE.search(misread), (c, misread)


def test_gate_passes_every_product_of_the_legacy_encodings():
    words = {w for w, _ in p2_encoding.legacy_products()}
    assert len(words) > 10_000 and all(GATE.search(w) for w in words)
    assert all(GATE.search(w) for w in ("caàn nhaèm", "hoùc", "toâi", "coù", "kÕt", "viÕt", "SCHRÃ–DINGER"))
    assert not any(GATE.search(w) for w in (GOOD, GOOD.upper(), "hoàn toàn, thuỷ quý – già khuỵu xoáy ngoằn giữa"))


def test_deep_chains_are_undone_whatever_their_depth():
    deep = "café của"
    for _ in range(5):
        deep = deep.encode().decode("latin-1")
    assert p2_encoding.explain(deep)[2] == "café của"


def test_weak_evidence_is_pooled_by_source_and_field(spark):
    weak, strong = "Sao n¨m 2024 đã mở cửa", "Tõ n¨m 2024, c¸nh ®ång réng"
    assert p2_encoding.evidence(weak)[0][:2] == ("tcvn3", 1)

    def found(others):
        table = rows(spark, [("w", "s", weak, None)] + [(str(i), "s", others[i % len(others)], None) for i in range(200)])
        return {r.data_id for r in p2_encoding.garbled_ids([("t", table, ["anchor"])]).collect()}

    assert "w" not in found([GOOD])  # the same value, decided by its source
    assert "w" in found([strong, "Sãng biÓn"])


def test_the_posterior_chooses_the_chain():
    for rare, common in (("utf8 cp1252", "utf8 cp1258"), ("utf8 cp1258", "utf8 cp1252")):
        model = p2_encoding.Model({"rates": {rare: 0.001, common: 0.2}, "chance": {"utf8": 1e-6}, "shown": {}, "miss": 0.02})
        chains, clean = model.posterior("utf8 cp1252,1,0;utf8 cp1258,1,0")
        assert max(chains, key=chains.get) == common and clean < 0.01


def test_encoding_operator_edges(spark):
    bad = GOOD.encode().decode("latin-1")
    table = rows(spark, [("1", "S", bad, GOOD), ("1", "s", bad, GOOD), ("2", None, None, ""), ("3", "s", GOOD * 2000, bad)] + [(f"g{i}", "s", GOOD, "café – £40") for i in range(30)])
    got = p2_encoding.garbled_values([("t", table, ["anchor", "positive"])]).collect()
    assert sorted((r.data_id, r.field_name, r.repaired) for r in got) == [("1", "anchor", GOOD), ("3", "positive", GOOD)]
    assert p2_encoding.garbled_values([("t", table.limit(0), ["anchor"])]).count() == 0


def test_forms_and_pairs(spark):
    plain = "Xưởng dệt cao ở Đông Hà năm 2001"
    same = [unicodedata.normalize("NFD", plain), plain.replace("o", "\u03bf"), plain.replace(" ", "\u2009"), plain + "\u200b", plain.replace("2001", "２００１"), plain.replace("Đ", "Ð")]
    other = [plain.lower(), plain.replace("ở", "o"), plain + "²", "“" + plain + "”", plain.replace("Hà", "Ha"), plain.replace("dệt", "dệt –"), None, "", " "]
    table = rows(spark, [(f"{i:02}", "s", v, None) for i, v in enumerate([plain, *same, *other, plain, "  " + plain.replace(" ", "\n")])])
    pairs = p4_forms.look_alike_pairs(table, "data_id", ["anchor", "positive"]).collect()
    stored = {f"{i:02}": i for i in range(7)} | {"16": 0, "17": 0}
    want = {(a, b) for a in stored for b in stored if a < b and stored[a] != stored[b]}
    assert {(r.data_id_a, r.data_id_b) for r in pairs} == want
    assert p4_forms.look_alike_pairs(table.limit(0), "data_id", ["anchor"]).count() == 0


def test_pieces_round_trip():
    rng = random.Random(4)
    parts = ["# Mục\n", "đoạn văn. ", "- việc\n", "\n\n", "chữ ", "e\u0301", "👩\u200d🌾", "x" * 60, ", "]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 120)))
        found = p5_pieces.pieces(text, 100, 20)
        assert "".join(text[s:e] for _, s, e in found) == text
        assert all(e - b <= 100 and 0 <= s - b <= 20 for b, s, e in found)
    text = "một hai ba. " * 100
    assert all(text[s:e].rstrip().endswith(".") for _, s, e in p5_pieces.pieces(text))


def kinds(text):
    return [(n.kind, text[n.start : n.end]) for n in p5_pieces.blocks(text, 0, len(text))]


def test_lists_tables_and_code_are_nodes():
    text = "# Mục\nđoạn một\nđoạn hai\n\n- a\n  - b\n- c\n\n| x | y |\n| 1 | 2 |\n\n```\nm = 1\n\nn = 2\n```\nsau\n{|\n| 1\n|}\n<pre>\nq\n</pre>\ncuối"
    assert [k for k, _ in kinds(text)] == ["heading", "paragraph", "list", "table", "code", "paragraph", "table", "code", "paragraph"]
    assert "".join(x for _, x in kinds(text)) == text
    nested = "- một\n  - hai\n  - ba\n- bốn\n"
    assert [nested[n.start : n.end] for n in p5_pieces.items(nested, 0, len(nested))] == ["- một\n  - hai\n  - ba\n", "- bốn\n"]
    assert kinds("```\nmở mà không đóng")[0][0] == "code"


def test_siblings_stay_together_before_they_are_cut():
    lines = "".join(f"- việc số {i} của nhóm\n" for i in range(4))
    code = "```\n" + "x = 1\n" * 8 + "```\n"
    text = "lời đầu khá dài. " * 4 + "\n\n" + lines + "\n" + code + "\n" + "lời cuối. " * 6
    got = [text[s:e] for s, e in p5_pieces.cut(text, 130, 20)]
    assert "".join(got) == text and all(len(x) <= 130 for x in got)
    assert any(code in x for x in got) and any(lines in x for x in got)
    long_list = "".join(f"- mục {i} dài hơn một chút\n" for i in range(20))
    assert all(x.startswith("- ") for x in (long_list[s:e] for s, e in p5_pieces.cut(long_list, 130, 20)))
    heading = "# Đầu mục\n" + "một câu. " * 40
    assert heading[slice(*p5_pieces.cut(heading, 130, 20)[0])].startswith("# Đầu mục\nmột câu.")


def test_split_operator_edges(spark):
    table = rows(spark, [("1", "s", "a", "ngắn"), ("2", "s", "a", None), ("3", "s", "a", ""), ("4", "s", "a", "x" * 30_000), ("5", "s", "a", "y" * 384), ("6", "s", "a", "y" * 385)])
    got = p5_pieces.split_items(table, "data_id", "positive").collect()
    assert {r.data_id for r in got} == {"1", "3", "4", "5", "6"}
    assert max(len(r.text) for r in got) <= 384
    whole = "".join(r.text[r.overlap :] for r in sorted((r for r in got if r.data_id == "4"), key=lambda r: r.piece_no))
    assert whole == "x" * 30_000
    assert sorted(r.data_id for r in p5_pieces.oversized_ids(table, "data_id", "positive").collect()) == ["4", "6"]
    assert p5_pieces.split_items(table.limit(0), "data_id", "positive").count() == 0
