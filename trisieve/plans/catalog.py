"""All queries over the reference tables and, where SQL can say the same, their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisieve.functions import encoding
from trisieve.functions import keys as k
from trisieve.functions import similarity as sim
from trisieve.functions import text as t
from trisieve.operators import chunk, dedup, evaluate, lexical, parse, quality, select, upsert, vectors
from trisieve.plans import pipelines
from trisieve.runtime import read
from trisieve.sources import readers
from trisieve.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


c = F.col

# --- pieces of oracle SQL ---------------------------------------------------------------------

WS = r"[\t-\r \x{85}\p{Z}\x{1c}-\x{1f}]+"


def s_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def s_fold(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def s_words(x: str) -> str:
    return rf"list_distinct(regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}\p{{M}}_]+'))"


def s_ascii(x: str, longer: int = 0) -> str:
    return f"list_distinct(list_filter(regexp_extract_all({s_fold(x)}, '[a-z0-9]+'), lambda w: length(w) > {longer}))"


S_OVERLAP = "coalesce(len(list_intersect({q}, {p}))::DOUBLE / nullif(len({q}), 0), 0)".format(q=s_ascii("anchor", 1), p=s_ascii("hard_negative"))
S_FILLED = "trim(anchor) <> '' AND trim(positive) <> ''"


# --- scans, samples and pages -----------------------------------------------------------------


@query("project_filter", "SELECT data_id, source, length(anchor) AS anchor_chars FROM general WHERE source = 'Luật thường thức'")
def _(s, d):
    return readers.parquet(s, f"{d}/general.parquet", ["data_id", "source", "anchor"]).filter(c("source") == "Luật thường thức").select("data_id", "source", F.length("anchor").cast("bigint").alias("anchor_chars"))


@query("page_keyset", "SELECT data_id, anchor FROM general WHERE data_id > 'data_clean_0000100_0000' ORDER BY data_id LIMIT 50")
def _(s, d):
    return select.page(read(s, d, "general").select("data_id", "anchor"), "data_id", "data_clean_0000100_0000", 50)


@query("hash_sample", "SELECT data_id FROM general WHERE ('0x' || substr(md5(data_id), 1, 8))::BIGINT / 4294967296.0 < 0.15")
def _(s, d):
    return select.hash_sample(read(s, d, "general"), "data_id", 0.15).select("data_id")


@query("even_groups", """
    WITH n AS (SELECT data_id, row_number() OVER (ORDER BY data_id) - 1 AS row_index FROM general),
         g AS (SELECT *, row_index // 100 AS row_group FROM n), m AS (SELECT max(row_group) + 1 AS n FROM g),
         p AS (SELECT DISTINCT round_even(i * (n - 1) / 4.0, 0)::BIGINT AS row_group FROM m, range(5) r(i))
    SELECT data_id, row_index, row_group FROM g JOIN p USING (row_group)""")  # fmt: skip
def _(s, d):
    return select.even_groups(read(s, d, "general").select("data_id"), ["data_id"], 100, 5).select("data_id", "row_index", "row_group")


@query("json_lines", """
    WITH l AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS line FROM events)
    SELECT event_id, CASE WHEN json_valid(line) THEN (line ->> '$.k')::BIGINT END AS k, NOT json_valid(line) AS broken FROM l""")  # fmt: skip
def _(s, d):
    lines = read(s, d, "events").select("event_id", F.when(c("event_id") % 50 == 0, F.substring(c("props"), F.lit(1), F.length("props") - 1)).otherwise(c("props")).alias("line"))
    out = readers.parsed_lines(lines, "line", T.StructType([T.StructField("k", T.LongType())]))
    return out.select("event_id", "k", c("error").isNotNull().alias("broken"))


@query("alias_columns", "SELECT data_id AS query_id, anchor AS text FROM triplet")
def _(s, d):
    return readers.resolve_columns(read(s, d, "triplet"), {"query_id": ["query-id", "query_id", "data_id"], "text": ["question", "anchor", "text"]})


@query("shuffled_ids", "SELECT data_id, row_number() OVER (ORDER BY sha256('42' || chr(31) || data_id), data_id) AS place FROM triplet")
def _(s, d):
    keyed = read(s, d, "triplet").select("data_id", k.digest(F.lit("42"), c("data_id")).alias("h"))
    return select.row_index(keyed, ["h", "data_id"], "place").select("data_id", (c("place") + 1).alias("place"))


@query("first_rows_by_key", "SELECT data_id, source FROM triplet ORDER BY data_id LIMIT 100")
def _(s, d):
    return select.page(read(s, d, "triplet").select("data_id", "source"), "data_id", None, 100)


# --- filters and reasons ----------------------------------------------------------------------


@query("valid_pairs", f"SELECT data_id FROM general WHERE {S_FILLED}")
def _(s, d):
    return read(s, d, "general").filter(quality.valid_pair(c("anchor"), c("positive"))).select("data_id")


S_MASK = "length(anchor) BETWEEN 8 AND 384 AND length(positive) BETWEEN 80 AND 2000 AND length(hard_negative) BETWEEN 80 AND 2000 AND positive <> hard_negative AND anchor <> positive"


@query("quality_mask", f"SELECT data_id FROM general WHERE {S_MASK}")
def _(s, d):
    return read(s, d, "general").filter(quality.quality_mask(c("anchor"), c("positive"), c("hard_negative"))).select("data_id")


@query("distinct_triples", f"SELECT data_id FROM triplet WHERE {S_MASK} AND anchor <> hard_negative")
def _(s, d):
    return read(s, d, "triplet").filter(quality.distinct_triple(c("anchor"), c("positive"), c("hard_negative"))).select("data_id")


@query("loose_triplets", f"SELECT data_id, source_row_index FROM english_rag_qa_triplet WHERE length(anchor) BETWEEN 3 AND 1000 AND length(positive) BETWEEN 20 AND 12000 AND length(hard_negative) BETWEEN 20 AND 12000 AND {s_fold('anchor')} <> {s_fold('positive')} AND {s_fold('positive')} <> {s_fold('hard_negative')}")
def _(s, d):
    return read(s, d, "english_rag_qa_triplet").filter(quality.loose_triplet(c("anchor"), c("positive"), c("hard_negative"))).select("data_id", "source_row_index")


S_REJECT = f"""CASE WHEN length(anchor) NOT BETWEEN 5 AND 700 THEN 'anchor_length' WHEN length(positive) NOT BETWEEN 60 AND 9000 THEN 'positive_length'
    WHEN length(hard_negative) NOT BETWEEN 60 AND 9000 THEN 'negative_length' WHEN NOT regexp_matches(anchor, '[A-Za-z]') THEN 'anchor_not_english'
    WHEN regexp_matches(anchor || positive || hard_negative, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x{{9f}}]') THEN 'control_character'
    WHEN {s_fold('anchor')} = {s_fold('positive')} OR {s_fold('positive')} = {s_fold('hard_negative')} THEN 'degenerate_triplet' END"""


@query("reject_reasons", f"SELECT source, coalesce({S_REJECT}, 'accepted') AS reason, count(*) AS rows FROM english_rag_qa_triplet GROUP BY ALL")
def _(s, d):
    return quality.reason_counts(read(s, d, "english_rag_qa_triplet").withColumn("r", quality.reject_reason(c("anchor"), c("positive"), c("hard_negative"))), "r", "source")


S_BLANK = lambda x: f"({x} IS NULL OR {s_collapse(x)} = '')"


@query("export_reasons", f"""
    SELECT coalesce(CASE WHEN {S_BLANK('anchor')} OR {S_BLANK('positive')} OR {S_BLANK('hard_negative')} THEN 'blank_field'
        WHEN length(anchor) NOT BETWEEN 8 AND 384 THEN 'anchor_length' WHEN length(positive) NOT BETWEEN 80 AND 2000 OR length(hard_negative) NOT BETWEEN 80 AND 2000 THEN 'passage_length'
        WHEN regexp_matches(concat_ws(' ', anchor, positive, hard_negative), '\\x{{FFFD}}|Ã') THEN 'encoding_artifact'
        WHEN {s_fold('anchor')} = {s_fold('positive')} OR {s_fold('anchor')} = {s_fold('hard_negative')} OR {s_fold('positive')} = {s_fold('hard_negative')} THEN 'degenerate_triplet' END, 'accepted') AS reason, count(*) AS rows
    FROM triplet GROUP BY ALL""")  # fmt: skip
def _(s, d):
    return quality.reason_counts(read(s, d, "triplet").withColumn("r", quality.export_reason(c("anchor"), c("positive"), c("hard_negative"))), "r")


@query("hybrid_clean_pairs", f"SELECT data_id FROM general WHERE length(anchor) BETWEEN 15 AND 420 AND length(positive) BETWEEN 80 AND 1400 AND {s_fold('anchor')} <> {s_fold('positive')} AND NOT regexp_matches(anchor || chr(10) || positive, '\\x{{FFFD}}|\\[\\[|\\]\\]|\\{{\\{{|\\}}\\}}')")
def _(s, d):
    return read(s, d, "general").filter(quality.clean_pair(c("anchor"), c("positive"))).select("data_id")


@query("science_reasons")
def _(s, d):
    rows = sim.canonical_name(read(s, d, "triplet"), "source", ["Khoa học tuyển chọn | khoahoc.example", "Bách khoa Sen"], "known", keep_unknown=False)
    topic = sim.closest_topic(["khoa học", "văn hóa", "pháp luật", "đời sống"])(c("domain"))
    return quality.reason_counts(rows.withColumn("r", quality.science_reason(c("source"), c("domain"), c("anchor"), c("positive"), c("hard_negative"), c("known"), topic)), "r")


S_LEGAL = f"""trim(title) <> '' AND trim(anchor) <> '' AND trim(positive) <> '' AND length({s_collapse('anchor')}) BETWEEN 20 AND 420
    AND length({s_collapse('positive')}) BETWEEN 120 AND 900 AND anchor <> positive AND NOT regexp_matches(anchor || positive, '\\x{{FFFD}}|\\[\\[|\\{{\\{{')"""


@query("legal_candidates", f"SELECT data_id FROM general WHERE {S_LEGAL}")
def _(s, d):
    return read(s, d, "general").filter(quality.legal_pair(c("title"), c("anchor"), c("positive"))).select("data_id")


@query("per_source_rules", "SELECT data_id FROM general WHERE (source <> 'Bách khoa Sen' OR trim(title) <> '') AND (source <> 'Đọc hiểu Lam' OR anchor LIKE '%?')")
def _(s, d):
    return read(s, d, "general").filter(quality.per_source(c("source"), {"Bách khoa Sen": F.trim("title") != "", "Đọc hiểu Lam": c("anchor").like("%?")})).select("data_id")


@query("null_safe_exclude", "SELECT data_id FROM general WHERE source IS DISTINCT FROM 'Bách khoa Sen'")
def _(s, d):
    return read(s, d, "general").filter(~c("source").eqNullSafe("Bách khoa Sen")).select("data_id")


@query("plain_exclude", "SELECT data_id FROM general WHERE source <> 'Bách khoa Sen'")
def _(s, d):
    return read(s, d, "general").filter(c("source") != "Bách khoa Sen").select("data_id")


S_ALL3 = "(anchor || positive || hard_negative)"
S_ISSUES = f"""((CASE WHEN contains({S_ALL3}, '�') THEN 1 ELSE 0 END) + (CASE WHEN contains({S_ALL3}, '[[') THEN 1 ELSE 0 END) + (CASE WHEN contains({S_ALL3}, '{{{{') THEN 1 ELSE 0 END)
    + (CASE WHEN regexp_matches({S_ALL3}, '<[^>]+>|formula_[0-9]') THEN 1 ELSE 0 END) + (CASE WHEN length(trim(positive)) NOT BETWEEN 80 AND 384 THEN 1 ELSE 0 END))"""
S_MENTIONS = "(CASE WHEN trim(title) <> '' AND contains(lower(positive), lower(trim(title))) THEN 1 ELSE 0 END)"
S_ENDS = "(CASE WHEN regexp_matches(rtrim(positive), '[{}]$') THEN 1 ELSE 0 END)"
S_CHUNK = "(CASE WHEN regexp_matches(data_id, '^data_clean_[0-9]{7}_[0-9]{4}$') THEN right(data_id, 4)::INTEGER ELSE 1000000 END)"


@query("quality_features", f"SELECT data_id, {S_ISSUES} AS quality_issues, {S_MENTIONS} AS mentions_title, {S_ENDS.format('.!?…')} AS ends_sentence, {S_CHUNK} AS chunk_index FROM general")
def _(s, d):
    return read(s, d, "general").select("data_id", quality.quality_issues(c("anchor"), c("positive"), c("hard_negative")).alias("quality_issues"), quality.mentions_title(c("title"), c("positive")).alias("mentions_title"), quality.ends_sentence(c("positive")).alias("ends_sentence"), quality.chunk_index(c("data_id")).alias("chunk_index"))


@query("block_pages", "SELECT doc_id FROM documents WHERE contains(lower(CASE WHEN doc_id % 97 = 0 THEN text || ' Access DENIED' ELSE text || ' captcha' END), 'access denied')")
def _(s, d):
    page = F.when(c("doc_id") % 97 == 0, F.concat("text", F.lit(" Access DENIED"))).otherwise(F.concat("text", F.lit(" captcha")))
    return read(s, d, "documents").filter(quality.is_block_page(page)).select("doc_id")


@query("role_prefixes", "SELECT data_id, 'query: ' || anchor AS query, 'passage: ' || positive AS passage FROM general")
def _(s, d):
    q, p = quality.with_role(c("anchor"), c("positive"))
    return read(s, d, "general").select("data_id", q.alias("query"), p.alias("passage"))


@query("pair_triplet_split", f"SELECT CASE WHEN {S_BLANK('hard_negative')} THEN 'pair' ELSE 'triplet' END AS kind, count(*) AS rows FROM triplet GROUP BY ALL")
def _(s, d):
    pairs, triplets = quality.split_pairs(read(s, d, "triplet"), "hard_negative")
    return pairs.withColumn("kind", F.lit("pair")).unionByName(triplets.withColumn("kind", F.lit("triplet"))).groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))


@query("title_questions", f"""SELECT data_id, coalesce(CASE WHEN trim(title) <> '' THEN '"' || trim(title) || '" là gì?' END, CASE WHEN NOT {S_BLANK('anchor')} THEN anchor END) AS question FROM general""")
def _(s, d):
    return read(s, d, "general").select("data_id", quality.title_question(c("title"), c("anchor")).alias("question"))


# --- keys, normalisers and shape --------------------------------------------------------------

S_PAIR = f"sha256(source || chr(31) || {s_fold('anchor')} || chr(31) || {s_fold('positive')})"


@query("hash_ids", f"""
    SELECT data_id, {S_PAIR} AS pair_hash, 'hybrid_' || substr(sha256('triplet' || chr(31) || source || chr(31) || data_id), 1, 24) AS hybrid_id,
        md5(concat_ws(chr(30), anchor, positive, hard_negative)) AS triplet_hash, 'legal_002_' || substr(sha1(anchor || '|' || positive), 1, 24) AS legal_id,
        'q_' || substr(sha256(anchor), 1, 20) AS query_id, sha256({s_fold("concat_ws(chr(31), anchor, positive, hard_negative)")}) AS folded
    FROM triplet""")  # fmt: skip
def _(s, d):
    return read(s, d, "triplet").select(
        "data_id", k.pair_hash(c("source"), c("anchor"), c("positive")).alias("pair_hash"), k.stable_id("hybrid_", F.lit("triplet"), c("source"), c("data_id")).alias("hybrid_id"), k.triplet_hash(c("anchor"), c("positive"), c("hard_negative")).alias("triplet_hash"),
        k.short_sha1("legal_002_", c("anchor"), c("positive")).alias("legal_id"), k.stable_id("q_", c("anchor"), length=20).alias("query_id"), k.folded_digest(c("anchor"), c("positive"), c("hard_negative")).alias("folded"),
    )


@query("provenance_rows", "SELECT 'hybrid_' || substr(sha256('general' || chr(31) || source || chr(31) || data_id), 1, 24) AS data_id, 'train' AS split, 'general' AS source_table, source, data_id AS source_data_id, nullif(trim(title), '') AS title FROM general WHERE source IS NOT NULL")
def _(s, d):
    return read(s, d, "general").filter("source IS NOT NULL").select(k.stable_id("hybrid_", F.lit("general"), c("source"), c("data_id")).alias("data_id"), F.lit("train").alias("split"), F.lit("general").alias("source_table"), "source", c("data_id").alias("source_data_id"), F.nullif(F.trim("title"), F.lit("")).alias("title"))


@query("collapsed_texts", f"SELECT data_id, md5({s_collapse('positive')}) AS positive FROM general")
def _(s, d):
    return read(s, d, "general").select("data_id", F.md5(t.collapse(c("positive"))).alias("positive"))


@query("nfc_texts", f"SELECT data_id, md5({s_collapse('nfc_normalize(anchor)')}) AS anchor FROM triplet")
def _(s, d):
    return read(s, d, "triplet").select("data_id", F.md5(t.nfc_collapsed(c("anchor"))).alias("anchor"))


@query("anchor_keys", f"SELECT data_id, md5(rtrim({s_collapse(s_fold('anchor'))}, '?.!')) AS anchor_key FROM general")
def _(s, d):
    return read(s, d, "general").select("data_id", F.md5(t.anchor_key(c("anchor"))).alias("anchor_key"))


S_ARTIFACT = r"\x{FFFD}|\[\[|\]\]|\{\{|\}\}|(?i:formula_\d+)|[\x00-\x08\x0b\x0c\x0e-\x1f]"


@query("artifact_clean", f"SELECT data_id, md5(CASE WHEN regexp_matches(positive, '{S_ARTIFACT}') THEN {s_collapse(f"nfc_normalize(regexp_replace(positive, '{S_ARTIFACT}', ' ', 'g'))")} ELSE positive END) AS positive FROM general")
def _(s, d):
    return read(s, d, "general").select("data_id", F.md5(t.drop_artifacts(c("positive"))).alias("positive"))


S_CASEFOLDED = f"SELECT data_id, md5(replace({s_fold('anchor')}, 'ς', 'σ')) AS text FROM triplet"
S_NFC_STRIPPED = f"SELECT data_id, md5(regexp_replace(nfc_normalize(positive), '^{WS}|{WS}$', '', 'g')) AS text FROM triplet"


def _udf_query(name: str, table: str, column: str, change):
    @query(name, {"casefolded_texts": S_CASEFOLDED, "nfc_stripped_texts": S_NFC_STRIPPED}.get(name))
    def _(s, d):
        return read(s, d, table).select("data_id", F.md5(change(c(column))).alias("text"))


for _name, _table, _column, _change in [
    ("wiki_clean_passage", "general", "positive", lambda x: t.wiki_clean(x, "passage")), ("wiki_clean_document", "general", "positive", lambda x: t.wiki_clean(x, "document")), ("wiki_clean_chunk", "general", "positive", lambda x: t.wiki_clean(x, "chunk")),
    ("plain_texts", "triplet", "positive", t.plain_text), ("unescaped_texts", "general", "anchor", t.unescaped), ("compatible_texts", "triplet", "anchor", t.compatible), ("text_keys", "triplet", "anchor", t.text_key), ("mended_texts", "english_rag_qa_triplet", "positive", t.mended),
    ("nfc_stripped_texts", "triplet", "positive", t.nfc_stripped), ("casefolded_texts", "triplet", "anchor", t.casefold), ("html_visible_text", "general", "positive", parse.visible_text),
]:
    _udf_query(_name, _table, _column, _change)


S_KINDS = "Bộ luật|Pháp lệnh|Nghị định|Thông tư|Quyết định|Nghị quyết|Chỉ thị|Công văn|Luật"


@query("document_kinds", f"""
    WITH x AS (SELECT doc_id, list_extract(['LUẬT ', 'nghị Định ', 'Về thông tư ', 'Văn ', 'bộ luật '], (doc_id % 5)::INTEGER + 1) || coalesce(title, '') AS title FROM documents),
         y AS (SELECT doc_id, regexp_extract(title, '(?i)(?:^|[^\\p{{L}}])({S_KINDS})(?:$|[^\\p{{L}}])', 1) AS kind FROM x)
    SELECT doc_id, CASE WHEN kind <> '' THEN upper(kind[1]) || lower(kind[2:]) END AS kind FROM y""")  # fmt: skip
def _(s, d):
    made = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("LUẬT ", "nghị Định ", "Về thông tư ", "Văn ", "bộ luật ")]), (c("doc_id") % 5 + 1).cast("int")), F.coalesce("title", F.lit("")))
    return read(s, d, "documents").select("doc_id", t.document_kind(made).alias("kind"))


@query("text_shape", rf"""
    SELECT doc_id, len(list_filter(regexp_split_to_array(trim(text), '[.!?]+(?:[ \t-\r]+|$)'), lambda x: trim(x) <> '')) AS sentences, len({s_words('text')}) AS words, len({s_ascii('text', 1)}) AS ascii_words,
        regexp_matches(text, '\p{{L}}') AS letters FROM documents WHERE text IS NOT NULL""")  # fmt: skip
def _(s, d):
    text = c("text")
    return read(s, d, "documents").filter("text IS NOT NULL").select("doc_id", t.sentence_count(text).cast("bigint").alias("sentences"), F.size(t.word_set(text)).cast("bigint").alias("words"), F.size(t.ascii_tokens(text, 1)).cast("bigint").alias("ascii_words"), t.has_letter(text).alias("letters"))


@query("lexical_scores", f"""
    SELECT data_id, source_row_index, round({S_OVERLAP}, 6) AS overlap, round(len(list_intersect({s_words('positive')}, {s_words('hard_negative')}))::DOUBLE / greatest(len(list_distinct(list_concat({s_words('positive')}, {s_words('hard_negative')}))), 1), 6) AS jaccard
    FROM english_rag_qa_triplet""")  # fmt: skip
def _(s, d):
    return read(s, d, "english_rag_qa_triplet").select("data_id", "source_row_index", F.round(sim.overlap_ratio(c("anchor"), c("hard_negative")), 6).alias("overlap"), F.round(sim.jaccard(c("positive"), c("hard_negative")), 6).alias("jaccard"))


@query("canonical_sources", """
    SELECT data_id, CASE WHEN lower(trim(source)) = 'bách khoa sen | sen.example' OR contains(lower(trim(source)), 'bách khoa sen') OR contains(lower(trim(source)), 'sen.example') THEN 'Bách khoa Sen | sen.example'
        WHEN contains(lower(trim(source)), 'luật') THEN 'Luật' ELSE trim(source) END AS canonical FROM general""")  # fmt: skip
def _(s, d):
    return sim.canonical_name(read(s, d, "general").select("data_id", "source"), "source", ["Bách khoa Sen | sen.example", "Luật"], "canonical", keep_unknown=True).select("data_id", "canonical")


@query("close_topics")
def _(s, d):
    return read(s, d, "general").select("data_id", sim.closest_topic(["văn hóa", "khoa học", "pháp luật", "y tế", "đời sống"])(c("topic")).alias("topic"))


@query("ordered_union", "SELECT data_id, array_to_string(list_filter([topic, domain, source], lambda x, i: x IS NOT NULL AND list_position([topic, domain, source], x) = i), '|') AS labels FROM triplet")
def _(s, d):
    labels = sim.ordered_union(F.array("topic"), F.array("domain", "source"))
    return read(s, d, "triplet").select("data_id", F.array_join(labels, "|").alias("labels"))


@query("adaptive_sample", "WITH h AS (SELECT data_id, source, ('0x' || substr(md5(data_id), 1, 8))::BIGINT / 4294967296.0 AS f, count(*) OVER () AS n FROM general) SELECT data_id, source FROM h WHERE f < least(100, greatest(5, 60000.0 / n)) / 100 ORDER BY f, data_id LIMIT 300")
def _(s, d):
    return select.adaptive_sample(read(s, d, "general").select("data_id", "source"), "data_id", 300)


@query("answerable_qrels", "SELECT data_id, source_data_id FROM rag_qa_hybrid_train WHERE NOT is_synthetic AND quality_score > 0")
def _(s, d):
    return read(s, d, "rag_qa_hybrid_train").filter(~c("is_synthetic") & (c("quality_score") > 0)).select("data_id", "source_data_id")


# --- merges -----------------------------------------------------------------------------------


@query("insert_if_absent", """
    WITH u AS (SELECT data_id, source_row_index, source FROM english_rag_qa_triplet QUALIFY row_number() OVER (PARTITION BY data_id ORDER BY source_row_index, source) = 1)
    SELECT data_id, source_row_index, source_row_index % 3 <> 0 AS inserted FROM u""")  # fmt: skip
def _(s, d):
    rows = read(s, d, "english_rag_qa_triplet").select("data_id", "source_row_index", "source")
    order = [c("source_row_index"), c("source")]
    old = select.best_per_key(rows.filter("source_row_index % 3 = 0"), ["data_id"], order)
    return upsert.insert_if_absent(old, rows, "data_id", order).select("data_id", "source_row_index", "inserted")


@query("best_negative_upsert", f"""
    WITH x AS (SELECT data_id, {S_PAIR} AS pair_hash, round({S_OVERLAP}, 6) AS score, source_row_index % 2 AS part FROM english_rag_qa_triplet)
    SELECT pair_hash, data_id, score FROM x QUALIFY row_number() OVER (PARTITION BY pair_hash ORDER BY score DESC, part, data_id) = 1""")  # fmt: skip
def _(s, d):
    rows = read(s, d, "english_rag_qa_triplet").select(k.pair_hash(c("source"), c("anchor"), c("positive")).alias("pair_hash"), "data_id", F.round(sim.overlap_ratio(c("anchor"), c("hard_negative")), 6).alias("score"), (c("source_row_index") % 2).alias("part"))
    old, new = rows.filter("part = 0").drop("part"), rows.filter("part = 1").drop("part")
    return upsert.upsert_better(old, new, "pair_hash", "score", [c("data_id")])


@query("field_upsert", """
    WITH o AS (SELECT data_id, topic, title FROM triplet WHERE length(data_id) % 2 = 0 OR source = 'Bách khoa Sen'), n AS (SELECT data_id, upper(topic) AS topic, NULL::VARCHAR AS title FROM triplet WHERE source <> 'Cẩm nang EN')
    SELECT coalesce(n.data_id, o.data_id) AS data_id, coalesce(n.topic, o.topic) AS topic, coalesce(n.title, o.title) AS title FROM o FULL JOIN n ON o.data_id = n.data_id""")  # fmt: skip
def _(s, d):
    rows = read(s, d, "triplet").select("data_id", "topic", "title", "source")
    old = rows.filter("length(data_id) % 2 = 0 OR source = 'Bách khoa Sen'")
    new = rows.filter("source <> 'Cẩm nang EN'").select("data_id", F.upper("topic").alias("topic"), F.lit(None).cast("string").alias("title"))
    return upsert.upsert_fields(old, new, "data_id", ["topic", "title"])


@query("changed_rows", f"SELECT data_id, {s_collapse('positive')} IS DISTINCT FROM positive AS changed, length({s_collapse('positive')}) AS chars FROM general")
def _(s, d):
    return upsert.update_changed(read(s, d, "general").select("data_id", "positive"), "positive", t.collapse(c("positive"))).select("data_id", "changed", F.length("positive").cast("bigint").alias("chars"))


@query("pending_rows", "SELECT data_id FROM general WHERE data_id NOT IN (SELECT source_data_id FROM rag_qa_hybrid_train WHERE source_table = 'general' AND quality_score >= 80)")
def _(s, d):
    status = read(s, d, "rag_qa_hybrid_train").filter("source_table = 'general'").select(c("source_data_id").alias("data_id"), "quality_score")
    return upsert.pending(read(s, d, "general").select("data_id"), status, "data_id", c("quality_score") >= 80)


# --- selection --------------------------------------------------------------------------------

S_TOP = f"""
    WITH scored AS (SELECT data_id, source, title, topic, anchor, positive, hard_negative, {S_CHUNK} AS chunk_index, {S_ISSUES} AS quality_issues, {S_MENTIONS} AS mentions_title, {S_ENDS.format('.!?…')} AS ends_sentence,
            md5(concat_ws(chr(30), anchor, positive, hard_negative)) AS h FROM general
        WHERE {S_FILLED} AND trim(hard_negative) <> '' AND anchor <> positive AND anchor <> hard_negative AND positive <> hard_negative),
    d AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY h ORDER BY quality_issues, chunk_index, data_id) = 1),
    r AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY quality_issues, chunk_index, mentions_title DESC, ends_sentence DESC, md5(data_id)) AS anchor_rank FROM d)"""


@query("top_quality_export", S_TOP + """
    SELECT data_id, source, title, topic, quality_issues, CAST(anchor_rank AS INTEGER) AS anchor_rank, chunk_index, mentions_title, ends_sentence FROM r
    ORDER BY CASE WHEN anchor_rank = 1 THEN 0 ELSE 1 END, CASE WHEN anchor_rank = 1 THEN 0 ELSE quality_issues END, anchor_rank, chunk_index, mentions_title DESC, ends_sentence DESC, md5(data_id) LIMIT 500""")  # fmt: skip
def _(s, d):
    return select.top_quality(read(s, d, "general"), 500).select("data_id", "source", "title", "topic", "quality_issues", "anchor_rank", "chunk_index", "mentions_title", "ends_sentence")


@query("triplet_md5_dedup", "SELECT data_id FROM triplet QUALIFY row_number() OVER (PARTITION BY md5(concat_ws(chr(30), anchor, positive, hard_negative)) ORDER BY data_id) = 1")
def _(s, d):
    return dedup.by_digest(read(s, d, "triplet"), k.triplet_hash(c("anchor"), c("positive"), c("hard_negative")), [c("data_id")]).select("data_id")


S_PER_TITLE = f"""
    WITH q AS (SELECT data_id, source, title, anchor, positive, {S_MENTIONS} AS tip, {S_ENDS.format('.!…')} AS es, md5(data_id) AS so FROM general WHERE {S_LEGAL}),
    p AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY anchor, positive ORDER BY tip DESC, es DESC, so) = 1),
    o AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY lower({s_collapse('title')}) ORDER BY CASE WHEN source = 'Luật thường thức' THEN 0 ELSE 1 END, tip DESC, es DESC, abs(length(positive) - 450), so) = 1)"""


@query("one_per_title", S_PER_TITLE + " SELECT data_id, title FROM o")
def _(s, d):
    return pipelines.one_per_title(read(s, d, "general"), "Luật thường thức").select("data_id", "title")


@query("legal_two_tier", S_PER_TITLE + """,
    a AS (SELECT data_id, source FROM o WHERE source = 'Luật thường thức' ORDER BY md5(title), so LIMIT 150),
    b AS (SELECT data_id, source FROM o WHERE source = 'Bách khoa Sen' ORDER BY md5(title), so LIMIT greatest(150 - (SELECT count(*) FROM a), 0))
    SELECT * FROM a UNION ALL SELECT * FROM b""")  # fmt: skip
def _(s, d):
    rows = pipelines.one_per_title(read(s, d, "general"), "Luật thường thức")
    return select.two_tier(rows, "source", "Luật thường thức", "Bách khoa Sen", [F.md5("title"), c("stable_order")], 150).select("data_id", "source")


@query("quota_select", """
    WITH p AS (SELECT * FROM triplet QUALIFY row_number() OVER (PARTITION BY anchor, positive ORDER BY md5(data_id)) = 1), q(source, quota) AS (VALUES ('Truy vấn dịch', 120), ('Bách khoa Sen', 40), ('Hỏi đáp luật', 500))
    SELECT data_id, source FROM p JOIN q USING (source) QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(data_id)) <= any_value(quota) OVER (PARTITION BY source)""")  # fmt: skip
def _(s, d):
    rows = select.best_per_key(read(s, d, "triplet"), ["anchor", "positive"], [F.md5("data_id")])
    quota = s.createDataFrame([("Truy vấn dịch", 120), ("Bách khoa Sen", 40), ("Hỏi đáp luật", 500)], "source string, quota int")
    return select.quota_select(rows, quota, "source", [F.md5("data_id")]).select("data_id", "source")


@query("exact_quotas", """
    WITH p AS (SELECT * FROM triplet QUALIFY row_number() OVER (PARTITION BY anchor, positive ORDER BY md5(data_id)) = 1), q(source, quota) AS (VALUES ('Truy vấn dịch', 10), ('Bách khoa Sen', 5), ('Hỏi đáp luật', 5))
    SELECT data_id, source FROM p JOIN q USING (source) QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(data_id)) <= any_value(quota) OVER (PARTITION BY source)""")  # fmt: skip
def _(s, d):
    rows = select.best_per_key(read(s, d, "triplet"), ["anchor", "positive"], [F.md5("data_id")])
    quota = s.createDataFrame([("Truy vấn dịch", 10), ("Bách khoa Sen", 5), ("Hỏi đáp luật", 5)], "source string, quota int")
    return select.exact_quotas(rows, quota, "source", [F.md5("data_id")], [["data_id"], ["anchor", "positive"]]).select("data_id", "source")


@query("first_rows_per_source", f"SELECT data_id, source FROM general WHERE {S_MASK} AND source IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY data_id) <= 30")
def _(s, d):
    rows = read(s, d, "general").filter(quality.quality_mask(c("anchor"), c("positive"), c("hard_negative")) & c("source").isNotNull())
    return select.top_per_key(rows, ["source"], [c("data_id")], 30).select("data_id", "source")


@query("mined_pairs", """
    WITH l AS (SELECT l_orderkey AS qid, l_partkey AS id, l_extendedprice AS score, l_linenumber FROM lineitem),
    pos AS (SELECT qid, arg_max(id, (score, -id)) AS positive_doc_id, max(score) AS positive_score FROM l WHERE l_linenumber <= 2 GROUP BY qid),
    neg AS (SELECT n.qid, arg_max(n.id, (n.score, -n.id)) AS hard_negative_doc_id, max(n.score) AS hard_negative_score FROM l n LEFT JOIN l p ON n.qid = p.qid AND n.id = p.id AND p.l_linenumber <= 2 WHERE n.l_linenumber > 2 AND p.id IS NULL GROUP BY n.qid),
    q AS (SELECT DISTINCT qid FROM l)
    SELECT qid, positive_doc_id, positive_score, hard_negative_doc_id, hard_negative_score,
        CASE WHEN positive_doc_id IS NULL THEN 'no_positive' WHEN hard_negative_doc_id IS NULL THEN 'no_negative' WHEN hard_negative_score <= 50000 THEN 'below_threshold' END AS reason
    FROM q LEFT JOIN pos USING (qid) LEFT JOIN neg USING (qid)""")  # fmt: skip
def _(s, d):
    line = read(s, d, "lineitem").select(c("l_orderkey").alias("qid"), c("l_partkey").alias("id"), c("l_extendedprice").alias("score"), (c("l_linenumber") <= 2).alias("p"))
    pick = lambda which, x: F.collect_list(F.when(c("p") == which, F.struct("id", "score")))[x]
    lists = line.groupBy("qid").agg(pick(True, "id").alias("pos"), pick(True, "score").alias("pos_score"), pick(False, "id").alias("neg"), pick(False, "score").alias("neg_score"))
    return select.mined_pairs(lists, 50_000)


# --- dedup ------------------------------------------------------------------------------------


@query("casefold_digest_dedup", f"SELECT data_id FROM english_rag_qa_triplet QUALIFY row_number() OVER (PARTITION BY sha256({s_fold("concat_ws(chr(31), anchor, positive, hard_negative)")}) ORDER BY source, data_id) = 1")
def _(s, d):
    return dedup.by_digest(read(s, d, "english_rag_qa_triplet"), k.folded_digest(c("anchor"), c("positive"), c("hard_negative")), [c("source"), c("data_id")]).select("data_id")


S_KEY = lambda x: f"rtrim({s_collapse(s_fold(x))}, '?.!')"


@query("unseen_anchors", f"SELECT data_id FROM general WHERE {S_KEY('anchor')} NOT IN (SELECT {S_KEY('anchor')} FROM rag_qa_hybrid_train) QUALIFY row_number() OVER (PARTITION BY {S_KEY('anchor')} ORDER BY data_id) = 1")
def _(s, d):
    return dedup.unseen(read(s, d, "general"), t.anchor_key(c("anchor")), read(s, d, "rag_qa_hybrid_train"), t.anchor_key(c("anchor")), [c("data_id")]).select("data_id")


@query("duplicate_groups", f"SELECT md5({s_fold('anchor')} || chr(31) || {s_fold('positive')}) AS pair, count(*) AS rows FROM rag_qa_hybrid_train GROUP BY ALL HAVING count(*) > 1")
def _(s, d):
    pairs = read(s, d, "rag_qa_hybrid_train").select(F.md5(F.concat_ws("\x1f", t.folded(c("anchor")), t.folded(c("positive")))).alias("pair"))
    return dedup.duplicate_groups(pairs, ["pair"])


@query("greedy_three_key")
def _(s, d):
    return dedup.greedy_keep(read(s, d, "triplet"), "data_id", {"anchor": t.text_key(c("anchor")), "positive": t.text_key(c("positive")), "negative": t.text_key(c("hard_negative"))}, ["source"]).select("data_id", "keep")


S_SIMILAR = """
    WITH RECURSIVE r AS (SELECT coalesce('=' || domain, '') AS g, data_id, anchor, min(data_id) OVER (PARTITION BY domain, anchor) AS rep FROM triplet),
    n AS (SELECT g, count(*) AS total FROM r GROUP BY g), c AS (SELECT g, rep AS id, anchor, count(*) AS copies FROM r GROUP BY ALL),
    w AS (SELECT g, id, copies, unnest(list_transform(list_filter(regexp_split_to_array(lower(anchor), '[\\t-\\r \\x{85}\\p{Z}\\x{1c}-\\x{1f}]+'), lambda x: x <> ''), lambda x: ' ' || x || ' ')) AS word FROM c),
    gr AS (SELECT g, id, copies, substr(word, i, k) AS gram, count(*) AS tf FROM w, range(3, 6) s(k), range(1, 60) p(i) WHERE i + k - 1 <= length(word) GROUP BY ALL),
    t AS (SELECT g, gram, ln((1 + any_value(total)) / (1.0 + sum(copies))) + 1 AS idf FROM gr JOIN n USING (g) GROUP BY g, gram HAVING sum(copies) >= 2),
    v AS (SELECT g, id, gram, tf * idf AS w FROM gr JOIN t USING (g, gram)), l AS (SELECT g, id, sqrt(sum(w * w)) AS len FROM v GROUP BY g, id),
    u AS (SELECT g, id, gram, w / len AS w FROM v JOIN l USING (g, id)),
    x AS (SELECT a.id AS a, b.id AS b, sum(a.w * b.w) AS similarity FROM u a JOIN u b ON a.g = b.g AND a.gram = b.gram AND a.id < b.id GROUP BY ALL HAVING sum(a.w * b.w) >= 0.95)"""


@query("near_dup_pairs", S_SIMILAR + " SELECT a, b, round(similarity, 4) AS similarity FROM x")
def _(s, d):
    return dedup.similar_texts(read(s, d, "triplet"), "data_id", "anchor", group_col="domain").select("a", "b", F.round("similarity", 4).alias("similarity"))


@query("near_dup_neighbours", S_SIMILAR + """,
    y AS (SELECT a, b, similarity FROM x UNION ALL SELECT b, a, similarity FROM x), k AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) <= 10)
    SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM k""")  # fmt: skip
def _(s, d):
    return dedup.similar_texts(read(s, d, "triplet"), "data_id", "anchor", group_col="domain", neighbours=10).select("a", "b")


@query("near_dup_components", S_SIMILAR + """,
    e AS (SELECT a, b FROM x UNION SELECT b, a FROM x UNION SELECT rep, rep FROM r), h(n, m) AS (SELECT a, b FROM e UNION SELECT h.n, e.b FROM h JOIN e ON h.m = e.a), o AS (SELECT n, min(m) AS component FROM h GROUP BY n)
    SELECT data_id, component, component = data_id AS keep FROM r JOIN o ON r.rep = o.n""")  # fmt: skip
def _(s, d):
    return dedup.near_duplicates(read(s, d, "triplet"), "data_id", "anchor", group_col="domain").select("data_id", "component", "keep")


@query("components", "SELECT 'o' || o_orderkey AS node, 'c' || o_custkey AS component FROM orders UNION SELECT 'c' || o_custkey, 'c' || o_custkey FROM orders")
def _(s, d):
    edges = read(s, d, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("a"), F.concat(F.lit("c"), "o_custkey").alias("b"))
    return dedup.components(edges)


# --- chunks -----------------------------------------------------------------------------------


@query("chunk_fixed", "SELECT doc_id, i AS k, md5(substr(text, (i * 336 + 1)::BIGINT, 384)) AS chunk FROM documents, range(100000) r(i) WHERE text <> '' AND i * 336 < length(text)")
def _(s, d):
    return read(s, d, "documents").select("doc_id", F.posexplode(chunk.fixed_windows(c("text"))).alias("k", "chunk")).select("doc_id", c("k").cast("bigint").alias("k"), F.md5("chunk").alias("chunk"))


S_STRIP = lambda x: f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


@query("chunk_stride", f"""
    WITH b AS (SELECT doc_id, {S_STRIP('text')} AS body FROM documents WHERE {S_STRIP('text')} <> '')
    SELECT doc_id, (i * 1050)::INTEGER AS start, md5({S_STRIP('substr(body, (i * 1050 + 1)::BIGINT, 1200)')}) AS chunk FROM b, range(40000) r(i) WHERE (i = 0 OR i * 1050 + 150 < length(body)) AND {S_STRIP('substr(body, (i * 1050 + 1)::BIGINT, 1200)')} <> ''""")  # fmt: skip
def _(s, d):
    return read(s, d, "documents").select("doc_id", F.explode(chunk.stride_windows(c("text"))).alias("x")).select("doc_id", "x.start", F.md5("x.text").alias("chunk"))


@query("answer_windows", """
    WITH a AS (SELECT doc_id, text, unnest([0, length(text) // 2, length(text) - 5]) AS pos FROM documents WHERE length(text) > 20)
    SELECT DISTINCT doc_id, least(greatest(pos - 150, 0), greatest(length(text) - 1200, 0))::INTEGER AS start, md5(substr(text, least(greatest(pos - 150, 0), greatest(length(text) - 1200, 0)) + 1, 1200)) AS chunk FROM a""")  # fmt: skip
def _(s, d):
    n = F.length("text")
    starts = F.array(F.lit(0), F.floor(n / 2).cast("int"), n - 5)
    docs = read(s, d, "documents").filter(n > 20)
    return docs.select("doc_id", F.explode(chunk.answer_windows(c("text"), starts, F.array(*[F.lit("x")] * 3))).alias("x")).select("doc_id", "x.start", F.md5("x.text").alias("chunk"))


@query("chunk_boundary", f"""
    WITH RECURSIVE b AS (SELECT doc_id, {S_STRIP('text')} AS body FROM documents WHERE text IS NOT NULL),
    e(doc_id, body, start, stop) AS (
        SELECT doc_id, body, 0, 0 FROM b WHERE body <> ''
        UNION ALL
        SELECT doc_id, body, CASE WHEN stop = 0 THEN 0 ELSE greatest(stop - 48, start + 1) END AS s,
            CASE WHEN s + 384 >= length(body) THEN length(body) WHEN regexp_matches(substr(body, s + 1, 384), '\\n|\\. |; ') AND length(regexp_extract(substr(body, s + 1, 384), '(?s)^(.*)(?:\\n|\\. |; )', 1)) >= 192
                THEN s + length(regexp_extract(substr(body, s + 1, 384), '(?s)^(.*)(?:\\n|\\. |; )', 1)) + 1 ELSE s + 384 END
        FROM e WHERE stop < length(body))
    SELECT doc_id, start::INTEGER AS start, md5({S_STRIP('substr(body, start + 1, stop - start)')}) AS chunk FROM e WHERE stop > 0 AND {S_STRIP('substr(body, start + 1, stop - start)')} <> ''""")  # fmt: skip
def _(s, d):
    return read(s, d, "documents").select("doc_id", F.explode(chunk.boundary_chunks()(c("text"))).alias("x")).select("doc_id", "x.start", F.md5("x.text").alias("chunk"))


@query("chunk_words")
def _(s, d):
    return read(s, d, "documents").select("doc_id", F.posexplode(chunk.word_chunks()(c("text"))).alias("k", "chunk")).select("doc_id", "k", F.md5("chunk").alias("chunk"))


@query("lossless_pieces", "SELECT doc_id, md5(text) AS whole FROM documents WHERE text IS NOT NULL")
def _(s, d):
    return read(s, d, "documents").filter("text IS NOT NULL").select("doc_id", F.md5(F.array_join(chunk.lossless_pieces(500)(c("text")), "")).alias("whole"))


S_ISLANDS = """
    WITH k AS (SELECT *, coalesce(CASE WHEN trim(title) <> '' THEN title END, chr(1) || data_id) AS key, row_number() OVER (ORDER BY source NULLS LAST, data_id) - 1 AS n FROM general),
    g AS (SELECT *, CASE WHEN lag(key) OVER w IS NOT DISTINCT FROM key AND lag(source) OVER w IS NOT DISTINCT FROM source THEN NULL ELSE n END AS start FROM k WINDOW w AS (ORDER BY n)),
    i AS (SELECT *, max(start) OVER (ORDER BY n) AS island FROM g)"""


@query("islands", S_ISLANDS + " SELECT data_id, source, island FROM i")
def _(s, d):
    return chunk.islands(read(s, d, "general"), ["title"], ["data_id"], ["source"], blank_key="title").select("data_id", "source", "island")


@query("stitched_documents", S_ISLANDS + """,
    p AS (SELECT source, island, data_id, coalesce(positive, '') AS cur, lag(coalesce(positive, '')) OVER (PARTITION BY source, island ORDER BY data_id) AS prev FROM i),
    m AS (SELECT *, least(48, length(prev), length(cur)) AS most FROM p),
    n AS (SELECT *, coalesce(list_max(list_filter(range(1, 49), lambda n: n <= most AND n >= least(32, most) AND right(prev, n) = left(cur, n))), 0) AS cut FROM m)
    SELECT source, island, md5(string_agg(substr(cur, 1 + CASE WHEN prev IS NULL THEN 0 ELSE cut END), '' ORDER BY data_id)) AS document, count(*) AS chunks FROM n GROUP BY source, island""")  # fmt: skip
def _(s, d):
    rows = chunk.islands(read(s, d, "general"), ["title"], ["data_id"], ["source"], blank_key="title")
    return chunk.stitch(rows, ["source", "island"], ["data_id"], "positive").select("source", "island", F.md5("document").alias("document"), "chunks")


@query("best_chunk", f"""
    WITH b AS (SELECT data_id, title, {s_words("anchor || ' ' || coalesce(topic, '')")} AS wanted, {S_STRIP('positive')} AS body FROM general WHERE {S_STRIP('positive')} <> ''),
    w AS (SELECT data_id, wanted, title, (i * 150)::INTEGER AS start, {S_STRIP('substr(body, (i * 150 + 1)::BIGINT, 200)')} AS piece FROM b, range(2000) r(i) WHERE (i = 0 OR i * 150 + 50 < length(body))),
    z AS (SELECT data_id, start, len(wanted) AS n, len(list_intersect(wanted, {s_words("concat_ws(' ', title, piece)")})) AS hits FROM w WHERE piece <> '')
    SELECT data_id, start FROM z QUALIFY row_number() OVER (PARTITION BY data_id ORDER BY hits::DOUBLE / greatest(n, 1) DESC, hits DESC, start) = 1""")  # fmt: skip
def _(s, d):
    wanted = t.word_set(F.concat(c("anchor"), F.lit(" "), F.coalesce("topic", F.lit(""))))
    return chunk.best_chunks(read(s, d, "general"), "data_id", chunk.stride_windows(c("positive"), 200, 50), wanted, c("title")).select("data_id", "start")


@query("title_children", "SELECT title, row_number() OVER (PARTITION BY title ORDER BY data_id) - 1 AS k, data_id FROM general")
def _(s, d):
    rows = read(s, d, "general").select("title", "data_id").filter("data_id IS NOT NULL")
    return select.numbered(rows, "title", ["data_id"], "k").select("title", "k", "data_id")


# --- joins and leakage ------------------------------------------------------------------------


@query("resolved_qrels", """
    WITH q AS (SELECT data_id AS query_id, source_data_id AS corpus_id FROM rag_qa_hybrid_train)
    SELECT CASE WHEN h.data_id IS NOT NULL AND g.data_id IS NOT NULL THEN 'ok' WHEN h.data_id IS NOT NULL THEN 'no_passage' WHEN g.data_id IS NOT NULL THEN 'no_query' ELSE 'neither' END AS state, count(*) AS rows
    FROM q LEFT JOIN (SELECT data_id FROM rag_qa_hybrid_train WHERE split = 'train') h ON q.query_id = h.data_id LEFT JOIN general g ON q.corpus_id = g.data_id GROUP BY ALL""")  # fmt: skip
def _(s, d):
    hybrid = read(s, d, "rag_qa_hybrid_train")
    qrels = hybrid.select(c("data_id").alias("query_id"), c("source_data_id").alias("corpus_id"), F.lit(1).alias("score"))
    queries = hybrid.filter("split = 'train'").select(c("data_id").alias("query_id"), c("anchor").alias("text"))
    corpus = read(s, d, "general").select(c("data_id").alias("corpus_id"), c("positive").alias("text"))
    return evaluate.resolve_qrels(qrels, queries, corpus).groupBy("state").agg(F.count(F.lit(1)).alias("rows"))


@query("attached_indices", """
    SELECT l_orderkey AS qid, l_linenumber, o_custkey AS query_row_index, a.p_size::BIGINT AS positive_row_index, b.p_size::BIGINT AS hard_negative_row_index, o_custkey IS NOT NULL AND a.p_size IS NOT NULL AND b.p_size IS NOT NULL AS mapped
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part a ON l_partkey = a.p_partkey LEFT JOIN part b ON l_suppkey * 30 = b.p_partkey""")  # fmt: skip
def _(s, d):
    rows = read(s, d, "lineitem").select(c("l_orderkey").alias("qid"), "l_linenumber", c("l_partkey").alias("positive_doc_id"), (c("l_suppkey") * 30).alias("hard_negative_doc_id"))
    queries = read(s, d, "orders").select(c("o_orderkey").alias("id"), c("o_custkey").alias("row_index"))
    corpus = read(s, d, "part").select(c("p_partkey").alias("id"), c("p_size").cast("bigint").alias("row_index"))
    return evaluate.attach_indices(rows, queries, corpus).select("qid", "l_linenumber", "query_row_index", "positive_row_index", "hard_negative_row_index", "mapped")


S_NORM = s_fold(s_collapse("anchor"))


@query("without_leaks", f"SELECT data_id FROM rag_qa_hybrid_train WHERE split <> 'train' AND {S_NORM} NOT IN (SELECT {S_NORM} FROM rag_qa_hybrid_train WHERE split = 'train')")
def _(s, d):
    rows = read(s, d, "rag_qa_hybrid_train")
    key = t.folded(t.collapse(c("anchor")))
    return evaluate.without_leaks(rows.filter("split <> 'train'"), key, rows.filter("split = 'train'"), key).select("data_id")


@query("leaked_rows", f"SELECT split, count(*) AS rows FROM rag_qa_hybrid_train WHERE split <> 'train' AND {S_NORM} IN (SELECT {S_NORM} FROM rag_qa_hybrid_train WHERE split = 'train') GROUP BY split")
def _(s, d):
    rows = read(s, d, "rag_qa_hybrid_train")
    key = t.folded(t.collapse(c("anchor")))
    return evaluate.leaked(rows.filter("split <> 'train'"), key, rows.filter("split = 'train'"), key).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


S_POSTED = f"""
    WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, doc_id, title, text, substr(text, 1, 200) AS passage FROM documents WHERE text <> '' AND title IS NOT NULL),
    p AS (SELECT idx, title, unnest(list_filter({s_words('title')}, lambda w: NOT list_contains({t.STOP_WORDS!r}, w))) AS token FROM d),
    q AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY idx) - 1 AS pos FROM p),
    x AS (SELECT a.idx, b.idx AS other, count(*) AS score FROM q a JOIN q b ON a.token = b.token AND abs(a.pos - b.pos) <= 20 AND a.idx <> b.idx AND a.title <> b.title GROUP BY ALL)"""


def _titled(s, d):
    return read(s, d, "documents").filter("text <> '' AND title IS NOT NULL").withColumn("passage", F.substring("text", 1, 200))


@query("posting_band_join", S_POSTED + " SELECT idx, other, score FROM x")
def _(s, d):
    docs = select.row_index(_titled(s, d).select("doc_id", "title"), ["doc_id"], "idx")
    return lexical.candidates(lexical.postings(docs))


@query("lexical_negatives", S_POSTED + """,
    n AS (SELECT count(*) AS n FROM d),
    c AS (SELECT idx, other, 0 AS tier, -score AS a, abs(idx - other) AS b, other AS e FROM x UNION ALL
          SELECT d.idx, (d.idx + r.i) % n.n, 1, r.i, 0, 0 FROM d, n, range(1, 101) r(i) WHERE r.i < n.n),
    u AS (SELECT c.idx, c.tier, c.a, c.b, c.e, o.doc_id AS negative_id FROM c JOIN d o ON c.other = o.idx JOIN d s ON c.idx = s.idx WHERE o.title <> s.title AND NOT contains(s.text, o.passage) AND o.passage <> ''),
    f AS (SELECT idx, negative_id FROM u QUALIFY row_number() OVER (PARTITION BY idx ORDER BY tier, a, b, e) = 1)
    SELECT d.doc_id AS id, f.negative_id FROM d LEFT JOIN f USING (idx)""")  # fmt: skip
def _(s, d):
    return lexical.lexical_negatives(_titled(s, d), "doc_id", "title", "text", "passage").select("id", "negative_id")


@query("encoded_texts", """
    WITH t AS (SELECT data_id, 'passage: ' || positive AS x FROM general WHERE positive IS NOT NULL), v AS (SELECT data_id, length(x)::DOUBLE AS a, (length(x) - length(replace(x, ' ', '')))::DOUBLE AS b FROM t)
    SELECT data_id, round(a / sqrt(a * a + b * b), 4) AS first, round(b / sqrt(a * a + b * b), 4) AS second FROM v""")  # fmt: skip
def _(s, d):
    shape = lambda texts: [[len(x), x.count(" ")] for x in texts]  # noqa: E731 - stands in for a model
    out = encoding.encode(read(s, d, "general").select("data_id", "positive"), "positive", "passage", shape)
    return out.filter("vec IS NOT NULL").select("data_id", F.round(c("vec")[0].cast("double"), 4).alias("first"), F.round(c("vec")[1].cast("double"), 4).alias("second"))


# --- vectors ----------------------------------------------------------------------------------

S_DOT = "list_dot_product(q.v, x.v) / sqrt(list_dot_product(q.v, q.v)) / sqrt(list_dot_product(x.v, x.v))"
S_TOPK = f"""
    WITH x AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), q AS (SELECT id AS query_id, v FROM x WHERE id % 100 = 0),
    k AS (SELECT query_id, id, round({S_DOT}, 10) AS score FROM q, x QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 16)"""


def _embedded(s, d):
    corpus = vectors.usable(read(s, d, "embeddings"), "vec_id", "embedding", 64)
    return corpus.filter("id % 100 = 0"), corpus


@query("dense_exact", S_TOPK + " SELECT query_id, id, round(score, 6) AS score FROM k")
def _(s, d):
    return vectors.exact_top_k(*_embedded(s, d)).select("query_id", "id", F.round("score", 6).alias("score"))


@query("dense_negatives", S_TOPK + """,
    t AS (SELECT doc_id AS id, text FROM documents), a AS (SELECT query_id, (SELECT text FROM documents WHERE doc_id = query_id + 1) AS positive FROM q)
    SELECT k.query_id, arg_min(k.id, (-k.score, k.id)) AS negative_id FROM k JOIN t ON k.id = t.id JOIN a ON k.query_id = a.query_id WHERE k.id <> k.query_id AND trim(t.text) <> '' AND t.text <> a.positive GROUP BY k.query_id""")  # fmt: skip
def _(s, d):
    queries, corpus = _embedded(s, d)
    docs = read(s, d, "documents")
    anchors = docs.select((c("doc_id") - 1).alias("query_id"), c("text").alias("positive"))
    return vectors.hard_negatives(vectors.exact_top_k(queries, corpus), docs.select(c("doc_id").alias("id"), "text"), anchors).select("query_id", "negative_id")


@query("dense_ivf")
def _(s, d):
    return vectors.ivf_top_k(*_embedded(s, d)).select("query_id", "id", "rank")


@query("cosine_rows", "WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), f AS (SELECT *, lead(v) OVER (PARTITION BY label ORDER BY vec_id) AS w FROM e) SELECT vec_id, round(list_dot_product(v, w) / sqrt(list_dot_product(v, v)) / sqrt(list_dot_product(w, w)), 6) AS cosine FROM f WHERE w IS NOT NULL")
def _(s, d):
    from pyspark.sql import Window

    rows = read(s, d, "embeddings").withColumn("w", F.lead("embedding").over(Window.partitionBy("label").orderBy("vec_id"))).filter("w IS NOT NULL")
    return rows.select("vec_id", F.round(sim.cosine(c("embedding"), c("w")), 6).alias("cosine"))


S_RANKS = """
    WITH x AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings), q AS (SELECT * FROM x WHERE id % 100 = 0),
    g AS (SELECT q.id AS query_id, min(k.id) AS id FROM q JOIN x k ON q.label = k.label AND q.id <> k.id GROUP BY q.id),
    z AS (SELECT q.id AS query_id, k.id, round(list_dot_product(q.v, k.v) / sqrt(list_dot_product(q.v, q.v)) / sqrt(list_dot_product(k.v, k.v)), 10) AS score FROM q JOIN x k ON q.id <> k.id),
    o AS (SELECT query_id, score AS s FROM z JOIN g USING (query_id, id)),
    r AS (SELECT o.query_id, 1 + count(*) FILTER (z.score > o.s) AS rank FROM o JOIN z USING (query_id) GROUP BY ALL)"""


def _ranks(s, d):
    rows = read(s, d, "embeddings")
    usable = vectors.usable(rows, "vec_id", "embedding", 64).join(rows.select(c("vec_id").alias("id"), "label"), "id")
    queries = usable.filter("id % 100 = 0")
    # the first other vector of the query's label: the label's first, or its second for the first itself
    first = usable.groupBy("label").agg(F.min("id").alias("first"))
    second = usable.join(first, "label").filter(c("id") > c("first")).groupBy("label").agg(F.min("id").alias("second"))
    positives = queries.select(c("id").alias("query_id"), "label").join(first, "label").join(second, "label", "left")
    positives = positives.select("query_id", F.when(c("query_id") == c("first"), c("second")).otherwise(c("first")).alias("id")).filter("id IS NOT NULL")
    return vectors.ranks(queries.select("id", "vec"), usable.select("id", "vec"), positives, own=False)


@query("query_ranks", S_RANKS + " SELECT query_id, rank, round(CASE WHEN rank <= 10 THEN 1.0 / rank ELSE 0 END, 6)::DOUBLE AS reciprocal_rank_at_10 FROM r")
def _(s, d):
    return evaluate.per_query_rank(_ranks(s, d)).withColumn("reciprocal_rank_at_10", F.round("reciprocal_rank_at_10", 6))


@query("retrieval_metrics", S_RANKS + """
    SELECT count(*) AS queries, round(avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_10, round(avg(CASE WHEN rank <= 10 THEN 1.0::DOUBLE / rank ELSE 0.0 END), 6) AS mrr_at_10,
        round(avg(CASE WHEN rank <= 10 THEN 1.0 / log2(rank + 1.0) ELSE 0.0 END), 6) AS ndcg_at_10, round(avg(rank), 6) AS mean_rank, round(median(rank), 6) AS median_rank FROM r""")  # fmt: skip
def _(s, d):
    out = evaluate.retrieval_metrics(_ranks(s, d))
    return out.select("queries", *[F.round(x, 6).alias(x) for x in ("recall_at_10", "mrr_at_10", "ndcg_at_10", "mean_rank", "median_rank")])


# --- profiles and expectations ----------------------------------------------------------------


@query("counts_by_source", "SELECT source, task_type, count(*) AS rows FROM rag_qa_hybrid_train GROUP BY ALL")
def _(s, d):
    return read(s, d, "rag_qa_hybrid_train").groupBy("source", "task_type").agg(F.count(F.lit(1)).alias("rows"))


@query("filtered_profile", "SELECT count(*) AS rows, count(DISTINCT source) AS sources, count(*) FILTER (trim(positive) = '') AS blank, count(*) FILTER (positive IS NULL) AS missing, min(length(positive)) AS shortest, round(avg(length(positive)), 2) AS mean, max(length(positive)) AS longest FROM general")
def _(s, d):
    n = F.length("positive").cast("bigint")
    return read(s, d, "general").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("source").alias("sources"), F.count_if(F.trim("positive") == "").alias("blank"), F.count_if(c("positive").isNull()).alias("missing"), F.min(n).alias("shortest"), F.round(F.avg(n), 2).alias("mean"), F.max(n).alias("longest"))


@query("source_profile", "SELECT source, count(*) AS rows, count(DISTINCT title) AS titles, sum((hard_negative IS NOT NULL)::INTEGER)::BIGINT AS negatives FROM general GROUP BY source ORDER BY rows DESC")
def _(s, d):
    return read(s, d, "general").groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("title").alias("titles"), F.sum(c("hard_negative").isNotNull().cast("int")).alias("negatives")).orderBy(F.desc("rows"))


@query("id_conflicts", "SELECT title, count(DISTINCT source) AS values FROM general GROUP BY title HAVING count(DISTINCT source) > 1")
def _(s, d):
    return evaluate.conflicts(read(s, d, "general"), "title", "source")


@query("null_blank_counts", "SELECT " + ", ".join(f"count(*) FILTER ({S_BLANK(x)}) AS {x}" for x in ("source", "title", "topic", "positive", "hard_negative")) + " FROM general")
def _(s, d):
    return read(s, d, "general").agg(*[F.count_if(t.is_blank(c(x))).alias(x) for x in ("source", "title", "topic", "positive", "hard_negative")])


@query("list_totals", "WITH g AS (SELECT title, list(data_id) AS ids, any_value(title) AS t FROM general GROUP BY title) SELECT count(*) AS parents, sum(len(ids))::BIGINT AS children, count(*) FILTER (t IS NULL OR trim(t) = '') AS untitled FROM g")
def _(s, d):
    return read(s, d, "general").groupBy("title").agg(F.count("data_id").alias("n")).agg(F.count(F.lit(1)).alias("parents"), F.sum("n").alias("children"), F.count_if(c("title").isNull() | (F.trim("title") == "")).alias("untitled"))


@query("training_steps", "SELECT sum(ceil(n / 32.0))::BIGINT AS steps FROM (SELECT count(*) AS n FROM triplet GROUP BY source)")
def _(s, d):
    return evaluate.training_steps(read(s, d, "triplet").groupBy("source").agg(F.count(F.lit(1)).alias("n")), "n", 32)


@query("mean_task_score", "SELECT round(avg(score), 6) AS mean_score, count(*) AS tasks FROM (SELECT source, avg(quality_score) AS score FROM rag_qa_hybrid_train GROUP BY source)")
def _(s, d):
    scores = read(s, d, "rag_qa_hybrid_train").groupBy("source").agg(F.avg("quality_score").alias("score"))
    return evaluate.mean_score(scores, "score").withColumn("mean_score", F.round("mean_score", 6))


@query("manifest", "SELECT split, source, count(*) AS rows, count(*) FILTER (quality_score >= 85) AS overlapping, round(count(*) FILTER (quality_score >= 85)::DOUBLE / count(*), 6) AS rate FROM rag_qa_hybrid_train GROUP BY split, source")
def _(s, d):
    return evaluate.manifest(read(s, d, "rag_qa_hybrid_train"), ["split", "source"], c("quality_score") >= 85)


@query("reason_rollup", "SELECT source, domain, count(*) AS rows FROM triplet GROUP BY ROLLUP (source, domain)")
def _(s, d):
    return read(s, d, "triplet").rollup("source", "domain").agg(F.count(F.lit(1)).alias("rows"))


@query("expectations", f"""
    WITH e AS (SELECT unnest([{{'c': 'unique data_id', 'o': count(DISTINCT data_id), 'e': count(*)}}, {{'c': 'filled anchor', 'o': count(*) FILTER ({S_BLANK('anchor')}), 'e': 0}}, {{'c': 'filled title', 'o': count(*) FILTER ({S_BLANK('title')}), 'e': 0}},
        {{'c': 'distinct anchor positive', 'o': count(*) FILTER (anchor = positive), 'e': 0}}, {{'c': 'longest positive', 'o': count(*) FILTER (length(positive) > 1400), 'e': 0}}, {{'c': 'pure split', 'o': count(*) FILTER (split IS DISTINCT FROM 'train'), 'e': 0}}]) AS x FROM rag_qa_hybrid_train)
    SELECT x.c AS "check", x.o AS observed, x.e AS expected, x.o = x.e AS passed FROM e""")  # fmt: skip
def _(s, d):
    return evaluate.expectations(read(s, d, "rag_qa_hybrid_train"), unique=["data_id"], filled=["anchor", "title"], distinct=[("anchor", "positive")], longest={"positive": 1400}, pure={"split": "train"})


@query("order_value_by_nation", "SELECT n_name, r_name, count(*) AS orders, round(sum(o_totalprice), 2) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def _(s, d):
    facts = read(s, d, "orders").join(read(s, d, "customer"), c("o_custkey") == c("c_custkey"))
    dims = read(s, d, "nation").join(read(s, d, "region"), c("n_regionkey") == c("r_regionkey"))
    return facts.join(dims, c("c_nationkey") == c("n_nationkey")).groupBy("n_name", "r_name").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value"))


# --- parsers ----------------------------------------------------------------------------------

S_Q, S_A = s_collapse("question"), s_collapse("answer")


@query("faq_pages", f"SELECT DISTINCT sha256({s_collapse('source')} || chr(31) || {S_Q} || chr(31) || {S_A} || chr(31) || {s_collapse('url')}) AS id FROM faq_rows WHERE {S_Q} <> '' AND {S_A} <> ''")
def _(s, d):
    cell = lambda x: F.coalesce(x, F.lit(""))
    html = F.concat(F.lit("<table><tr><th>Câu hỏi</th><th>Trả lời</th></tr><tr><td>1</td><td>"), cell(c("question")), F.lit("</td><td><p>"), cell(c("answer")), F.lit("</p></td></tr></table>"))
    return parse.faq_rows(read(s, d, "faq_rows").select("url", "source", "source_group", html.alias("html"))).select("id")


@query("faq_text_pairs", f"SELECT id, {S_Q} AS question, {S_A} AS answer FROM faq_rows WHERE {S_Q} <> '' AND {S_A} <> '' AND NOT regexp_matches(question || ' ' || answer, '(?i)hỏi|trả\\s*lời|đáp')")
def _(s, d):
    rows = read(s, d, "faq_rows").filter(~F.concat_ws(" ", "question", "answer").rlike(r"(?iu)hỏi|trả\s*lời|đáp"))
    return parse.text_pairs(rows.select("id", F.concat(F.lit("Câu hỏi số 1: "), "question", F.lit("\nTrả lời: "), "answer").alias("text")), "text")


@query("faq_finished", f"SELECT DISTINCT sha256({s_collapse('source')} || chr(31) || {S_Q} || chr(31) || {S_A} || chr(31) || {s_collapse('url')}) AS id FROM faq_rows WHERE {S_Q} <> '' AND {S_A} <> ''")
def _(s, d):
    return parse.finished_faq(read(s, d, "faq_rows").select("source", "source_group", "category", "question", "answer", "url")).select("id")


@query("json_salvage", f"SELECT id, regexp_replace(question, '^{WS}|{WS}$', '', 'g') AS question FROM faq_rows WHERE {S_Q} <> '' AND {S_A} <> ''")
def _(s, d):
    body = F.concat(F.lit("```json\n["), F.to_json(F.struct("question", "answer")), F.lit(', {"question": "cắt'))
    rows = read(s, d, "faq_rows").select("id", body.alias("content"))
    return parse.salvaged(rows, "content", ["question", "answer"]).select("id", "question")


_STORED = ("source", "title", "topic", "anchor", "positive", "hard_negative")


def _stored_lines(s, d):
    rows = read(s, d, "triplet").select("data_id", *_STORED, F.pmod(F.length("anchor"), F.lit(4)).alias("kind"))
    full = F.struct(*_STORED)
    line = F.when(c("kind") == 0, F.to_json(full, {"ignoreNullFields": "false"})).when(c("kind") == 1, F.to_json(F.struct(*_STORED, F.lit("cũ").alias("answer")), {"ignoreNullFields": "false"})).when(c("kind") == 2, F.to_json(F.struct(*_STORED[:5]), {"ignoreNullFields": "false"})).otherwise(F.lit("[1]"))
    return rows.select("data_id", line.alias("line"))


@query("stored_documents", """
    SELECT data_id, CASE WHEN length(anchor) % 4 > 1 THEN 'incompatible' WHEN list_contains(list_transform([source, title, topic, anchor, positive, hard_negative], lambda x: coalesce(trim(x), '') = ''), true) THEN 'invalid' END AS error FROM triplet""")  # fmt: skip
def _(s, d):
    return parse.stored_documents(_stored_lines(s, d), "line", list(_STORED)).select("data_id", "error")


@query("generated_documents", f"""
    SELECT id, {S_STRIP('question')} AS anchor, CASE WHEN contains(lower({S_STRIP('source')}), 'cổng') THEN 'Cổng' ELSE {S_STRIP('source')} END AS source FROM faq_rows WHERE {S_Q} <> '' AND {S_STRIP('source')} <> ''""")  # fmt: skip
def _(s, d):
    one = F.to_json(F.struct(c("question").alias("anchor"), "source"), {"ignoreNullFields": "false"})
    rows = read(s, d, "faq_rows").select("id", F.concat(F.lit("["), one, F.lit(', {"anchor": "thừa", "source": "x"}]')).alias("content"))
    return parse.generated_documents(rows, "content", ["anchor", "source"], 1, ["Cổng"]).select("id", "anchor", "source")


@query("postback_links", "SELECT doc_id, 'list$' || source AS target, (doc_id % 7)::VARCHAR AS argument FROM documents WHERE doc_id % 2 = 0")
def _(s, d):
    href = F.when(c("doc_id") % 2 == 0, F.concat(F.lit("javascript:__doPostBack('list$"), "source", F.lit("', '"), (c("doc_id") % 7).cast("string"), F.lit("')"))).otherwise(F.concat(F.lit("/p?Page="), c("doc_id").cast("string")))
    return read(s, d, "documents").select("doc_id", parse.postback(href).alias("x")).filter("x IS NOT NULL").select("doc_id", "x.target", "x.argument")


# --- pipelines --------------------------------------------------------------------------------


@query("clean_english")
def _(s, d):
    return pipelines.best_english(pipelines.clean_english(read(s, d, "english_rag_qa_triplet"))).select("clean_id", "data_id", "hard_negative_score")


@query("clean_export")
def _(s, d):
    return quality.reason_counts(pipelines.clean_export(read(s, d, "triplet"), ["source", "data_id"]), "reason", "source")


@query("hybrid_rows", f"""
    WITH x AS (SELECT *, {s_collapse('nfc_normalize(anchor)')} AS a, {s_collapse('nfc_normalize(positive)')} AS p FROM general)
    SELECT 'hybrid_' || substr(sha256(concat_ws(chr(31), 'general', source, data_id)), 1, 24) AS data_id, source, data_id AS source_data_id, nullif(trim(title), '') AS title FROM x
    WHERE length(a) BETWEEN 15 AND 420 AND length(p) BETWEEN 80 AND 1400 AND {s_fold('a')} <> {s_fold('p')} AND NOT regexp_matches(a || chr(10) || p, '\\x{{FFFD}}|\\[\\[|\\]\\]|\\{{\\{{|\\}}\\}}')""")  # fmt: skip
def _(s, d):
    return pipelines.hybrid_rows(read(s, d, "general"), "general", "rag_qa_gold", False, 100).select("data_id", "source", "source_data_id", "title")


@query("rebuilt_documents")
def _(s, d):
    return pipelines.rebuild_documents(read(s, d, "general")).select("data_id", "title", F.md5("positive").alias("positive"), F.md5("hard_negative").alias("hard_negative"))


def _holdout(s, d):
    triples = read(s, d, "general").filter("hard_negative IS NOT NULL AND source IS NOT NULL").select(c("source").alias("shard"), c("anchor").alias("query"), c("positive").alias("positive"), c("hard_negative").alias("negative"), "data_id")
    train = read(s, d, "rag_qa_hybrid_train").filter("split = 'train'").select(c("anchor").alias("query"))
    return evaluate.holdout_tables(evaluate.holdout_rows(triples, train, 40, 4, 25, ["data_id"]))


for _i, _part in enumerate(("queries", "corpus", "qrels")):
    query(f"holdout_{_part}")(lambda s, d, i=_i: _holdout(s, d)[i])


# --- streaming extras -------------------------------------------------------------------------


@query("windowed_events", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _(s, d):
    out = incremental.windowed_counts(read(s, d, "events").withColumn("ts", c("ts").cast("timestamp")), "ts", ["event_type"])
    return out.select(c("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", F.round("total", 4).alias("total"))


@query("event_sessions", """
    WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS n FROM events),
    g AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, n DESC ROWS UNBOUNDED PRECEDING) AS k FROM e)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM g GROUP BY user_id, k""")  # fmt: skip
def _(s, d):
    out = incremental.sessions(read(s, d, "events").withColumn("ts", c("ts").cast("timestamp")), "ts", "user_id")
    return out.select("user_id", c("session_start").cast("timestamp_ntz").alias("session_start"), c("session_end").cast("timestamp_ntz").alias("session_end"), "events")
