"""Queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trisieve.llm import p1_markup, p2_encoding, p3_neighbours, p4_forms, p5_pieces, p6_copies, p7_overlap, p8_packing, p9_mixing, p10_levels
from trisieve.runtime import read

TEXTS = ["anchor", "positive", "hard_negative"]


def _encoded(s: SparkSession, d: str) -> list[tuple[str, DataFrame, list[str]]]:
    return [("english_rag_qa_triplet", read(s, d, "english_rag_qa_triplet"), TEXTS[:2]), ("triplet", read(s, d, "triplet"), TEXTS[2:])]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": lambda s, d: p1_markup.marked_ids(read(s, d, "general"), "data_id", "source", TEXTS[:2]),
    "p1_clean": lambda s, d: p1_markup.clean_values(read(s, d, "general"), "data_id", "source", TEXTS[:2]),
    "p2_found": lambda s, d: p2_encoding.garbled_ids(_encoded(s, d)),
    "p2_repaired": lambda s, d: p2_encoding.garbled_values(_encoded(s, d)),
    "p3_found": lambda s, d: p3_neighbours.neighbour_pairs(read(s, d, "general_vec"), "vec_id", "field_name", "vec"),
    "p3_nearest": lambda s, d: p3_neighbours.nearest(read(s, d, "general_vec"), "vec_id", "field_name", "vec"),
    "p4_found": lambda s, d: p4_forms.look_alike_pairs(read(s, d, "triplet"), "data_id", TEXTS[:2]),
    "p4_forms": lambda s, d: p4_forms.consistent_forms(read(s, d, "triplet"), "data_id", TEXTS[:2]).select("id", "field_name", "form"),
    "p5_found": lambda s, d: p5_pieces.oversized_ids(read(s, d, "general"), "data_id", "positive"),
    "p5_pieces": lambda s, d: p5_pieces.split_items(read(s, d, "general"), "data_id", "positive"),
    "p6_found": lambda s, d: p6_copies.copies(read(s, d, "triplet"), "data_id", TEXTS),
    "p6_records": lambda s, d: p6_copies.distinct_records(read(s, d, "triplet"), "data_id", TEXTS),
    "p7_found": lambda s, d: p7_overlap.overlap_pairs(read(s, d, "rag_qa_hybrid_train"), "data_id", "split", TEXTS[:2]),
    "p7_report": lambda s, d: p7_overlap.overlap_report(read(s, d, "rag_qa_hybrid_train"), "data_id", "split", "source", TEXTS[:2]),
    "p8_containers": lambda s, d: p8_packing.pack_documents(read(s, d, "documents"), "doc_id", "text"),
    "p8_fill": lambda s, d: p8_packing.fill_report(p8_packing.pack_documents(read(s, d, "documents"), "doc_id", "text")),
    "p9_chosen": lambda s, d: p9_mixing.mix(read(s, d, "documents"), read(s, d, "mix_targets"))[0],
    "p9_shares": lambda s, d: p9_mixing.mix(read(s, d, "documents"), read(s, d, "mix_targets"))[1],
    "p10_found": lambda s, d: p10_levels.reading_levels(read(s, d, "documents"), read(s, d, "doc_levels")).select("doc_id", "reading_level"),
    "p10_profile": lambda s, d: p10_levels.level_profile(p10_levels.reading_levels(read(s, d, "documents"), read(s, d, "doc_levels"))),
}

# --- oracle SQL, where SQL can say the same ----------------------------------------------------

_IGNORED = r"[\p{P}\p{Z}\t-\r\x{1c}-\x{1f}\x{85}]+"
_CANON = "list_sort([" + ", ".join(f"replace(replace(regexp_replace(lower(coalesce({f}, '')), '{_IGNORED}', '', 'g'), 'ß', 'ss'), 'ς', 'σ')" for f in TEXTS) + "])"
# problem 4, said character by character, apart from the operator's own expressions
_SAME_SHAPE = [
    ("АВЕКМНОРСТХЅІЈҮԚԜ", "ABEKMHOPCTXSIJYQW"), ("аеорсухѕіјһԛԝԁ", "aeopcyxsijhqwd"), ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABEZHIKMNOPTYXo"), ("ÐƉµ", "ĐĐμ"),
    ("ЀЁЇӐӒӦѐёїӑӓӧόὸ", "ÈËÏĂÄÖèëïăäöóò"), ("￠￡￢￣￤￥￦", "¢£¬¯¦¥₩"),
]
_SHOWS_NOTHING = " OR ".join(["u IN (173, 847, 1564, 4447, 4448, 6068, 6069, 12644, 65279, 65440)", *(f"u BETWEEN {a} AND {b}" for a, b in [(6155, 6158), (8203, 8207), (8234, 8238), (8288, 8303), (65024, 65039), (917504, 921599)])])
_BLANK = "u IN (32, 133, 160, 5760, 8239, 8287, 12288) OR u BETWEEN 9 AND 13 OR u BETWEEN 28 AND 31 OR u BETWEEN 8192 AND 8202 OR u BETWEEN 8232 AND 8233"
_CASES = " ".join(f"WHEN strpos('{a}', c) > 0 THEN substr('{b}', strpos('{a}', c), 1)" for a, b in _SAME_SHAPE)
_FORMS = f"""
    x AS ({" UNION ALL ".join(f"SELECT data_id AS id, '{f}' AS field_name, {f} AS value FROM triplet WHERE {f} IS NOT NULL" for f in TEXTS[:2])}),
    p AS (SELECT id, field_name, unnest(string_split(nfc_normalize(value), '')) AS c, generate_subscripts(string_split(nfc_normalize(value), ''), 1) AS pos FROM x),
    q AS (SELECT *, unicode(c) AS u FROM p WHERE c <> ''),
    m AS (SELECT id, field_name, string_agg(CASE WHEN {_SHOWS_NOTHING} THEN '' WHEN {_BLANK} THEN ' ' WHEN u BETWEEN 65281 AND 65374 THEN chr((u - 65248)::INTEGER) {_CASES} ELSE c END, '' ORDER BY pos) AS form FROM q GROUP BY ALL),
    v AS (SELECT id, field_name, trim(regexp_replace(coalesce(nfc_normalize(form), ''), ' +', ' ', 'g')) AS form, trim(regexp_replace(value, '[ \\t\\r\\n]+', ' ', 'g')) AS stored FROM x LEFT JOIN m USING (id, field_name))"""

ORACLE: dict[str, str] = {
    "p4_found": f"WITH {_FORMS} SELECT DISTINCT a.field_name, a.id AS data_id_a, b.id AS data_id_b FROM v a JOIN v b ON a.field_name = b.field_name AND a.form = b.form AND a.stored <> b.stored AND a.id < b.id WHERE a.form <> ''",
    "p4_forms": f"WITH {_FORMS} SELECT id, field_name, form FROM v",
    "p5_found": f"SELECT data_id FROM general WHERE length(positive) > {p5_pieces.LIMIT}",
    "p6_found": f"WITH c AS (SELECT data_id, {_CANON} AS key FROM triplet), k AS (SELECT *, min(data_id) OVER (PARTITION BY key) AS keep_id FROM c) SELECT keep_id, data_id AS copy_id FROM k WHERE data_id <> keep_id",
    "p6_records": f"WITH c AS (SELECT data_id, {_CANON} AS key FROM triplet) SELECT min(data_id) AS keep_id, count(*) AS copies FROM c GROUP BY key",
}
