"""Problem 4: text that looks the same but is stored differently.

Method: DuckDB runs inside the Arrow partitions; nfc_normalize, translate and regular expressions in
embedded SQL map widths, blanks, invisible characters, stored accents and look-alike letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisieve.runtime import materialize, pair_join, spread

# Letters of another script with the shape of a Latin letter.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԛ": "q", "ԝ": "w", "ԁ": "d",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o",
    "Ð": "Đ", "Ɖ": "Đ", "µ": "μ",
    "Ѐ": "È", "Ё": "Ë", "Ї": "Ï", "Ӑ": "Ă", "Ӓ": "Ä", "Ӧ": "Ö", "ѐ": "è", "ё": "ë", "ї": "ï", "ӑ": "ă", "ӓ": "ä", "ӧ": "ö", "ό": "ó", "ὸ": "ò",
}

FULL_WIDTH = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)} | {"￠": "¢", "￡": "£", "￢": "¬", "￣": "¯", "￤": "¦", "￥": "¥", "￦": "₩"}

#: Characters that show nothing.
INVISIBLE = r"[\x{AD}\x{34F}\x{61C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{E0000}-\x{E0FFF}]"
BLANKS = r"[\s\x{0B}\x{85}\x{1C}-\x{1F}\p{Z}]+"


def form_sql(column: str) -> str:
    """The DuckDB expression for the consistent form of a column."""
    table = FULL_WIDTH | LOOK_ALIKES
    quote = lambda x: "'" + "".join(x).replace("'", "''") + "'"
    seen = f"regexp_replace(nfc_normalize({column}), '{INVISIBLE}', '', 'g')"
    mapped = f"nfc_normalize(translate({seen}, {quote(table.keys())}, {quote(table.values())}))"
    return f"trim(regexp_replace({mapped}, '{BLANKS}', ' ', 'g'))"


def stored_sql(column: str) -> str:
    """The value as stored, but with runs of space, tab and line break as one space."""
    return rf"trim(regexp_replace({column}, '[ \t\r\n]+', ' ', 'g'))"


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
    sql = f"SELECT * EXCLUDE (value), {form_sql('value')} AS form, {stored_sql('value')} AS stored FROM part"
    for batch in batches:
        con.register("part", pa.Table.from_batches([batch]))
        yield from con.sql(sql).to_arrow_table().to_batches()
        con.unregister("part")


def consistent_forms(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(id, field_name, form, stored) for each non-null value of `fields`.

    `form` is NFC text without invisible characters, with plain width, plain blanks and Latin letters
    for look-alikes. Case, missing accents, raised or circled signs, quotes and dashes stay. Empty
    texts have an empty form; an empty table gives an empty result; other columns are ignored.
    """
    values = df.select(F.col(id_col).cast("string").alias("id"), F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("value")) for c in fields])).alias("v")).select("id", "v.*")
    return spread(values.filter("value IS NOT NULL")).mapInArrow(_forms, "id string, field_name string, form string, stored string")


def look_alike_pairs(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(field_name, data_id_a, data_id_b): values that look the same but are stored differently.

    Only forms stored in at least two ways are paired; a form that very many rows share is joined in
    slices. Values that differ in white space only, and empty values, make no pair; repeated ids and
    null ids pair as any other row but never with themselves.
    """
    digest = lambda c: F.unhex(F.md5(c))
    keyed = materialize(consistent_forms(df, id_col, fields).filter("form <> ''").select("id", "field_name", digest("form").alias("form"), digest("stored").alias("stored")), "p4")
    on = ["field_name", "form"]
    several = keyed.groupBy(*on).agg(F.min("stored").alias("least"), F.max("stored").alias("most"), F.count(F.lit(1)).alias("rows")).filter("least <> most").select(*on, "rows")
    several = materialize(several, "p4f")
    mixed = materialize(keyed.join(several.select(*on), on, "left_semi"), "p4m")
    pairs = pair_join(mixed.withColumnsRenamed({"id": "data_id_a", "stored": "stored_a"}), mixed.withColumnsRenamed({"id": "data_id_b", "stored": "stored_b"}), on, several, "rows", by=["data_id_a"])
    return pairs.filter("data_id_a < data_id_b AND stored_a <> stored_b").select("field_name", "data_id_a", "data_id_b").distinct()
