"""Text normalisers and shape functions as columns.

Built-ins wherever Spark has them; Unicode normal forms, HTML references and full case folding have no
built-in and go through one fused pandas UDF for each column.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = r"(?U)[\s\x1c-\x1f]+"

# Title words that say nothing, and words for kinds of legal documents.
STOP_WORDS = ["a", "an", "and", "các", "cho", "của", "gi", "gì", "is", "là", "một", "of", "the", "và"]
DOCUMENT_KINDS = ["Bộ luật", "Pháp lệnh", "Nghị định", "Thông tư", "Quyết định", "Nghị quyết", "Chỉ thị", "Công văn", "Luật"]


def text_udf(change):
    """A nullable string-to-string pandas UDF of a Python function."""

    @F.pandas_udf(T.StringType())
    def run(column: pd.Series) -> pd.Series:
        return column.map(change, na_action="ignore")

    return run


def collapse(c: Column) -> Column:
    """White space runs as one blank, none at the ends; null stays null."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def collapse_or_empty(c: Column) -> Column:
    return F.coalesce(collapse(c), F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def is_blank(c: Column) -> Column:
    """Null or without anything but white space."""
    return c.isNull() | (strip(c) == "")


nfc = text_udf(lambda x: unicodedata.normalize("NFC", x))
nfkc = text_udf(lambda x: unicodedata.normalize("NFKC", x))
casefold = text_udf(str.casefold)


def folded(c: Column) -> Column:
    """Case folding within the JVM: exact for ß, without the rarer multi-letter foldings."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def nfc_collapsed(c: Column) -> Column:
    return collapse(nfc(c))


def nfc_stripped(c: Column) -> Column:
    return strip(nfc(c))


def _plain(x: str) -> str:
    x = unicodedata.normalize("NFC", html.unescape(x))
    return " ".join(re.sub("[​﻿\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", " ", x).split())


def _key(x: str) -> str:
    return " ".join(re.findall(r"\w+", unicodedata.normalize("NFKC", x).casefold()))


#: References decoded, NFC, invisible and control characters and white space runs as one blank.
plain_text = text_udf(_plain)
#: References decoded, stripped, NFC, white space collapsed.
unescaped = text_udf(lambda x: " ".join(unicodedata.normalize("NFC", html.unescape(x).strip()).split()))
#: NFKC with collapsed white space.
compatible = text_udf(lambda x: " ".join(unicodedata.normalize("NFKC", x).split()))
#: Punctuation-insensitive key: the case-folded words of the NFKC form.
text_key = text_udf(_key)


def anchor_key(c: Column) -> Column:
    """Case-folded, collapsed, without closing question marks, stops and exclamation marks."""
    return F.regexp_replace(collapse(folded(c)), r"[?.!]+$", "")


def word_set(c: Column) -> Column:
    """Distinct Unicode words in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}\p{M}_]+)"), 1))


def ascii_tokens(c: Column, longer_than: int = 0) -> Column:
    return F.array_distinct(F.filter(F.regexp_extract_all(folded(c), F.lit("([a-z0-9]+)"), 1), lambda w: F.length(w) > longer_than))


def title_words(c: Column) -> Column:
    """Distinct title words that are no stop words; empty for a null title."""
    return F.array_except(F.coalesce(word_set(c), F.array().cast("array<string>")), F.array(*[F.lit(w) for w in STOP_WORDS]))


def sentence_count(c: Column) -> Column:
    return F.size(F.filter(F.split(F.trim(c), r"[.!?]+(?:\s+|$)"), lambda x: F.trim(x) != ""))


def document_kind(title: Column) -> Column:
    """The first word for a kind of legal document in a title, first letter upper case; null without one."""
    found = F.regexp_extract(title, r"(?iU)\b(" + "|".join(DOCUMENT_KINDS) + r")\b", 1)
    return F.when(found != "", F.concat(F.upper(F.substring(found, 1, 1)), F.lower(F.substring(found, 2, 1000))))


def has_letter(c: Column) -> Column:
    return c.rlike(r"\p{L}")


def has_ascii_letter(c: Column) -> Column:
    return c.rlike("[A-Za-z]")


def has_control(c: Column) -> Column:
    return c.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")


def suffix_prefix_overlap(left: Column, right: Column, longest: int, shortest: int) -> Column:
    """The largest n from `longest` down to `shortest` (or the shorter text, if that is less) with the end
    of `left` equal to the beginning of `right`, else 0."""
    most = F.least(F.lit(longest), F.length(left), F.length(right))
    least = F.greatest(F.least(F.lit(shortest), most), F.lit(1))
    sizes = F.filter(F.sequence(least, F.greatest(most, least)), lambda n: (n <= most) & (F.right(left, n) == F.left(right, n)))
    return F.coalesce(F.array_max(sizes), F.lit(0))


ARTIFACT = r"\x{FFFD}|\[\[|\]\]|\{\{|\}\}|(?i:formula_\d+)|[\x00-\x08\x0b\x0c\x0e-\x1f]"


def drop_artifacts(c: Column) -> Column:
    """Broken wiki markers, formula numbers, lost and control characters as blanks, then NFC; other text unchanged.

    Raises where nothing is left.
    """
    clean = nfc_collapsed(F.when(c.rlike(ARTIFACT), F.regexp_replace(c, ARTIFACT, " ")))
    return F.when(~c.rlike(ARTIFACT) | c.isNull(), c).when(clean == "", F.raise_error(F.lit("only artifacts in a field"))).otherwise(clean)


# --- wiki text --------------------------------------------------------------------------------

# The order and the patterns of the cleaning steps are part of the result.
_COMMON = [
    (r"(?s)<!--.*?-->", " "), (r"(?is)<ref\b[^>]*>.*?</ref\s*>", " "), (r"(?i)<ref\b[^>]*/\s*>", " "), (r"</?[^>]+>", " "),
]
_LINKS = [(r"\[\[([^\]|]+)\|([^\]]+)\]\]", r"\2"), (r"\[\[([^\]]+)\]\]", r"\1")]
_DEBRIS = [(r"\|\s*(?:group|class|style)\s*=\s*[^|]+", " "), (r"\[\s*\d+\s*\]", " ")]
_MATH = [(r"(?<!\w)__.*?__(?!\w)", " "), (r"(?i)formula_\d+", " "), (r"\\[A-Za-z]+", " "), (r"[{}]", " ")]
_FILES = r"(?i)\[\[(?:file|image|tập tin|category|thể loại{}):[^\]]*\]\]"
_MAGIC = r"(?i)__(?:NOTOC|TOC|FORCETOC|NOEDITSECTION|HIDDENCAT|INDEX|NOINDEX|NOGALLERY|NEWSECTIONLINK|NONEWSECTIONLINK)__"
_TEMPLATE = re.compile(r"(?s)\{\{.*?\}\}")

_PROFILES: dict[str, dict] = {
    "passage": {"nfc": True, "passes": 10, "files": "", "after": [*_MATH, *_DEBRIS, ("�", " ")]},
    "document": {"nfc": True, "passes": 10, "files": "|hình|hinh|media", "before": [("[​﻿�]", " ")], "after": [(_MAGIC, " "), *_DEBRIS, (r"(?i)(?:[A-Za-z]{0,3};)?br[&>]", " "), (r"(?i);br>", " "), (r"\[\[|\]\]", " ")], "controls": True},
    "chunk": {"nfc": False, "passes": 3, "files": "", "after": [*_MATH, *_DEBRIS]},
}


def _wiki(profile: str):
    steps = _PROFILES[profile]
    first = [(re.compile(p), r) for p, r in [*steps.get("before", []), *_COMMON, (_FILES.format(steps["files"]), " "), *_LINKS]]
    last = [(re.compile(p), r) for p, r in steps["after"]]
    normal = (lambda x: unicodedata.normalize("NFC", x)) if steps["nfc"] else (lambda x: x)

    def clean(x: str) -> str:
        x = normal(html.unescape(x))
        for pattern, by in first:
            x = pattern.sub(by, x)
        for _ in range(steps["passes"]):
            x, n = _TEMPLATE.subn(" ", x)
            if not n:
                break
        for pattern, by in last:
            x = pattern.sub(by, x)
        x = html.unescape(x)
        if steps.get("controls"):
            x = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ", x)
        return " ".join(normal(x).split())

    return clean


def wiki_clean(c: Column, profile: str = "passage") -> Column:
    """Text without wiki markup, by the profile 'passage', 'document' or 'chunk'; null stays null."""
    return text_udf(_wiki(profile))(c)


def _mend(x: str) -> str:
    """UTF-8 that was read as Latin-1 or cp1252, stretch by stretch, then NFC and collapsed white space."""

    def stretch(m: re.Match) -> str:
        for codec in ("cp1252", "latin-1"):
            try:
                return m[0].encode(codec).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
        return m[0]

    for _ in range(2):
        x = re.sub("[Â-ô][\u0080-ÿŒ-Ÿƒˆ˜–-›€™]{1,3}", stretch, x)
    # a fraction or sign whose lead character alone is left over
    x = re.sub("Â(?=[¡-¿])", "", x)
    return " ".join(unicodedata.normalize("NFC", x).split())


#: Repairs misread UTF-8; null stays null.
mended = text_udf(_mend)
