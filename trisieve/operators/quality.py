"""Row filters with reason codes, quality scores and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisieve.functions import text as t
from trisieve.functions.similarity import jaccard


def first_reason(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds, null if none does; a rule that is null does not hold."""
    out = None
    for name, rule in rules:
        out = F.when(rule, F.lit(name)) if out is None else out.when(rule, F.lit(name))
    return out


def between(c: Column, low: int, high: int) -> Column:
    return F.length(c).between(low, high)


def valid_pair(anchor: Column, positive: Column) -> Column:
    return F.coalesce((F.length(F.trim(anchor)) > 0) & (F.length(F.trim(positive)) > 0), F.lit(False))


def quality_mask(query: Column, positive: Column, negative: Column, query_chars=(8, 384), passage_chars=(80, 2000)) -> Column:
    """Raw lengths within bounds, passage unlike query and negative; null where a text is null."""
    return between(query, *query_chars) & between(positive, *passage_chars) & between(negative, *passage_chars) & (positive != negative) & (query != positive)


def distinct_triple(query: Column, positive: Column, negative: Column, query_chars=(8, 384), passage_chars=(80, 2000)) -> Column:
    """As quality_mask on normalised texts, with all three distinct."""
    return quality_mask(query, positive, negative, query_chars, passage_chars) & (query != negative)


def loose_triplet(anchor: Column, positive: Column, negative: Column) -> Column:
    """Anchor of 3 to 1,000 and passages of 20 to 12,000 characters; passage unlike anchor and negative."""
    a, p, n = t.folded(anchor), t.folded(positive), t.folded(negative)
    return between(anchor, 3, 1000) & between(positive, 20, 12000) & between(negative, 20, 12000) & (a != p) & (p != n)


def reject_reason(anchor: Column, positive: Column, negative: Column) -> Column:
    """First failing rule of a cleaned English triplet, null if it is fine."""
    a, p, n = t.folded(anchor), t.folded(positive), t.folded(negative)
    return first_reason(
        ("anchor_length", ~between(anchor, 5, 700)), ("positive_length", ~between(positive, 60, 9000)), ("negative_length", ~between(negative, 60, 9000)),
        ("anchor_not_english", ~t.has_ascii_letter(anchor)), ("control_character", t.has_control(F.concat(anchor, positive, negative))), ("degenerate_triplet", (a == p) | (p == n)),
    )


def export_reason(anchor: Column, positive: Column, negative: Column, strict_encoding: bool = True, keep_pairs: bool = False) -> Column:
    """First failing rule of the clean export.

    `strict_encoding` also takes a single Ã as damage, which rejects correct upper-case Vietnamese;
    `keep_pairs` lets rows without a negative through.
    """
    no_negative = F.coalesce(F.trim(negative) == "", F.lit(True))
    absent = no_negative if keep_pairs else F.lit(False)
    blank = t.is_blank(anchor) | t.is_blank(positive) | (F.lit(False) if keep_pairs else no_negative)
    marks = "\\x{FFFD}|Ã" if strict_encoding else "\\x{FFFD}"
    a, p, n = t.folded(anchor), t.folded(positive), t.folded(negative)
    return first_reason(
        ("blank_field", blank), ("anchor_length", ~between(anchor, 8, 384)), ("passage_length", ~between(positive, 80, 2000) | (~absent & ~between(negative, 80, 2000))),
        ("encoding_artifact", F.concat_ws(" ", anchor, positive, negative).rlike(marks)), ("degenerate_triplet", (a == p) | (~absent & ((a == n) | (p == n)))),
    )


def clean_pair(anchor: Column, positive: Column) -> Column:
    marks = F.concat(anchor, F.lit("\n"), positive).rlike(r"\x{FFFD}|\[\[|\]\]|\{\{|\}\}")
    return between(anchor, 15, 420) & between(positive, 80, 1400) & (t.folded(anchor) != t.folded(positive)) & ~marks


def science_reason(source: Column, topic: Column, anchor: Column, positive: Column, negative: Column, known_source: Column, known_topic: Column) -> Column:
    """First failing rule of a science record; texts are compared by their word keys."""
    key = {name: t.text_key(c) for name, c in (("a", anchor), ("p", positive), ("n", negative))}
    words = {name: F.size(F.filter(F.split(k, " "), lambda w: w != "")) for name, k in key.items()}
    fields = [source, topic, anchor, positive, negative]
    missing = fields[0].isNull()
    empty = t.is_blank(fields[0])
    for f in fields[1:]:
        missing, empty = missing | f.isNull(), empty | t.is_blank(f)
    return first_reason(
        ("missing_field", missing), ("empty_field", empty), ("unknown_source", known_source.isNull()), ("unknown_topic", known_topic.isNull()),
        ("anchor_length", ~words["a"].between(5, 80)), ("positive_length", ~words["p"].between(20, 220)), ("negative_length", ~words["n"].between(20, 220)),
        ("identical_passages", key["p"] == key["n"]), ("passages_too_similar", jaccard(key["p"], key["n"]) >= 0.80),
        ("positive_sentence_count", ~t.sentence_count(positive).between(1, 6)), ("negative_sentence_count", ~t.sentence_count(negative).between(1, 6)),
    )


def legal_pair(title: Column, anchor: Column, positive: Column) -> Column:
    """Title, question of 20 to 420 and passage of 120 to 900 characters without lost or wiki marks."""
    filled = (F.trim(title) != "") & (F.trim(anchor) != "") & (F.trim(positive) != "")
    marks = F.concat(anchor, positive).rlike(r"\x{FFFD}|\[\[|\{\{")
    return filled & between(t.collapse(anchor), 20, 420) & between(t.collapse(positive), 120, 900) & (anchor != positive) & ~marks


def per_source(source: Column, rules: dict[str, Column]) -> Column:
    """Rows of the named sources must meet their source's rule; other sources pass."""
    out = F.lit(True)
    for name, rule in rules.items():
        out = out & ((source != name) | rule)
    return out


def quality_issues(anchor: Column, positive: Column, negative: Column, low: int = 80, high: int = 384) -> Column:
    """Number of issues: lost character, link mark, template mark, tag or formula number, passage length."""
    every = F.concat(anchor, positive, negative)
    issue = lambda c: F.when(c, 1).otherwise(0)
    return issue(F.instr(every, "�") > 0) + issue(F.instr(every, "[[") > 0) + issue(F.instr(every, "{{") > 0) + issue(every.rlike("<[^>]+>|formula_[0-9]")) + issue(~F.length(F.trim(positive)).between(low, high))


def mentions_title(title: Column, positive: Column) -> Column:
    return F.when((F.trim(title) != "") & F.contains(F.lower(positive), F.lower(F.trim(title))), 1).otherwise(0)


def ends_sentence(positive: Column, marks: str = ".!?…") -> Column:
    return F.when(F.rtrim(positive).rlike(f"[{marks}]$"), 1).otherwise(0)


def chunk_index(data_id: Column, pattern: str = "^data_clean_[0-9]{7}_[0-9]{4}$", default: int = 1_000_000) -> Column:
    """The number at the end of ids of the given form."""
    return F.when(data_id.rlike(pattern), F.right(data_id, F.lit(4)).cast("int")).otherwise(default)


# What access-control pages say.
BLOCK_MARKS = ["an error occurred while processing your request", "access denied", "captcha challenge"]


def is_block_page(html: Column) -> Column:
    return F.lower(html).rlike("|".join(BLOCK_MARKS))


def with_role(query: Column, passage: Column) -> tuple[Column, Column]:
    """Texts with the prefixes an asymmetric encoder expects."""
    return F.concat(F.lit("query: "), query), F.concat(F.lit("passage: "), passage)


def split_pairs(df: DataFrame, negative: str) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with a negative."""
    blank = t.is_blank(F.col(negative))
    return df.filter(blank), df.filter(~blank)


def title_question(title: Column, anchor: Column, title_first: bool = True) -> Column:
    """A question from the title, or the present question, whichever is to come first and is filled."""
    made = F.when(F.trim(title) != "", F.format_string('"%s" là gì?', F.trim(title)))
    own = F.when(~t.is_blank(anchor), anchor)
    return F.coalesce(made, own) if title_first else F.coalesce(own, made)


def reason_counts(df: DataFrame, reason: str, *by: str) -> DataFrame:
    """Rows for each reason; rows without a reason are 'accepted'."""
    return df.groupBy(*by, F.coalesce(F.col(reason), F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
