"""Parsers that turn one stored page or model answer into rows."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisieve.functions.keys import digest
from trisieve.functions.similarity import canonical_name
from trisieve.functions.text import collapse_or_empty, is_blank, text_udf
from trisieve.operators.select import best_per_key

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    """An element with its children; texts are plain strings among them."""

    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    @property
    def classes(self) -> set[str]:
        return set(self.attrs.get("class", "").split())

    def walk(self) -> Iterator[Node]:
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def text(self, without: tuple[str, ...] = ("script", "style")) -> str:
        parts, todo = [], [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                parts.append(node)
            elif node is self or node.tag not in without:
                todo += reversed(node.children)
        return " ".join(" ".join(parts).split())

    def first(self, *, tag: str | None = None, class_: str | None = None) -> Node | None:
        return next((n for n in self.walk() if (tag is None or n.tag == tag) and (class_ is None or class_ in n.classes)), None)

    def after(self, word: str) -> Node | None:
        """The next sibling with a class that holds the word."""
        siblings = [c for c in self.parent.children if isinstance(c, Node)] if self.parent else []
        return next((s for s in siblings[siblings.index(self) + 1 :] if any(word in c.lower() for c in s.classes)), None) if self in siblings else None


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


visible_text = text_udf(lambda x: tree(x).text())


def faq_from_page(html: str) -> list[tuple[str, str, str]]:
    """(question, answer, category) from tables with such headers and from question and answer classes."""
    root, out = tree(html), []
    for table in (n for n in root.walk() if n.tag == "table"):
        rows = [n for n in table.walk() if n.tag == "tr"]
        head = rows[0].text().casefold() if rows else ""
        if "câu hỏi" not in head or not ("trả lời" in head or "đáp" in head):
            continue
        for row in rows[1:]:
            cells = [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]
            if len(cells) > 1:
                out.append((cells[-2].text(), cells[-1].text(), ""))
    for node in root.walk():
        if node.classes & {"question", "faq-question"} or "data-question" in node.attrs:
            answer = node.after("answer")
            if answer is not None:
                out.append((node.text(), answer.text(), ""))
    return out


def faq_from_accordion(html: str, item: str = "faq__item", question: str = "faq__qtext", answer: str = "faq__a") -> list[tuple[str, str, str]]:
    """From <details> elements whose class ends in `item`, with their categories joined by ' > '."""
    ends = lambda n, x: any(c.endswith(x) for c in n.classes)
    out = []
    for node in (n for n in tree(html).walk() if n.tag == "details" and ends(n, item)):
        q, a = (next((n for n in node.walk() if ends(n, x)), None) for x in (question, answer))
        category = " ".join(node.attrs.get("data-categories", "").split()).replace(",", " > ")
        out.append((q.text() if q else "", a.text() if a else "", category))
    return out


# The labels of question pages.
_LABEL = re.compile(r"(?i)^\s*(?:Nội dung\s+)?(?:câu hỏi|trả lời|đáp)\s*:\s*")


def faq_from_detail(html: str, block: str = "DetailQuestion", question: str = "divFirst", answer: str = "fieldset", unanswered: str = "Chưa trả lời") -> list[tuple[str, str, str]]:
    """From a page with one question; none if it is not answered. Legends are left out, labels removed."""
    node = tree(html).first(class_=block)
    if node is None or unanswered in node.text():
        return []
    q, a = node.first(class_=question), node.first(tag=answer) or node.first(class_=answer)
    if q is None or a is None:
        return []
    return [(_LABEL.sub("", q.text()), _LABEL.sub("", a.text(("script", "style", "legend"))), "")]


FAQ = "url string, source string, source_group string, question string, answer string, category string, error string"
PARSERS = {"page": faq_from_page, "accordion": faq_from_accordion, "detail": faq_from_detail}


def faq_rows(pages: DataFrame, parser: str = "page") -> DataFrame:
    """FAQ rows of stored pages (url, source, source_group, html).

    Rows with a blank question or answer are left out, repeats (by id) keep the first; a page that
    cannot be parsed gives one row with its error, so one bad page stops nothing.
    """
    parse = PARSERS[parser]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for url, source, group, html in pdf.itertuples(index=False):
                try:
                    rows += [(url, source, group, q, a, c, None) for q, a, c in parse(html or "")]
                except Exception as e:  # noqa: BLE001
                    rows.append((url, source, group, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["url", "source", "source_group", "question", "answer", "category", "error"])

    return finished_faq(pages.select("url", "source", "source_group", "html").mapInPandas(run, FAQ))


def finished_faq(rows: DataFrame) -> DataFrame:
    """Collapsed texts, ids from source, question, answer and address; blanks out, first of each id kept."""
    clean = [collapse_or_empty(F.col(c)).alias(c) for c in ("source", "source_group", "category", "question", "answer", "url")]
    error = F.col("error") if "error" in rows.columns else F.lit(None).cast("string")
    out = rows.select(*clean, error.alias("error")).filter(F.col("error").isNotNull() | ~(is_blank(F.col("question")) | is_blank(F.col("answer"))))
    out = out.withColumn("id", digest(F.col("source"), F.col("question"), F.col("answer"), F.col("url")))
    return best_per_key(out, ["id"], [F.col("category"), F.col("source_group")])


# The marks of questions and answers in plain text.
_ASK, _REPLY = r"(?:Câu\s*hỏi|Hỏi)\s*(?:số\s*)?\d*\s*[:.\-]?", r"(?:Trả\s*lời|Đáp)\s*[:.\-]?"
TEXT_PAIRS = rf"(?isu){_ASK}\s*(.+?)\s*{_REPLY}\s*(.+?)(?={_ASK}|\z)"


def text_pairs(df: DataFrame, text: str) -> DataFrame:
    """One row (question, answer) for each marked pair of a plain text, beside the other columns."""
    both = F.arrays_zip(F.regexp_extract_all(F.col(text), F.lit(TEXT_PAIRS), 1).alias("question"), F.regexp_extract_all(F.col(text), F.lit(TEXT_PAIRS), 2).alias("answer"))
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(both).alias("x")).select(*rest, collapse_or_empty(F.col("x.question")).alias("question"), collapse_or_empty(F.col("x.answer")).alias("answer")).filter("question <> '' AND answer <> ''")


def postback(href: Column) -> Column:
    """struct<target,argument> of a form postback link, null for other links."""
    target = r"__doPostBack\('([^']+)',\s*'([^']*)'\)"
    return F.when(href.rlike(target), F.struct(F.regexp_extract(href, target, 1).alias("target"), F.regexp_extract(href, target, 2).alias("argument")))


def last_page(hrefs: Column, parameter: str = "Page") -> Column:
    """The largest page number in the addresses' queries, 1 without any."""
    numbers = F.transform(hrefs, lambda h: F.regexp_extract(h, rf"[?&]{parameter}=(\d+)(?:&|$)", 1))
    return F.coalesce(F.array_max(F.transform(F.filter(numbers, lambda x: x != ""), lambda x: x.cast("int"))), F.lit(1))


def without_fence(c: Column) -> Column:
    """The text inside a Markdown code fence, or the trimmed text if there is none."""
    body = F.regexp_replace(F.trim(c), r"(?s)^```[^\n]*\n?", "")
    return F.when(F.trim(c).startswith("```"), F.trim(F.regexp_replace(body, r"(?s)\n?[ \t]*```[ \t]*$", ""))).otherwise(F.trim(c))


def complete_objects(text: str) -> list[dict]:
    """The elements of a JSON array; of a broken one, the complete objects at its top level."""
    try:
        found = json.loads(text)
        return [x for x in found if isinstance(x, dict)] if isinstance(found, list) else []
    except json.JSONDecodeError:
        decoder, out, at = json.JSONDecoder(), [], text.find("{")
        while at >= 0:
            try:
                value, end = decoder.raw_decode(text, at)
                out.append(value)
            except json.JSONDecodeError:
                end = _close(text, at)
            at = text.find("{", end) if end else -1
        return out


def _close(text: str, at: int) -> int:
    """The position behind the brace that closes the one at `at`; 0 if it stays open."""
    depth = 0
    for m in re.compile(r'"(?:[^"\\]|\\.)*"|[{}]').finditer(text, at):
        depth += {"{": 1, "}": -1}.get(m[0], 0)
        if not depth:
            return m.end()
    return 0


def generated_documents(df: DataFrame, text: str, fields: list[str], expected: int, sources: list[str]) -> DataFrame:
    """The valid ones of the first `expected` objects of a model's answer, with the canonical source.

    An object is valid if all `fields` are non-blank texts; these are stripped. Answers without a valid
    object give no row.
    """
    rest = [c for c in df.columns if c != text]

    @F.pandas_udf(f"array<struct<{', '.join(f'`{c}`:string' for c in fields)}>>")
    def run(column: pd.Series) -> pd.Series:
        valid = lambda d: all(isinstance(d.get(c), str) and d[c].strip() for c in fields)
        return column.map(lambda x: [{c: d[c].strip() for c in fields} for d in complete_objects(x)[:expected] if valid(d)], na_action="ignore")

    rows = df.select(*rest, F.explode(run(without_fence(F.col(text)))).alias("_x")).select(*rest, "_x.*")
    return canonical_name(rows, "source", sources, "_canonical", keep_unknown=True).withColumn("source", F.col("_canonical")).drop("_canonical")


def stored_documents(df: DataFrame, text: str, fields: list[str], legacy: str = "answer") -> DataFrame:
    """Adds `error` to stored records, one JSON text each: null if valid.

    'incompatible': no object with exactly the fields, or these and the legacy field; 'invalid': a field is
    no text or blank. A null text is incompatible.
    """
    wanted = (set(fields), {*fields, legacy})

    def check(x: str | None) -> str | None:
        try:
            d = json.loads(x) if x is not None else None
        except ValueError:
            d = None
        if not isinstance(d, dict) or set(d) not in wanted:
            return "incompatible"
        return None if all(isinstance(v, str) and v.strip() for v in d.values()) else "invalid"

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([check(x) for x in column], dtype=object)

    return df.withColumn("error", run(F.col(text)))


def salvaged(df: DataFrame, text: str, fields: list[str], limit: str | None = None) -> DataFrame:
    """One row for each complete object with all `fields` filled; stripped; at most `limit` of a text."""
    rest = [c for c in df.columns if c != text]

    @F.pandas_udf(f"array<struct<{', '.join(f'`{c}`:string' for c in fields)}>>")
    def run(column: pd.Series) -> pd.Series:
        keep = lambda d: all(isinstance(d.get(c), str) and d[c].strip() for c in fields)
        return column.map(lambda x: [{c: d[c].strip() for c in fields} for d in complete_objects(x) if keep(d)], na_action="ignore")

    found = run(without_fence(F.col(text)))
    return df.select(*rest, F.explode(F.slice(found, 1, F.col(limit)) if limit else found).alias("_x")).select(*rest, "_x.*")


