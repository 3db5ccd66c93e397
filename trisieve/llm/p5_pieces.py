"""Problem 5: items above a size limit are cut into pieces at natural boundaries, with overlap.

Method: structure-tree packing. A text is a tree: sections by the level of their headings, in these lists
with nested items, tables of rows, code of lines and paragraphs; below lines, sentences, clauses, words and
grapheme clusters. The pieces of oversized subtrees are made first, then siblings are merged bottom-up to the
limit; only oversized nodes are descended into.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisieve.runtime import spread

LIMIT = 384
OVERLAP = 48

_HEADING = re.compile(r"(?m)^(?:(#{1,6})\s+\S.*|(={2,6})[^=\n].*|\\((?:sub)*)section\*?\{.*|<h([1-6])\b.*)$", re.I)
_LINE = re.compile(r"\n+|<br\s*/?>|</(?:li|tr|p|div)>\s*", re.I)
_SENTENCE = re.compile(r"[.!?…]+[\"”’»)\]]*\s+|[。！？]+[”’」]*\s*")
_CLAUSE = re.compile(r"[,;:–—]\s+|[，；：、]")
_BLANK = re.compile(r"\s+")
_CLUSTER = regex.compile(r"\X")


def _cuts(pattern: re.Pattern, text: str, start: int, end: int) -> list[tuple[int, int]]:
    spans, at = [], start
    for m in pattern.finditer(text, start, end):
        if at < m.end() < end:
            spans.append((at, m.end()))
            at = m.end()
    spans.append((at, end))
    return spans


def _sections(text: str, start: int, end: int, depth: int) -> list[tuple[int, int, int]]:
    """(start, end, level of its heading) of the top sections; the text before the first has level 9."""
    marks = [(m.start(), len(m[1] or m[2] or "") or (len(m[3]) // 3 + 1 if m[3] is not None else int(m[4] or 1))) for m in _HEADING.finditer(text, start, end)]
    marks = [x for x in marks if x[1] > depth]
    if not marks:
        return [(start, end, 9)]
    top = min(x[1] for x in marks)
    starts = [x for x in marks if x[1] == top]
    out = [(start, starts[0][0], 9)] if starts[0][0] > start else []
    out += [(s, starts[i + 1][0] if i + 1 < len(starts) else end, top) for i, (s, _) in enumerate(starts)]
    return out


LEVELS = [_LINE, _SENTENCE, _CLAUSE, _BLANK, _CLUSTER]
_FENCES = [(re.compile(r"\s*(?:```|~~~)"), re.compile(r"\s*(?:```|~~~)\s*$")), (re.compile(r"\s*<pre\b", re.I), re.compile(r".*</pre\s*>", re.I)), (re.compile(r"\s*\\begin\{(?:verbatim|lstlisting)\}"), re.compile(r".*\\end\{(?:verbatim|lstlisting)\}"))]
_TABLES = [(re.compile(r"\s*\{\|"), re.compile(r"\s*\|\}")), (re.compile(r"\s*<table\b", re.I), re.compile(r".*</table\s*>", re.I))]
_ITEM = re.compile(r"([^\S\n]*)(?:[-+*•#]+|\d{1,3}[.)]|<li\b[^>]*>|\\item\b)(?=\s|\S)(?:[^\S\n]+|(?<=>))", re.I)
_ROW = re.compile(r"[^\S\n]*\|")


@dataclass(frozen=True)
class Node:
    """A subtree: the span of its text, what it is, and the depth of its headings or its level below the line."""

    start: int
    end: int
    kind: str
    level: int = 0


def _lines(text: str, start: int, end: int) -> list[tuple[int, int]]:
    out = []
    while start < end:
        at = text.find("\n", start, end)
        at = end if at < 0 else at + 1
        out.append((start, at))
        start = at
    return out


def blocks(text: str, start: int, end: int) -> list[Node]:
    """Code, tables, lists, headings and paragraphs of a stretch, each with the blank lines behind it.

    What has no end of its own reaches to the end of the stretch.
    """
    out: list[list] = []
    closing = None
    for s, e in _lines(text, start, end):
        line = text[s:e]
        if closing is not None:
            out[-1][1] = e
            if closing.match(line) and s > out[-1][0]:
                closing = None
            continue
        opened = next((("code", stop) for first, stop in _FENCES if first.match(line)), None) or next((("table", stop) for first, stop in _TABLES if first.match(line)), None)
        if opened:
            out.append([s, e, opened[0], "closed"])
            inside = line.strip()
            closing = None if opened[1].match(line) and len(inside) > 3 and not inside.startswith(("```", "~~~", "{|")) else opened[1]
            continue
        if not line.strip():
            if out:
                out[-1][1] = e
                out[-1][3] = "closed" if out[-1][2] != "list" else out[-1][3]
            else:
                out.append([s, e, "paragraph", "closed"])
            continue
        kind = "heading" if _HEADING.match(line) else "list" if _ITEM.match(line) else "rows" if _ROW.match(line) else "paragraph"
        last = out[-1] if out else None
        if last and last[3] == "open" and (last[2] == kind or last[2] == "list" and line[:1].isspace()) and kind != "heading":
            last[1] = e
        elif last and last[3] == "open" and last[2] == "list" and kind == "paragraph" and text[last[1] - 2 : last[1]].strip():
            last[1] = e  # the item goes on
        else:
            out.append([s, e, kind, "open"])
    return [Node(s, e, "table" if kind == "rows" else kind) for s, e, kind, _ in out]


def items(text: str, start: int, end: int) -> list[Node]:
    """The items of a list; deeper indented lines belong to the item above."""
    out: list[list[int]] = []
    base = None
    for s, e in _lines(text, start, end):
        m = _ITEM.match(text[s:e])
        base = len(m[1]) if m and base is None else base
        if m and len(m[1]) <= base or not out:
            out.append([s, e])
        else:
            out[-1][1] = e
    return [Node(s, e, "item") for s, e in out]


def children(text: str, node: Node) -> list[Node]:
    """The subtrees of a node, which together are its text."""
    s, e = node.start, node.end
    if node.kind == "section":
        return [Node(a, b, "body") if level == 9 else Node(a, b, "section", level) for a, b, level in _sections(text, s, e, node.level)]
    if node.kind == "body":
        return blocks(text, s, e)
    if node.kind == "list" and len(found := items(text, s, e)) > 1:
        return found
    if node.kind in ("list", "item"):
        first = _lines(text, s, e)[0][1]
        nested = blocks(text, first, e) if first < e else []
        if any(x.kind == "list" for x in nested):
            return [Node(s, first, "run", 1), *nested]
    if node.kind in ("table", "code", "list", "item", "heading", "paragraph"):
        return [Node(a, b, "run", 1) for a, b in _cuts(_LINE, text, s, e)]
    return [Node(a, b, "run", node.level + 1) for a, b in _cuts(LEVELS[node.level], text, s, e)]


def cut(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Spans without overlap that cover the text; the first fits the limit, the others the limit less the overlap."""
    if limit <= overlap or overlap < 0:
        raise ValueError("the limit must be above the overlap")
    room = limit - overlap

    def fits(start: int, end: int) -> bool:
        return end - start <= (room if start else limit)

    def pack(node: Node, lead: int) -> list[tuple[int, int]]:
        """The pieces of a subtree; the first begins at `lead`, a short piece before it such as a heading."""
        if fits(lead, node.end):
            return [(lead, node.end)]
        if node.level == len(LEVELS):  # one cluster above the limit
            edges = [lead, *range(node.start + (0 if lead < node.start else room), node.end, room), node.end]
            return list(zip(edges, edges[1:], strict=False))
        out = [(lead, node.start)] if lead < node.start else []
        for child in children(text, node):
            if out and fits(out[-1][0], child.end):
                out[-1] = (out[-1][0], child.end)
            elif fits(child.start, child.end):
                out.append((child.start, child.end))
            else:
                short = out and out[-1][1] - out[-1][0] <= room // 2
                out += pack(child, out.pop()[0] if short else child.start)
        return out

    return [(s, e) for s, e in pack(Node(0, len(text), "section"), 0) if e > s]


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start of the overlap, start, end) of each piece."""
    out: list[tuple[int, int, int]] = []
    for i, (s, e) in enumerate(cut(text, limit, overlap)):
        back = s
        if i and overlap:
            low = max(out[-1][1], s - overlap)
            # from a word's beginning, else from that of a cluster
            starts = [m.end() for m in _BLANK.finditer(text, low, s) if m.end() < s]
            if low > 0 and text[low - 1].isspace() and not text[low].isspace():
                starts.insert(0, low)
            back = starts[0] if starts else next((m.start() for m in _CLUSTER.finditer(text, max(0, low - 8), s) if m.start() >= low), s)
        out.append((back, s, e))
    return out


def _split(limit: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rid, text in zip(pdf["data_id"], pdf["text"], strict=True):
                found = pieces(text, limit, overlap)
                rows += [(rid, i + 1, len(found), s, s - b, text[b:e]) for i, (b, s, e) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["data_id", "piece_no", "n_pieces", "start", "overlap", "text"]).astype({"piece_no": "int32", "n_pieces": "int32", "start": "int32", "overlap": "int32"})

    return run


PIECES = "data_id string, piece_no int, n_pieces int, start int, overlap int, text string"


def long_pieces(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The pieces of the items above the limit only; see split_items."""
    rows = df.select(F.col(id_col).cast("string").alias("data_id"), F.col(text_col).cast("string").alias("text")).filter(F.length("text") > limit)
    return spread(rows).mapInPandas(_split(limit, overlap), PIECES)


def split_items(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(data_id, piece_no, n_pieces, start, overlap, text): numbered pieces of at most `limit` code points.

    Each piece after the first begins with `overlap` characters of the one before (at most the given
    number, from a word's beginning); without them the pieces give the text back exactly. Items within
    the limit, blank ones too, are one piece and never leave the JVM; null texts give no row, repeated
    rows are cut each; an empty table gives an empty result; other columns are ignored.
    """
    short = df.select(F.col(id_col).cast("string").alias("data_id"), F.col(text_col).cast("string").alias("text")).filter(F.length("text") <= limit)
    short = short.select("data_id", F.lit(1).alias("piece_no"), F.lit(1).alias("n_pieces"), F.lit(0).alias("start"), F.lit(0).alias("overlap"), "text")
    return long_pieces(df, id_col, text_col, limit, overlap).unionByName(short)


def oversized_ids(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(data_id) of each row that the splitter cuts into more than one piece."""
    return long_pieces(df, id_col, text_col, limit, overlap).filter("piece_no = 2").select("data_id")
