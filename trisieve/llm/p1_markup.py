"""Problem 1: leftovers of HTML, Markdown, wiki and LaTeX markup.

Method: consensus host paths. Each page (a value with containers) is split into the runs of text that lie
directly in one container, or outside of all. Every run scores its generalised tag-class path by text and
link density, the bounded scores of the pages are votes for each host (source) in Spark, and each page is
extracted again from the runs on its host's winning paths. Fragments without containers are one run.
Headings, lists, tables, code and formulas stay visible in plain form.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.entities import html5

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisieve.runtime import bounded_join, materialize, spread

#: A path wins at a host if its votes add up to at least this. With fewer than MIN_PAGES votes there, those of
#: all hosts decide; with fewer than MIN_PAGES in all, the path wins.
WIN_SCORE = 0.0
MIN_PAGES = 3
#: Markup may come to light when what covers it is gone; code and formulas are safe by then.
PASSES = 3

# Tag names of HTML and of wiki extensions.
TAGS = (
    "a abbr address article aside b big blockquote body br button caption center cite code col colgroup dd del details div dl dt em figcaption "
    "figure font footer form gallery h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark math meta nav "
    "nowiki ol option p poem pre q ref references s samp script section select small source span strike strong style sub summary sup svg "
    "syntaxhighlight table tbody td textarea tfoot th thead time title tr tt u ul var video wbr"
).split()
CONTAINERS = {"article", "aside", "body", "div", "footer", "header", "main", "nav", "section", "table", "td", "ul", "ol", "form"}
_T = "|".join(sorted(TAGS, key=len, reverse=True))
_LONG = "|".join(t for t in sorted(TAGS, key=len, reverse=True) if len(t) > 1)

#: Any value with markup has at least one of these: every pattern of MARKS and NAMED needs one.
SUSPECT = r"(?m)[<>\[\]{}*#|`$\\_~]|''|&[#A-Za-z]|==|=[\"']|^[^\p{L}\p{N}\n]*[-+!:;]"
#: Windows paths, which are no LaTeX.
PATH = re.compile(r"\b[A-Za-z]:\\(?:[^\\\s(){}$]+\\)*[^\\\s(){}$]*")

# what cannot be taken for ordinary signs
HTML_MARKS = [
    r"<!--|-->|<!DOCTYPE\b|<!\[CDATA\[|\]\]>",
    rf"</?(?:{_T})(?:\s[^<>]*)?/?>",
    rf"<(?:{_T})\s+[A-Za-z][\w:-]*\s*=",
    rf"</(?:{_T})\b",
    rf"<(?:{_LONG})(?:\s[^<>]*)?$",
    rf"(?<![<\w/.-])/?(?:{_LONG})\s*/?>(?=\s|$|\w|<)",
    r"\b(?:class|style|href|src|id|width|colspan)=[\"'][^\"']*[\"']",
    r"&#\d{1,7};?|&#[xX][0-9a-fA-F]{1,6};?",
    r"<https?://[^\s>]*>",
]
WIKI_MARKS = [
    r"\[\[|\]\]|\{\{|\}\}|''|\{\||\|\}",
    r"(?m)^={2,6}\s*[^=\s][^\n]*$|^={3,}\s*$",
    r"__[A-Z]{3,}__",
    r"\[(?:https?|ftp|mailto):",
    r"(?m)^\|[-+}]|^[!|]\s|^[*#:;]+\s*\S",
    r"~{3,5}|#(?:REDIRECT|ĐỔI)\b|\bformula_\d+",
]
MARKDOWN_MARKS = [
    r"(?m)^\s{0,3}#{1,6}\s",
    r"\*\*|~~|`",
    r"(?<![\w*\\])\*(?=[^\s*])[^*\n]*[^\s*]\*(?![\w*])",
    r"(?<![\w_\\])_(?=[^\s_])[^_\n]*[^\s_]_(?!\w)",
    r"(?<!\w)__(?=\S)|(?<=\S)__(?!\w)",
    r"(?m)^\s{0,3}>\s?\S",
    r"(?m)^\s*[-+*]\s+\S",
    r"\]\([^)\s]|!\[|\[\^[^\]\s]+\]|\]\[\w*\]",
    r"(?m)^\s*\|.*\|\s*$|\|\s*:?-{3,}",
    r"(?m)^\s*(?:-{3,}|\*{3,}|_{3,})\s*$",
]
LATEX_MARKS = [
    r"\\[A-Za-z]{2,}|\\[()\[\]{}%&$#_,;!]",
    r"\\\\(?=\s|$|\[)",
    r"\$\$",
    r"\$(?=[^\s$])(?=[^$\n]*[\\^_=+])(?![^$\n]*\d\s[^\W\d_]{2,})[^$\n]+(?<=\S)\$",
    r"[\w})\]][\^_]\{|\\[^\w\s]",
]
MARKS = [re.compile(x, re.I if i < len(HTML_MARKS) - 1 else 0) for i, x in enumerate(HTML_MARKS + WIKI_MARKS + MARKDOWN_MARKS + LATEX_MARKS)]
NAMED = re.compile(r"&([A-Za-z][A-Za-z0-9]{1,31});|&(nbsp|amp|lt|gt|quot|ndash|mdash|hellip|copy|middot)\b")


def marks(text: str) -> int:
    """The number of pieces of markup syntax, whole or broken, in a value."""
    bare = PATH.sub(" ", text)
    n = sum(len(p.findall(bare)) for p in MARKS)
    return n + sum(1 for m in NAMED.finditer(bare) if m[2] or m[1] + ";" in html5)


# --- containers and their paths ---------------------------------------------------------------

_TAG = re.compile(rf"<(/?)({_T})\b([^<>]*)>", re.I)
_CLASS = re.compile(r"class\s*=\s*[\"']?([^\"'>]*)", re.I)
_LINKED = re.compile(r"(?is)<a\b[^>]*>(.*?)(?:</a>|$)")
_PARAGRAPH = re.compile(r"(?i)<p\b")
VOID = {"br", "hr", "img", "input", "link", "meta", "source", "wbr", "col"}


def runs(text: str) -> list[tuple[str, int, int]]:
    """(generalised path, start, end) of the runs of a value, in order; together they are the value.

    A run lies directly in one closed container, with whose tags it begins and ends; the path has the open
    tags and their classes without digits, and is empty outside of all containers. An unclosed container is
    none: what follows it may not belong to it.
    """
    stack: list[tuple[str, str, int]] = []
    found: list[tuple[int, int, str]] = []
    for m in _TAG.finditer(text):
        tag = m[2].lower()
        if tag in VOID or m[3].rstrip().endswith("/"):
            continue
        if not m[1]:
            attribute = _CLASS.search(m[3])
            name = tag + "".join("." + re.sub(r"\d+", "#", c.lower()) for c in sorted((attribute[1] if attribute else "").split()))
            stack.append((tag, name, m.start()))
            continue
        at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
        if at is None:
            continue
        if tag in CONTAINERS:
            found.append((stack[at][2], m.end(), "/".join(x[1] for x in stack[: at + 1])))
        del stack[at:]
    out: list[tuple[str, int, int]] = []
    open_: list[tuple[int, str]] = [(len(text), "")]
    place = 0

    def upto(end: int) -> None:
        nonlocal place
        if end > place:
            out.append((open_[-1][1], place, end))
            place = end

    for start, end, path in sorted(found, key=lambda x: (x[0], -x[1])):
        while open_[-1][0] <= start:
            upto(open_[-1][0])
            open_.pop()
        upto(start)
        open_.append((end, path))
    while open_:
        upto(open_[-1][0])
        open_.pop()
    return out


def votes(text: str) -> dict[str, float]:
    """The vote of a page on each of its paths, between -1 and 1.

    That is the share of plain text less three times the share of linked text, and a fifth for each
    paragraph; a path without text has no vote.
    """
    sums: dict[str, list[float]] = {}
    for path, start, end in runs(text):
        body = text[start:end]
        plain = len(_TAG.sub("", body).strip())
        if plain:
            linked = sum(len(_TAG.sub("", x)) for x in _LINKED.findall(body))
            row = sums.setdefault(path, [0.0, 0.0, 0.0])
            row[0] += plain
            row[1] += linked
            row[2] += 0.2 * len(_PARAGRAPH.findall(body))
    return {path: max(-1.0, min(1.0, 1 - 3 * linked / plain + extra)) for path, (plain, linked, extra) in sums.items()}


def winning(text: str, winners: set[str]) -> str:
    """The runs of a page on winning paths; all of it if none of them has text."""
    parts = [(path, text[start:end]) for path, start, end in runs(text)]
    if not any(path in winners and _TAG.sub("", body).strip() for path, body in parts):
        return text
    return "".join(body if path in winners or not _TAG.sub("", body).strip() else "\n" for path, body in parts)


def _vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = [votes(t) for t in pdf["text"]]
        yield pdf.assign(paths=[list(v) for v in found], votes=[list(v.values()) for v in found])


PAGE = "(?i)<(?:" + "|".join(sorted(CONTAINERS)) + ")\\b"
VALUES = "data_id string, host string, field_name string, text string"


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, score, pages, wins): the vote of each host on its container paths."""
    flat = pages.select("host", F.explode(F.arrays_zip("paths", "votes")).alias("v")).select("host", F.col("v.paths").alias("path"), F.col("v.votes").alias("vote"))
    own = flat.groupBy("host", "path").agg(F.sum("vote").alias("score"), F.count(F.lit(1)).alias("pages"))
    every = own.groupBy("path").agg(F.sum("score").alias("all_score"), F.sum("pages").alias("all_pages"))
    wins = F.when(F.col("pages") >= MIN_PAGES, F.col("score") >= WIN_SCORE).when(F.col("all_pages") >= MIN_PAGES, F.col("all_score") >= WIN_SCORE).otherwise(True)
    return own.join(every, "path").select("host", "path", "score", "pages", wins.alias("wins"))


def with_winners(pages: DataFrame) -> DataFrame:
    """The pages with the winning ones among their own paths.

    The decisions meet the paths, not the texts, and each page gets its own winners only, so that no row
    grows with the number of paths of a host.
    """
    numbered = materialize(pages.mapInPandas(_vote, VALUES + ", paths array<string>, votes array<double>").withColumn("n", F.monotonically_increasing_id()), "p1v")
    decided = materialize(host_paths(numbered).filter("wins").select("host", "path"), "p1w")
    won = bounded_join(numbered.select("n", "host", F.explode("paths").alias("path")), decided, ["host", "path"], by=["n"], how="inner")
    lists = won.groupBy("n").agg(F.sort_array(F.collect_list("path")).alias("winners"))
    return numbered.join(lists, "n", "left").select("data_id", "host", "field_name", "text", "winners")


# --- clean text -------------------------------------------------------------------------------

# LaTeX commands with a sign of their own.
LATEX_SIGNS = {
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "epsilon": "ε", "theta": "θ", "lambda": "λ", "mu": "μ", "pi": "π", "rho": "ρ", "sigma": "σ", "tau": "τ", "phi": "φ", "omega": "ω",
    "Delta": "Δ", "Sigma": "Σ", "Omega": "Ω", "le": "≤", "leq": "≤", "ge": "≥", "geq": "≥", "neq": "≠", "ne": "≠", "approx": "≈", "times": "×", "cdot": "·", "pm": "±", "infty": "∞", "to": "→",
    "rightarrow": "→", "sum": "∑", "prod": "∏", "int": "∫", "partial": "∂", "in": "∈", "cup": "∪", "cap": "∩", "mid": "|", "ldots": "…", "dots": "…", "cdots": "⋯", "circ": "°", "quad": " ", "qquad": " ",
}

_CELL = "\x02"


def formula(body: str) -> str:
    """LaTeX formula code as linear plain text."""
    text = re.sub(r"\\(?:begin|end)\s*\{[^{}]*\}(?:\{[^{}]*\})?", " ", body)
    text = re.sub(r"(?<!\\)&", " ", re.sub(r"\\\\(?:\[[^\]]*\])?", "; ", text))
    for _ in range(4):
        new = re.sub(r"\\[dt]?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", r"(\1)/(\2)", text)
        new = re.sub(r"\\sqrt\s*\{([^{}]*)\}", r"√(\1)", new)
        new = re.sub(r"([\^_])\{([^{}]*)\}", lambda m: m[1] + (m[2] if len(m[2]) == 1 else f"({m[2]})"), new)
        new = re.sub(r"\\(?:text|mathrm|mathbf|mathit|operatorname|overline|hat|vec)\s*\{([^{}]*)\}", r"\1", new)
        if new == text:
            break
        text = new
    text = re.sub(r"\\([A-Za-z]+)", lambda m: LATEX_SIGNS.get(m[1], m[1]), re.sub(r"\*{2,3}|~~|\$\$", "", text))
    return re.sub(r"\s+", " ", re.sub(r"\\[,;!: ]|[{}\\]", " ", text)).strip()


def _table(rows: list[list[str]]) -> str:
    return "\n" + "\n".join("\t".join(" ".join(c.split()) for c in r) for r in rows if any(c.strip() for c in r)) + "\n"


def _wiki_table(m: re.Match) -> str:
    """The rows of a wiki table; lines that neither begin a cell nor follow one stay as they are."""
    first, *lines = m[1].split("\n")
    first = re.sub(r"[\w-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'|\S+)", "", first).strip()
    rows: list[list[str]] = [[first] if first else []]
    for line in lines:
        if line.startswith("|-"):
            rows.append([])
        elif line[:1] in ("|", "!"):
            rows[-1] += [c.rpartition("|")[2] if "=" in c else c for c in re.split(r"\|\||!!", line.lstrip("|!+"))]
        elif rows[-1]:
            rows[-1][-1] += " " + line
        else:
            rows[-1].append(line)
    return _table(rows)


def _open_wiki_table(m: re.Match) -> str:
    """A table without an end reaches as far as its lines that begin with a sign of a table."""
    return _wiki_table(m) + "\n"


def _html_table(m: re.Match) -> str:
    head, *parts = re.split(r"(?i)<tr\b[^>]*>", m[1])
    rows = []
    for part in parts:
        first, *cells = re.split(r"(?i)<t[dh]\b[^>]*>", part)
        rows.append([c for c in (re.sub(r"<[^>]*>", "", x) for x in (first, *cells)) if c.strip()])
    return "\n" + re.sub(r"<[^>]*>", " ", head).strip() + _table(rows)


def _link(m: re.Match) -> str:
    if re.match(r"(?i)\s*(?:file|image|media|tập tin|tập_tin|hình|thể loại|category)\s*:", m[1]):
        caption = m[1].rpartition("|")[2] if "|" in m[1] else ""
        return "" if re.fullmatch(r"(?i)\s*(?:nhỏ|phải|trái|giữa|thumb|left|right|center|\d+px|)\s*", caption) else caption
    return m[1].rpartition("|")[2]


def _template(m: re.Match) -> str:
    head, _, rest = m[1].partition("|")
    parts = [p for p in rest.split("|") if "=" not in p and p.strip()]
    return parts[-1] if parts and not re.match(r"(?i)\s*(?:chú thích|cite|thông tin|infobox|cần)", head) else ""


#: (pattern, replacement) in order; H, L and Q mark the start of headings, list items and quotations.
#: Kept parts stand as numbers between control characters meanwhile.
RULES: list[tuple[re.Pattern, object]] = [(re.compile(p), r) for p, r in [
    (r"(?s)<!--.*?-->", ""), (r"<!--|(?i:<!DOCTYPE[^<>\n]*>?)|<!\[CDATA\[|\]\]>", ""), (r"(?is)<(script|style)\b[^<>]*>.*?</\1\s*>", ""),
    (r"(?is)<ref\b[^<>]*/>", ""), (r"(?is)<ref\b[^<>]*>(?:(?!<ref\b).)*?</ref\s*>", ""),
    (r"(?is)<table\b[^<>]*>((?:(?!<table\b).)*?)</table\s*>", _html_table), (r"(?s)\{\|((?:(?!\{\|).)*?)\n\|\}", _wiki_table), (r"\{\|([^\n]*(?:\n[|!][^\n]*)*)", _open_wiki_table),
    (r"(?m)^\|\}|^\|-[^\n]*$", ""), (r"\b(?:class|style|href|src|id|width|colspan)=(?:\"[^\"]*\"|'[^']*')(?![^<>\n]*>)", ""), (r"(?i)<t[dh]\b[^<>]*>", "\t"),
    (r"(?i)<h([1-6])\b[^>]*>", "\n\n"), (r"(?i)</h[1-6]\s*>", "\n\n"), (r"(?i)<li\b[^>]*>", "\n• "), (r"(?i)<(?:br|hr)\b[^>]*>", "\n"),
    (r"(?i)</?(?:p|div|section|article|blockquote|ul|ol|dl|dt|dd|tr|table|header|footer|main|body|figure|pre)\b[^<>]*>", "\n"),
    (rf"(?i)</?(?:{_T})(?:\s[^<>]*)?/?>", ""), (r"<(https?://[^\s>]*)>", r"\1"),
    (rf"(?i)<(?:{_T})\s+[A-Za-z][\w:-]*\s*=[^<>\n]*(?:>|$)", ""), (rf"(?i)</?(?:{_LONG})\b[^<>\n]*$", ""), (rf"(?i)</(?:{_T})\b", ""), (rf"(?i)(?<![<\w/.-])/?(?:{_LONG})\s*/?>", ""),
    (r"\{\{([^{}]*)\}\}", _template), (r"\{\{([^{}]*)\}\}", _template), (r"\{\{([^{}]*)\}\}", _template),
    (r"\[\[([^\[\]]*)\]\]", _link), (r"\[(?:https?|ftp|mailto):\S*\s+([^\]\n]*)\]", r"\1"), (r"\[((?:https?|ftp)://[^\]\s]*)\]", r"\1"),
    (r"!\[([^\]\n]*)\]\([^)\n]*\)", r"\1"), (r"\[([^\]\n]*)\]\([^)\n]*\)", r"\1"), (r"\[\^[^\]\s]+\]:?", ""), (r"(?m)^\s*\[[^\]\n]+\]:\s*https?://\S+.*$", ""), (r"\[([^\[\]\n]+)\]\[\w*\]", r"\1"),
    (r"(?m)^[^\S\n]*(={2,6})[^\S\n]*([^=\n].*?)\s*=*\s*$", r"\n\2\n"), (r"(?m)^={3,}\s*$|^\s*-{3,}\s*$|^\s*\*{3,}\s*$|^\s*_{3,}\s*$", ""), (r"(?m)^\s{0,3}#{1,6}\s+(.*?)\s*#*\s*$", r"\n\1\n"),
    (r"(?m)^\s*\|?(?:\s*:?-{2,}:?\s*\|)+\s*:?-*:?\s*$\n?", ""), (r"(?m)^\s*\|(.*)\|\s*$", lambda m: "\t".join(c.strip() for c in m[1].split("|"))), (r"(?m)^[!|](?=\s)[^\S\n]*", ""), (r"&(nbsp|amp|lt|gt|quot|ndash|mdash|hellip|copy|middot)\b(?!;)", lambda m: html.unescape(f"&{m[1]};")),
    (r"(?m)^\s*[-+*]\s+\[[ xX]\]\s+", "• "), (r"(?m)^\s*(?:[-+*]|[*#]+)\s+(?=\S)", "• "), (r"(?m)^\s{0,3}>\s?", ""), (r"(?m)^[:;]+\s*(?=\S)", ""),
    (r"'{2,}", ""), (r"__[A-Z]{3,}__", ""), (r"\*{2,3}|~~|`+", ""), (r"(?<![\w*\\])\*(?=[^\s*])([^*\n]*[^\s*])\*(?![\w*])", r"\1"), (r"(?<![\w_\\])_(?=[^\s_])([^_\n]*[^\s_])_(?!\w)", r"\1"), (r"(?<!\w)__(?=\S)|(?<=\S)__(?!\w)", ""),
    (r"\\(?:begin|end)\s*\{(?:itemize|enumerate|description|center|quote|document|abstract|figure|table|tabular)\*?\}(?:\[[^\]]*\]|\{[^}]*\})?", "\n"), (r"\\item\b\s*(?:\[([^\]]*)\])?", r"\n• "),
    (r"\\(?:part|chapter|(?:sub)*section|paragraph)\*?\s*\{([^{}]*)\}", r"\n\n\1\n\n"), (r"[~ ]*\\(?:label|ref|eqref|cite[pt]?|index|pageref)\s*\{[^{}]*\}", ""), (r"\\footnote\s*\{([^{}]*)\}", r" (\1)"),
    (r"\\href\s*\{[^{}]*\}\s*\{([^{}]*)\}", r"\1"), (r"\\(?:emph|textbf|textit|texttt|underline|textsc|text|mbox|url|caption)\s*\{([^{}]*)\}", r"\1"), (r"\\([A-Za-z]+)\s*\{([^{}]*)\}", r"\2"),
    (r"\\([A-Za-z]{2,})", lambda m: LATEX_SIGNS.get(m[1], "")), (r"\\\\(?:\[[^\]]*\])?", "\n"), (r"\\([{}%&$#_])", r"\1"), (r"\\[()\[\]]|\$\$|\{\{|\}\}|\[\[|\]\]|\{\||\|\}|-->", ""), (r"\bformula_\d+", ""),
]]

_CODE = re.compile(r"(?is)```[\w-]*\n?(.*?)(?:```|$)|<pre\b[^>]*>\s*(?:<code\b[^>]*>)?(.*?)(?:</code>\s*)?(?:</pre>|$)|<(?:syntaxhighlight|source)\b[^>]*>(.*?)(?:</(?:syntaxhighlight|source)>|$)|\\begin\{(?:verbatim|lstlisting)\}(.*?)(?:\\end\{(?:verbatim|lstlisting)\}|$)|`([^`\n]+)`|<code\b[^>]*>(.*?)(?:</code>|$)")
_MATH = re.compile(r"(?s)\$\$(.+?)\$\$|\\\[(.+?)\\\]|\\\((.+?)\\\)|\\begin\{(?:equation|align|math|displaymath|gather)\*?\}(.+?)\\end\{(?:equation|align|math|displaymath|gather)\*?\}|<math\b[^>]*>(.+?)</math>|" + LATEX_MARKS[3].replace(r"[^$\n]+(?<=\S)\$", r"([^$\n]+)(?<=\S)\$"))


_SIGNS = re.compile(r"[<>\[\]{}*#|`$\\_~=^]|'{2,}|^\s*[-+!:;]+")


def extract(text: str) -> tuple[str, int]:
    """(clean text, pieces of markup taken out) of a value."""
    kept: list[str] = []
    pieces = 0

    def keep(body: str, block: bool) -> str:
        kept.append(body)
        sep = "\n" if block else ""
        return f"{sep}\x01{len(kept) - 1}\x01{sep}"

    def code(m: re.Match) -> str:
        inline = m[5] or (m[6] if m[6] and "\n" not in m[6] else None)
        body = inline or m[1] or m[2] or m[3] or m[4] or m[6] or ""
        body = html.unescape(re.sub(rf"(?i)</?(?:{_T})\b[^<>]*>", "", body))
        return keep(body, False) if inline else keep("\n".join("    " + x for x in body.strip("\n").split("\n")), True)

    def change(pattern: re.Pattern, with_, text: str) -> str:
        nonlocal pieces
        text, n = pattern.subn(with_, text)
        pieces += n
        return text

    text = PATH.sub(lambda m: keep(m[0], False), text)
    text = change(_CODE, code, text)
    text = change(_MATH, lambda m: keep(formula(next(g for g in m.groups() if g)), m[0][:2] in ("$$", "\\[", "\\b")), text)
    for _ in range(PASSES):
        for pattern, with_ in RULES:
            text = change(pattern, with_, text)
        plain = html.unescape(text)
        pieces += plain != text
        text = plain.replace("\xa0", " ")
        if not marks(text):
            break
    else:
        # broken pieces that no rule knows lose their signs
        for pattern in MARKS:
            text = change(pattern, lambda m: _SIGNS.sub("", m[0]), text)
    text = re.sub(r"[^\S\n\t]+", " ", text)
    text = re.sub(r" ?\n ?", "\n", re.sub(r"\n{3,}", "\n\n", text))
    for _ in range(3):
        text = re.sub("\x01(\\d+)\x01", lambda m: kept[int(m[1])], text)
    return text.strip(), pieces


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for text, winners in zip(pdf["text"], pdf["winners"], strict=True):
            chosen = text if winners is None else winning(text, set(winners))
            clean, n = extract(chosen)
            n += chosen != text
            rows.append((n, clean if n else text))
        yield pd.DataFrame({"data_id": pdf["data_id"], "field_name": pdf["field_name"], "marks": pd.array([n for n, _ in rows], dtype="int32"), "text": [t for _, t in rows]})


def clean_values(df: DataFrame, id_col: str, host_col: str, fields: list[str], only_marked: bool = False) -> DataFrame:
    """(data_id, field_name, marks, text): each non-null value as clean text and the pieces of markup taken out.

    Values without markup come out unchanged. Blank values stay blank, null values give no row, a null
    host is a host of its own, repeated rows stay; an empty table gives an empty result; other columns
    are ignored. `only_marked` leaves out the values without markup.
    """
    values = df.select(F.col(id_col).cast("string").alias("data_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("text")) for c in fields])).alias("v")).select("data_id", "host", "v.*").filter("text IS NOT NULL")
    # values without any of the signs never leave the JVM
    suspect = values.filter(F.col("text").rlike(SUSPECT))
    fragments = suspect.filter(~F.col("text").rlike(PAGE)).withColumn("winners", F.lit(None).cast("array<string>"))
    pages = with_winners(spread(suspect.filter(F.col("text").rlike(PAGE))))
    cleaned = spread(fragments).unionByName(pages).select("text", "winners", "data_id", "field_name").mapInPandas(_extract, "data_id string, field_name string, marks int, text string")
    if only_marked:
        return cleaned.filter("marks > 0")
    plain = values.filter(~F.col("text").rlike(SUSPECT)).select("data_id", "field_name", F.lit(0).alias("marks"), "text")
    return cleaned.unionByName(plain)


def marked_ids(df: DataFrame, id_col: str, host_col: str, fields: list[str]) -> DataFrame:
    """(data_id, field_name) of each value from which the extraction took markup; see clean_values."""
    return clean_values(df, id_col, host_col, fields, only_marked=True).select("data_id", "field_name")
