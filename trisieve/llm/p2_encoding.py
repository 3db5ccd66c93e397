"""Problem 2: text garbled by a wrong character encoding.

Method: expectation-maximisation with latent encoding chains per source and field. Each suspicious value
gives the evidence of every chain (a way of misreading): how many of its odd stretches it explains, and how
many of the best one's it misses. The chain is latent: the E step weighs the chains and clean text for each
value, the M step estimates, for each source and field, the rates of the chains, how many stretches damaged
and clean values show and how many a true chain misses, so that weak evidence of many records is pooled. The
posterior decides, and its most probable chain repairs the value.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisieve.runtime import bounded_join, materialize, spread

#: Encodings with which UTF-8 bytes may have been read; several may be chained.
CODECS = ["cp1252", "latin-1", "cp1258", "cp1250", "cp1251", "cp437", "cp850", "cp866", "mac_roman", "koi8-r"]
CASED = ("cp1252", "latin-1", "cp1258")
VARIANTS = ("", "-lower", "-upper")
#: Stretches counted; more are as many. Chains kept as candidates of a value.
MOST = 6
CANDIDATES = 4
STEPS = 20

#: First guess of the chance that a clean value shows one more stretch like a product of the kind of chain, and
#: its weight as a multiple of the number of values; what clean values show is added in the M step. The form of
#: UTF-8 is known not to come about by itself, which is not to be learnt from a corpus full of it.
CHANCE = {"utf8": (1e-6, 1000.0), "lost": (1e-6, 1000.0), "cut": (0.03, 1.0), "tcvn3": (0.01, 1.0), "vni": (0.01, 1.0), "lone": (0.03, 1.0)}
#: First guess of the share of stretches that a true chain misses, and its weight in stretches.
MISS, GUESS = 0.02, 1000.0
#: Weight, in values, of the field's overall rates in those of one source.
POOL = 5.0
THRESHOLD = 0.5

# The letters of the two legacy Vietnamese encodings, as Latin-1 text shows them.
TCVN3 = dict(zip(
    "µ¸¶·¹¨»¾¼½Æ©ÇÊÈÉË®ÌÐÎÏÑªÒÕÓÔÖ×ÝØÜÞßãáâä«åèæçé¬êíëìîïóñòô\xadõøö÷ùúýûüþ¡¢£¤¥¦§",
    "àáảãạăằắẳẵặâầấẩẫậđèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵĂÂÊÔƠƯĐ", strict=True,
))
VNI_SINGLE = dict(zip("ñöôíìæóòîÑÖÔÍÌÆÓÒÎ", "đươíìỉĩịỵĐƯƠÍÌỈĨỊỴ", strict=True))
VNI_TONES = dict(zip("ùøûõï", "̣́̀̉̃", strict=True))
VNI_HATS = dict(zip("âáàåãä", ["̂", "̂́", "̂̀", "̂̉", "̂̃", "̣̂"], strict=True))
VNI_BREVES = dict(zip("êéèúüë", ["̆", "̆́", "̆̀", "̆̉", "̆̃", "̣̆"], strict=True))

_VNI = re.compile("([aeoAEO])([âáàåãäÂÁÀÅÃÄ])|([aA])([êéèúüëÊÉÈÚÜË])|([aeouyôöAEOUYÔÖ])([ùøûõïÙØÛÕÏ])|([ñöôíìæóòîÑÖÔÍÌÆÓÒÎ])")
_SYLLABLE = re.compile(
    "(?:ngh|ng|nh|ch|gh|gi|kh|ph|qu|th|tr|[bcdđghklmnpqrstvx])?"
    "(?:uyê|uya|uyu|iêu|yêu|oai|oay|oao|oeo|uây|uôi|ươi|ươu|iê|yê|oa|oă|oe|oi|oo|ôi|ơi|ua|uâ|uê|ui|uô|uơ|uy|ưa|ưi|ươ|ưu|ai|ao|au|ay|âu|ây|eo|êu|ia|iu|[aăâeêioôơuưy])"
    "(?:ch|ng|nh|[cmnpt])?"
)
_TONES = re.compile("[̣̀́̃̉]")
_WORD = re.compile(r"[^\s!-@\[-`{-~…“”‘’–—]+")
_LONE = re.compile(r"(?<!\w)[ÃÂ](?!\w)")

@lru_cache(maxsize=100_000)
def vietnamese(word: str) -> bool:
    """Whether the word has the shape of a Vietnamese syllable."""
    if not word or any(ord(c) < 0x80 and not c.isalpha() for c in word):
        return False
    parts = unicodedata.normalize("NFD", word.lower())
    if len(_TONES.findall(parts)) > 1:
        return False
    return _SYLLABLE.fullmatch(unicodedata.normalize("NFC", _TONES.sub("", parts))) is not None


@lru_cache(maxsize=100_000)
def from_tcvn3(word: str) -> str:
    return "".join(TCVN3.get(c, c) for c in word)


@lru_cache(maxsize=100_000)
def from_vni(word: str) -> str:
    def letter(m: re.Match) -> str:
        if m[1]:
            return m[1] + VNI_HATS[m[2].lower()]
        if m[3]:
            return m[3] + VNI_BREVES[m[4].lower()]
        if m[5]:
            return VNI_SINGLE.get(m[5], m[5]) + VNI_TONES[m[6].lower()]
        return VNI_SINGLE[m[7]]

    return unicodedata.normalize("NFC", _VNI.sub(letter, word))


def _table(codec: str) -> dict[int, str]:
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[b] = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            out[b] = chr(b)
    return out


class Misread:
    """UTF-8 bytes read with one codec, perhaps lower-cased or upper-cased afterwards."""

    def __init__(self, codec: str) -> None:
        table = _table(codec)
        self.bytes_of: list[dict[str, list[int]]] = []
        self.patterns = []
        for change in (str, str.lower, str.upper):
            chars = {b: change(c) if len(change(c)) == 1 else c for b, c in table.items()}
            codes: dict[str, list[int]] = {}
            for b, c in chars.items():
                codes.setdefault(c, []).append(b)
            self.bytes_of.append(codes)
            one = lambda lo, hi: "[" + "".join(re.escape(chars[b]) for b in range(lo, hi)) + "]"  # noqa: E731,B023
            follow = one(0x80, 0xC0)
            self.patterns.append(re.compile(f"{one(0xC2, 0xE0)}{follow}|{one(0xE0, 0xF0)}{follow}{{2}}|{one(0xF0, 0xF5)}{follow}{{3}}"))
            if change is str:
                self.cut = re.compile(f"{one(0xE1, 0xE3)}{follow}(?!{follow})")

    def decode(self, variant: int, stretch: str) -> str | None:
        """The character that the stretch stands for, or None if that is implausible."""
        options = [b""]
        for i, c in enumerate(stretch):
            # two bytes may have the same lower- or upper-case form: those that fit are tried
            fits = [b for b in self.bytes_of[variant][c] if (b >= 0xC2 if i == 0 else 0x80 <= b < 0xC0)]
            options = [o + bytes([b]) for o in options for b in fits]
        for o in options:
            try:
                char = o.decode("utf-8")
            except UnicodeDecodeError:
                continue
            if plausible(char) and (variant == 0 or ord(char) >= 0xA0):
                return char
        return None


@lru_cache(maxsize=100_000)
def plausible(char: str) -> bool:
    """Letters of the living scripts, common signs, and the controls that a chain leaves before its last reading."""
    o = ord(char)
    if o < 0x80 or o >= 0xA0 and unicodedata.category(char)[0] in "C" and o not in (0xAD, 0x200B, 0x200D, 0x2060, 0xFEFF):
        return False
    return o < 0x700 or 0x900 <= o < 0xE80 or 0x1E00 <= o < 0x1F00 or 0x2000 <= o < 0x2300 or 0x2500 <= o < 0x2800 or 0x3000 <= o < 0xA000 or 0xAC00 <= o < 0xD7B0 or 0xFB00 <= o < 0xFB10 or 0xFE00 <= o < 0xFFE8 or 0x1F000 <= o < 0x1FB00


@lru_cache(maxsize=1)
def misreads() -> dict[str, Misread]:
    return {codec: Misread(codec) for codec in CODECS}


def undo(text: str, codec: str, variant: int) -> tuple[str, int, int]:
    """The text with the codec's stretches decoded once, their number and length."""
    reading, found = misreads()[codec], [0, 0]

    pattern, last = reading.patterns[variant], [-1]

    def char(m: re.Match) -> str:
        got = reading.decode(variant, m[0])
        if got is None:
            return m[0]
        before, after = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
        if before.isalpha() and not after.isalpha() and all(c in "…–—‘’“”" for c in m[0][1:]):
            return m[0]  # a word that ends in the lead letter, and an ordinary sign
        if 0x370 <= ord(got) < 0x1000 and last[0] != m.start() and not pattern.match(text, m.end()):
            return m[0]  # a single letter of another script
        last[0] = m.end()
        found[0] += 1
        found[1] += len(m[0])
        return got

    return pattern.sub(char, text), found[0], found[1]


def _legacy_words(text: str) -> list[str]:
    return [w for w in (w.strip("«»") for w in _WORD.findall(text)) if len(w) > 1 and not w.isascii() and not vietnamese(w) and any(c < "\x80" for c in w)]


LEGACY = {"tcvn3": from_tcvn3, "vni": from_vni}


def evidence(text: str) -> list[tuple[str, int, int]]:
    """(chain, explained stretches, stretches of the best chain that it misses) of each candidate chain.

    The chains that explain most come first; a chain of UTF-8 reading names the codec and its change of
    case. Lost and cut characters and lone lead letters count only where no other chain explains anything.
    """
    found: list[tuple[int, int, str]] = []
    for codec in CODECS:
        for variant in (0, 1, 2) if codec in CASED else (0,):
            _, n, length = undo(text, codec, variant)
            if n:
                found.append((length, n, f"utf8 {codec}{VARIANTS[variant]}"))
    words = _legacy_words(text)
    for name, change in LEGACY.items():
        n = sum(1 for w in words if (d := change(w)) != w and vietnamese(d))
        if n and "\ufffd" not in text:
            found.append((2 * n, n, name))
    if found:
        found.sort(key=lambda x: -x[0])  # stable: an earlier codec of the same length stays first
        best = found[0]
        # what a chain leaves of the best one's length, in stretches of that
        return [(chain, min(MOST, n), min(MOST, -(-(best[0] - length) * best[1] // best[0]))) for length, n, chain in found[:CANDIDATES]]
    if "\ufffd" in text:
        return [("lost", min(MOST, text.count("\ufffd")), 0)]
    cuts = max(len(m.cut.findall(text)) for m in misreads().values())
    if cuts:
        return [("cut", min(MOST, cuts), 0)]
    lone = len(_LONE.findall(text))
    return [("lone", min(MOST, lone), 0)] if lone else []


def repair(text: str, chain: str) -> str | None:
    """The text before the chain; what comes to light is undone again, however deep. None where characters were lost."""
    kind, _, codec = chain.partition(" ")
    if kind == "utf8":
        name, _, case = codec.rpartition("-") if codec.endswith(VARIANTS[1:]) else (codec, "", "")
        fixed = undo(text, name, VARIANTS.index(f"-{case}") if case else 0)[0]
        while True:
            again, n, _ = max((undo(fixed, c, 0) for c in ("cp1252", "latin-1")), key=lambda x: x[2])
            if not n:
                break
            fixed = again  # shorter each time
        return None if "\ufffd" in fixed else fixed
    if kind in LEGACY:
        change = LEGACY[kind]
        n = sum(1 for w in _legacy_words(text) if (d := change(w)) != w and vietnamese(d))
        # in a value damaged throughout, words that are syllables by chance are damaged too
        whole = n > 2 and not re.search("[ạảấầẩẫậắằẳẵặẹẻẽếềểễệỉĩịọỏốồổỗộớờởỡợụủũứừửữựỳỷỹỵđươă]", text)
        return _WORD.sub(lambda m: change(m[0]) if not m[0].isascii() and (whole or not vietnamese(m[0])) and (whole or vietnamese(change(m[0]))) else m[0], text)
    return None


def explain(text: str) -> tuple[str, int, str | None]:
    """(chain, stretches, repaired text) of the chain with the most evidence, before any pooling."""
    found = evidence(text)
    return (found[0][0], found[0][1], repair(text, found[0][0])) if found else ("", 0, None)


# --- the gate ---------------------------------------------------------------------------------

#: Letters and signs of ordinary texts. A value with any other character is looked at.
PLAIN = r"\x00-\x7fÀ-ÃÈ-ÊÌÍÒ-ÕÙÚÝà-ãè-êìíò-õùúýĂăĐđĨĩŨũƠơƯưẠ-ỹ…–"
_ONSETS = ["", *"b c d đ g h k l m n p q r s t v x ch gh gi kh ng ngh nh ph qu th tr".split()]
_RHYMES = "a ă â e ê i o ô ơ u ư y ai ao au ay âu ây eo êu ia iê iu oa oă oe oi oo ôi ơi ua uâ uê ui uô uơ uy ưa ưi ươ ưu yê iêu yêu oai oay oao oeo uây uôi ươi ươu uya uyê uyu".split()
_CODAS = ["", *"c m n p t ch ng nh".split()]


def _to_vni(word: str) -> str:
    hats = {v: k for k, v in VNI_HATS.items()}
    breves = {v: k for k, v in VNI_BREVES.items()}
    tones = {v: k for k, v in VNI_TONES.items()}
    singles = {v: k for k, v in VNI_SINGLE.items()}
    out = []
    for c in word:
        parts = unicodedata.normalize("NFD", c)
        base, rest = parts[0], parts[1:]
        # NFD puts the dot below before the hat
        rest = "".join(sorted(rest, key=lambda x: x in "̂̆")) if "̣" in rest else rest
        if c in singles:
            out.append(singles[c])
        elif rest and rest in hats and base.lower() in "aeo":
            out.append(base + hats[rest])
        elif rest and rest in breves and base.lower() == "a":
            out.append(base + breves[rest])
        elif "̛" in rest:
            horn = {"o": "ô", "u": "ö", "O": "Ô", "U": "Ö"}[base]
            rest = rest.replace("̛", "")
            out.append(horn + tones.get(rest, ""))
        else:
            out.append(base + tones.get(rest, "") if rest else c)
    return "".join(out)


def _syllables(usual: bool = False) -> Iterator[str]:
    """Syllables without their first consonants; usual ones have the tone where it is written today or was before."""
    tones = ["", "̀", "́", "̉", "̃", "̣"]
    for rhyme in _RHYMES:
        last = len(rhyme) - 1
        places = [0] if rhyme == "oo" else [last] if not last or rhyme[-1] in "ăâêôơư" else [0, 1] if rhyme in ("oa", "oe", "uy") else [last - 1]
        for at in places if usual else range(last + 1):
            for tone in tones:
                marked = unicodedata.normalize("NFC", rhyme[: at + 1] + tone + rhyme[at + 1 :])
                for coda in _CODAS:
                    yield marked + coda


def legacy_products() -> Iterator[tuple[str, str]]:
    """(word, chain) of the legacy encodings of all syllables without their first consonants, where they are evidence."""
    old = {v: k for k, v in TCVN3.items()}
    for rhyme in _syllables(usual=True):
        for body in {rhyme, rhyme.upper()}:
            for head in ("", "h", "H"):
                word = head + body
                for chain, made in (("tcvn3", "".join(old.get(c, c) for c in word)), ("vni", _to_vni(word))):
                    if made != word and len(made) > 1 and not vietnamese(made) and vietnamese(LEGACY[chain](made)) and any(c < "\x80" for c in made):
                        yield made, chain


@lru_cache(maxsize=1)
def suspicious() -> str:
    """The pattern that every product of a chain matches, derived from the alphabets of the chains.

    A value with a character outside PLAIN matches. Products of plain characters only are pairs: a lead and
    a following character of one codec, or neighbours that the legacy encodings make and that no Vietnamese
    syllable has.
    """
    plain = re.compile(f"[{PLAIN}]")
    pairs: dict[str, set[str]] = {}
    for codec in CODECS:
        table = _table(codec)
        for change in (str, str.lower, str.upper) if codec in CASED else (str,):
            cased = {b: change(c) if len(change(c)) == 1 else c for b, c in table.items()}
            leads = {c for b, c in cased.items() if 0xC2 <= b < 0xF5 and plain.fullmatch(c)}
            follows = {c for b, c in cased.items() if b < 0xC0 and plain.fullmatch(c)}
            for c in leads if follows else ():
                pairs.setdefault(c, set()).update(follows)
    usual = {f"{a}{b}" for r in _syllables(usual=True) for w in {r, r.upper()} for a, b in zip(w, w[1:], strict=False)}
    heads = {h[-1] + r[0] for h in _ONSETS if h for r in _syllables(usual=True)}
    heads -= {x for x in heads if x[0] == "u" and unicodedata.normalize("NFD", x[1])[0] in "uo"}  # after qu
    usual |= heads | {x.upper() for x in heads} | {x[0].upper() + x[1] for x in heads}
    usual |= {r[0].upper() + r[1] for r in _syllables(usual=True) if len(r) > 1}
    consonants = {h[-1] for h in _ONSETS if h and h.isascii()}
    for word, _ in legacy_products():
        if all(plain.fullmatch(c) for c in word):
            for a, b in zip(word, word[1:], strict=False):
                if f"{a}{b}" not in usual and not (a + b).isascii():
                    for x in consonants if a == "h" else (a,):  # h stands for every first consonant
                        pairs.setdefault(x, set()).add(b)
    # one of a pair is no ASCII letter: only there the pairs are tried
    after: dict[str, set[str]] = {}
    before: dict[str, set[str]] = {}
    for a, follows in pairs.items():
        if a.isascii():
            for b in follows:
                before.setdefault(b, set()).add(a)
        else:
            after.setdefault("".join(sorted(follows)), set()).add(a)
    letters: dict[str, set[str]] = {}
    for b, firsts in before.items():
        letters.setdefault("".join(sorted(firsts)), set()).add(b)
    class_ = lambda x: f"[{re.escape(''.join(sorted(x)))}]"
    two = [class_(a) + class_(b) for b, a in sorted(after.items())] + [f"(?<={class_(a)}){class_(b)}" for a, b in sorted(letters.items())]
    # words whose pairs are all usual have three neighbours that are not
    found = re.compile("|".join([f"[^{PLAIN}]", *two]))
    usual3 = {w[i : i + 3] for r in _syllables(usual=True) for w in {r, r.upper(), "h" + r, "H" + r, "H" + r.upper()} for i in range(len(w) - 2)}
    three: dict[str, set[str]] = {}
    for word, _ in legacy_products():
        if not found.search(word):
            for i in range(len(word) - 2):
                at = word[i : i + 3]
                if at not in usual3 and not at[2].isascii():
                    three.setdefault(at[:2], set()).add(at[2])
    # h and H stand for every first consonant but q, and for none
    two += [(f"(?<={b[1]})(?<![qQ]{b[1]})" if b[0] in "hH" else f"(?<={b})") + class_(a) for b, a in sorted(three.items())]
    return r"(?=[^\x00-\x7f])(?:" + "|".join([f"[^{PLAIN}]", "[ÃÂ](?![A-Za-zÀ-ỹ])(?<![A-Za-zÀ-ỹ][ÃÂ])", *two]) + ")"


# --- expectation-maximisation -----------------------------------------------------------------


def _signature(found: list[tuple[str, int, int]]) -> str:
    return ";".join(f"{c},{m},{x}" for c, m, x in found)


@lru_cache(maxsize=100_000)
def _candidates(signature: str) -> tuple[tuple[str, int, int], ...]:
    return tuple((c, int(m), int(x)) for c, m, x in (part.split(",") for part in signature.split(";")))


def _kind(chain: str) -> str:
    return chain.split(" ")[0]


class Model:
    """Rates of the chains and likelihoods of one source and field, fitted by expectation-maximisation."""

    def __init__(self, before: dict | None = None) -> None:
        before = before or {}
        self.rates: dict[str, float] = dict(before.get("rates", {}))
        self.first = dict(self.rates)
        self.chance: dict[str, float] = dict(before.get("chance", {k: v for k, (v, _) in CHANCE.items()}))
        self.shown: dict[str, list[float]] = {k: list(v) for k, v in before.get("shown", {}).items()}
        self.miss: float = before.get("miss", MISS)
        self.pooled = bool(before)

    def posterior(self, signature: str) -> tuple[dict[str, float], float]:
        """The probability of each candidate chain, and of clean text."""
        found = _candidates(signature)
        clean = max(1e-6, 1 - sum(self.rates.values()))
        most = {k: max(m for c, m, _ in found if _kind(c) == k) for k in {_kind(c) for c, _, _ in found}}
        for k, m in most.items():
            clean *= self.chance[k] ** m
        weights = {}
        for c, m, x in found:
            shown = self.shown.get(_kind(c))
            weights[c] = self.rates.get(c, 1e-4) * (shown[m - 1] if shown else 1 / MOST) * self.miss**x
        total = clean + sum(weights.values())
        return {c: w / total for c, w in weights.items()}, clean / total

    def fit(self, counts: list[tuple[str, int]], total: int) -> Model:
        """EM over (signature, number of values) out of `total` values."""
        chains = {c for s, _ in counts for c, _, _ in _candidates(s)}
        for c in chains:
            self.rates.setdefault(c, 1e-4 if self.pooled else 0.01)
        for _ in range(STEPS):
            mass = dict.fromkeys(chains, 0.0)
            shown: dict[str, list[float]] = {}
            clean: dict[str, float] = {}
            missed = hits = 0.0
            for s, n in counts:
                chain, clear = self.posterior(s)
                for c, m, x in _candidates(s):
                    w = n * chain[c]
                    mass[c] += w
                    shown.setdefault(_kind(c), [0.0] * MOST)[m - 1] += w
                    missed, hits = missed + w * x, hits + w * m
                best: dict[str, int] = {}
                for c, m, _ in _candidates(s):
                    best[_kind(c)] = max(best.get(_kind(c), 0), m)
                for k, m in best.items():
                    clean[k] = clean.get(k, 0.0) + n * clear * m
            if self.pooled:
                self.rates = {c: (mass.get(c, 0.0) + POOL * self.first.get(c, 1e-4)) / (total + POOL) for c in chains | set(self.first)}
                continue  # the likelihoods are those of the field
            self.rates = {c: (mass[c] + 0.01) / (total + 0.01 * len(chains)) for c in chains}
            self.chance = {k: (v * weight * total + clean.get(k, 0.0)) / (weight * total + total) for k, (v, weight) in CHANCE.items()}
            self.shown = {k: [(x + 1.0) / (sum(v) + MOST) for x in v] for k, v in shown.items()}
            self.miss = (MISS * GUESS + missed) / (GUESS + missed + hits)
        return self

    def parameters(self) -> dict:
        return {"rates": self.rates, "chance": self.chance, "shown": self.shown, "miss": self.miss}


def _fit_field(pdf: pd.DataFrame) -> pd.DataFrame:
    model = Model().fit(list(zip(pdf["signature"], pdf["n"].tolist(), strict=True)), int(pdf["total"].iloc[0]))
    return pd.DataFrame({"place": [pdf["place"].iloc[0]], "model": [json.dumps(model.parameters())]})


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    model = Model(json.loads(pdf["model"].iloc[0])).fit(list(zip(pdf["signature"], pdf["n"].tolist(), strict=True)), int(pdf["total"].iloc[0]))
    rows = []
    for place, source, s in zip(pdf["place"], pdf["source"], pdf["signature"], strict=True):
        chain, clean = model.posterior(s)
        rows.append((place, source, s, max(chain, key=chain.get), 1 - clean))
    return pd.DataFrame(rows, columns=["place", "source", "signature", "chain", "posterior"])


KEY = ["source_table", "data_id", "field_name"]


def _evidence(with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["signature"] = [_signature(evidence(t)) for t in pdf["text"]]
            pdf = pdf[pdf["signature"] != ""]
            yield pdf if with_text else pdf.drop(columns="text")

    return run


def _repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pdf["repaired"] = [repair(t, c) for t, c in zip(pdf.pop("text"), pdf["chain"], strict=True)]
        yield pdf


def _decided(tables: list[tuple[str, DataFrame, list[str]]], id_col: str, source_col: str, with_text: bool) -> DataFrame:
    """(source_table, data_id, field_name, chain, posterior[, text]) of each damaged value."""
    parts = []
    for name, df, fields in tables:
        values = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("text")) for c in fields]))
        parts.append(spread(df.select(F.col(id_col).cast("string").alias("data_id"), F.lower(F.coalesce(F.col(source_col).cast("string"), F.lit(""))).alias("source"), *fields)).select(F.lit(name).alias("source_table"), "data_id", "source", values.alias("v")).select("source_table", "data_id", "source", "v.*").filter("text IS NOT NULL"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    every = every.withColumn("place", F.concat_ws(".", "source_table", "field_name"))
    odd = every.filter(F.col("text").rlike(suspicious())).withColumn("digest", F.md5("text"))
    schema = "source_table string, data_id string, source string, field_name string, " + ("text string, " if with_text else "") + "place string, digest string, signature string"
    found = materialize(odd.mapInPandas(_evidence(with_text), schema).dropDuplicates([*KEY, "digest"]), "p2e")
    totals = every.groupBy("place", "source").agg(F.count(F.lit(1)).alias("total"))
    # signatures are bounded: CANDIDATES of the chains, each with counts up to MOST
    counts = materialize(found.groupBy("place", "source", "signature").agg(F.count(F.lit(1)).alias("n")), "p2c")
    totals = materialize(totals, "p2t")
    overall = counts.groupBy("place", "signature").agg(F.sum("n").alias("n")).join(totals.groupBy("place").agg(F.sum("total").alias("total")), "place")
    fields_ = materialize(overall.groupBy("place").applyInPandas(_fit_field, "place string, model string"), "p2f")  # one row a field
    own = counts.join(totals, ["place", "source"]).join(F.broadcast(fields_), "place")
    posterior = own.groupBy("place", "source").applyInPandas(_fit_source, "place string, source string, signature string, chain string, posterior double")
    return bounded_join(found, materialize(posterior.filter(F.col("posterior") > THRESHOLD), "p2p"), ["place", "source", "signature"], by=["data_id"], how="inner")


def garbled_values(tables: list[tuple[str, DataFrame, list[str]]], id_col: str = "data_id", source_col: str = "source") -> DataFrame:
    """(source_table, data_id, field_name, chain, posterior, repaired) of each damaged value.

    `tables` holds (name, table, fields). `repaired` is null where characters were lost. Null, blank and
    undamaged values give no row; a value delivered more than once gives one; sources are compared
    without case, a null source counts as ''. Empty tables give an empty result; other columns are
    ignored.
    """
    decided = _decided(tables, id_col, source_col, True).select(*KEY, "chain", "posterior", "text")
    repaired = decided.mapInPandas(_repair, "source_table string, data_id string, field_name string, chain string, posterior double, repaired string")
    return repaired.dropDuplicates([*KEY, "repaired"])


def garbled_ids(tables: list[tuple[str, DataFrame, list[str]]], id_col: str = "data_id", source_col: str = "source") -> DataFrame:
    """(source_table, data_id, field_name) of each damaged value; see garbled_values."""
    return _decided(tables, id_col, source_col, False).select(*KEY).distinct()
