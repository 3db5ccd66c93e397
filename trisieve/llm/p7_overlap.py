"""Problem 7: the same or almost the same values in different splits.

Method: content-defined chunks. Rolling hashes cut the normalised words of each distinct value into
chunks, chunk digests are joined across the splits, and shared chunk lengths are summed into overlap
fractions. Only each value's rarest chunks enter the join: whatever the pair, if chunks at about the same
place make up at least MIN_OVERLAP of the longer value, the rarest of them is among these, so no such pair
is lost. Pairs whose edits spoil their chunks come from segments: a training value is cut into runs of
SEGMENT words, more than a pair can have edits, and an edit spoils at most one; so a run of one more than the
most edits, the rarest ones, has one that stands unchanged in the other value near its place. That loses no
pair, so one cutting is enough. An exact word edit distance then decides.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisieve.runtime import materialize, pair_join, spread

#: Words in the rolling window, and one cut in so many positions.
WINDOW = 2
DIVISOR = 5
#: Share of the longer value's words that the shared chunks of a candidate pair from chunks hold at least.
MIN_OVERLAP = 0.25
#: Words in a segment; with fewer than LEAST words no edit is allowed, and a value of LEAST has shorter segments.
SEGMENT = 5
LEAST = 9
#: Numbers of 64 bits in the sketch of a value's words, which drops most other pairs in the join.
SKETCH = 4
BITS = [f"s{i}" for i in range(SKETCH)]

_PRIME = np.uint64(1_000_003)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words_of(c: str) -> Column:
    """Lower-case words, runs of letters and digits, with one space between."""
    return F.array_join(F.regexp_extract_all(F.lower(F.col(c)), F.lit(r"([\p{L}\p{N}]+)"), 1), " ")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class Words:
    """The words of a batch of values, one value after the other, as hashes."""

    def __init__(self, texts: list[str]) -> None:
        words = [t.split(" ") for t in texts]
        self.total = np.array([len(w) for w in words], dtype=np.int64)
        raw = np.array([zlib.crc32(x.encode()) for w in words for x in w], dtype=np.uint64)
        self.raw = raw
        self.hash = raw * _ODD
        self.start = np.concatenate(([0], np.cumsum(self.total)))[:-1]
        self.value = np.repeat(np.arange(len(texts)), self.total)
        self.place = np.arange(len(raw)) - self.start[self.value]

    def sketches(self) -> np.ndarray:
        """SKETCH numbers of 64 bits for each value, one bit of which stands for each word; an edit changes at most two."""
        bit = self.raw % np.uint64(64 * SKETCH)
        one = np.uint64(1) << (bit & np.uint64(63))
        parts = [np.bitwise_or.reduceat(np.where(bit >> np.uint64(6) == i, one, np.uint64(0)), self.start) for i in range(SKETCH)]
        return np.stack(parts, axis=1).view(np.int64)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(digests, whether they lie in one value) of the `size` words from each position on."""
        n = len(self.hash)
        out = np.full(n, size, dtype=np.uint64)
        for i in range(size):
            out = _mixed(out) + np.concatenate((self.hash[i:], np.zeros(min(i, n), np.uint64)))
        return _mixed(out).view(np.int64), self.place + size <= self.total[self.value]

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(value, digest, words, first word) of each chunk; the k-th repetition of a chunk in a value has a digest of its own."""
        n = len(self.hash)
        rolling = np.zeros(n, np.uint64)
        for i in range(WINDOW):
            before = np.concatenate((np.zeros(min(i, n), np.uint64), self.hash[: n - i]))
            rolling = rolling * _PRIME + np.where(self.place >= i, before, np.uint64(0))
        last = self.place == self.total[self.value] - 1
        cut = (_mixed(rolling) >> np.uint64(40) < np.uint64((1 << 24) // DIVISOR)) | last
        ends = np.flatnonzero(cut)
        starts = np.concatenate(([0], ends[:-1] + 1))
        # a polynomial of the words of each chunk, from sums over the whole batch
        powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, _ODD))))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(self.hash) * powers[:n])))
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        back = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, inverse))))
        size = ends - starts + 1
        digest = _mixed((sums[ends + 1] - sums[starts]) * back[starts] + size.astype(np.uint64))
        value = self.value[starts]
        order = np.lexsort((starts, digest, value))
        new = np.ones(len(order), bool)
        new[1:] = (digest[order][1:] != digest[order][:-1]) | (value[order][1:] != value[order][:-1])
        run = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        repeat = np.empty(len(order), np.uint64)
        repeat[order] = run
        digest = np.where(repeat > 0, _mixed(digest + repeat * _PRIME), digest)
        return value, digest.view(np.int64), size, self.place[starts]

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """(digests, positions) of the segments of each value, one after the other.

        A value of n words has at most n // 9 edits to another, whichever is longer, and n // SEGMENT is more;
        only 9 words, to which one may be added, need segments of one word less.
        """
        return self._picked([(SEGMENT - 1, self.total == LEAST, True), (SEGMENT, self.total > LEAST, True)])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(digests, positions) of all runs of words that may be another value's segment."""
        return self._picked([(SEGMENT - 1, self.total == LEAST + 1, False), (SEGMENT, self.total >= LEAST, False)])

    def _picked(self, kinds: list[tuple[int, np.ndarray, bool]]) -> tuple[np.ndarray, np.ndarray]:
        digests, positions = [], []
        for size, which, apart in kinds:
            found, inside = self.grams(size)
            at = np.flatnonzero(inside & which[self.value] & (self.place % size == 0 if apart else True))
            digests.append(found[at])
            positions.append(at)
        return np.concatenate(digests), np.concatenate(positions)


CHUNK, TRAIN_SEGMENT, EVAL_WINDOW = 0, 1, 2
_PARTS = {"cls": pa.binary(), "field_name": pa.string(), "kind": pa.int32(), "digest": pa.int64(), "n": pa.int32(), "low": pa.int32(), "high": pa.int32(), "total": pa.int32(), "train": pa.bool_(), "eval": pa.bool_(), **dict.fromkeys(BITS, pa.int64())}
PARTS = "cls binary, field_name string, kind int, digest bigint, n int, low int, high int, total int, train boolean, eval boolean, " + ", ".join(f"{x} bigint" for x in BITS)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of each value, the segments of training values and the windows of evaluation values.

    Of a chunk `n` is its words and `low` its first word; of a run of words in segments and windows how often
    it comes, and its first and last place.
    """
    for whole in batches:
        for start in range(0, len(whole), 2000):
            batch = whole.slice(start, 2000)
            words = Words(batch.column(2).to_pylist())
            train, evals = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) > 0 for i in (3, 4))
            sketches = words.sketches()
            value, digest, n, low = words.chunks()
            sides = [(CHUNK, value, digest, n, low, low)]
            for kind, side, (found, at) in ((TRAIN_SEGMENT, train, words.segments()), (EVAL_WINDOW, evals, words.windows())):
                mine = side[words.value[at]]
                found, at = found[mine], at[mine]
                owner = words.value[at]
                order = np.lexsort((at, found, owner))
                found, at, owner = found[order], at[order], owner[order]
                first = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])]) if len(found) else np.zeros(0, np.int64)
                ends = np.r_[first[1:], len(found)] if len(found) else first
                sides.append((kind, owner[first], found[first], ends - first, words.place[at[first]], words.place[at[ends - 1]]))
            kind = np.concatenate([np.full(len(x[1]), x[0]) for x in sides])
            value, digest, n, low, high = (np.concatenate([x[i] for x in sides]) for i in range(1, 6))
            take = pa.array(value)
            columns = [batch.column(0).take(take), batch.column(1).take(take), kind, digest, n, low, high, words.total[value], train[value], evals[value], *sketches[value].T]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kind_) for c, kind_ in zip(columns, _PARTS.values(), strict=True)], names=list(_PARTS))


def chunk(words: list[str]) -> list[tuple[int, int, int]]:
    """(digest, words, first word) of each chunk of one value."""
    _, digest, n, at = Words([" ".join(words)]).chunks()
    return list(zip(digest.tolist(), n.tolist(), at.tolist(), strict=True))


def overlap(a: list[tuple[int, int, int]], b: list[tuple[int, int, int]], longer: int) -> float:
    """Summed length of the chunks that two values share at about the same place, as a share of the longer."""
    places = {digest: at for digest, _, at in a}
    return sum(n for digest, n, at in b if digest in places and abs(places[digest] - at) <= longer // 10) / max(1, longer)


def within(a: list[str], b: list[str], most: int) -> bool:
    """Whether at most `most` words must be inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > most:
        return False
    i = 0
    while i < len(a) and i < len(b) and a[i] == b[i]:
        i += 1
    j = 0
    while j < len(a) - i and j < len(b) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not a or not b:
        return max(len(a), len(b)) <= most
    # furthest row on each diagonal, for one more edit at a time
    goal, reach = len(a) - len(b), {}
    for edits in range(most + 1):
        new = {}
        for d in range(-edits, edits + 1):
            x = 0 if edits == 0 else max(reach.get(d, -1) + 1, reach.get(d - 1, -1) + 1, reach.get(d + 1, -1))
            y = x - d
            if x > len(a) or y < 0 or y > len(b):
                x = min(x, len(a), len(b) + d)
                y = x - d
                if x < 0 or y < 0:
                    continue
            while x < len(a) and y < len(b) and a[x] == b[y]:
                x, y = x + 1, y + 1
            if d == goal and x == len(a):
                return True
            new[d] = x
        reach = new
    return False


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cut = lru_cache(maxsize=20_000)(lambda text: chunk(text.split(" ")))
    for pdf in batches:
        keep, shares = [], []
        for x, y in zip(pdf["words_eval"], pdf["words_train"], strict=True):
            a, b = x.split(" "), y.split(" ")
            longer = max(len(a), len(b))
            keep.append(within(a, b, longer // 10))
            shares.append(overlap(cut(x), cut(y), longer) if keep[-1] else 0.0)
        pdf["overlap"] = shares
        yield pdf.loc[keep, ["field_name", "cls_eval", "cls_train", "overlap"]]


def _classes(df: DataFrame, id_col: str, split_col: str, fields: list[str], train: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Members (id, field_name, cls, training, kept columns) and classes of equal normalised values."""
    values = df.select(F.col(id_col).cast("string").alias("id"), (F.col(split_col) == train).alias("training"), *keep, F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), words_of(c).alias("words")) for c in fields])).alias("v"))
    values = values.select("id", "training", *keep, "v.*").filter("words IS NOT NULL AND training IS NOT NULL").withColumn("cls", F.unhex(F.md5(F.concat_ws("\x1f", "field_name", "words"))))
    values = materialize(values, "p7v")
    classes = values.groupBy("cls").agg(F.first("field_name").alias("field_name"), F.first("words").alias("words"), F.count_if("training").alias("n_train"), F.count_if(~F.col("training")).alias("n_eval"))
    return values.drop("words"), materialize(classes, "p7c")


def _segment_pairs(parts: DataFrame) -> DataFrame:
    """(field_name, cls_eval, cls_train): all pairs of classes that may be within the number of edits."""
    on = ["field_name", "digest"]
    train, evals = parts.filter(F.col("kind") == TRAIN_SEGMENT), parts.filter(F.col("kind") == EVAL_WINDOW)
    count = lambda df, name: df.groupBy(*on).agg(F.count(F.lit(1)).alias(name))
    rarity = materialize(count(train, "in_train").join(count(evals, "in_eval"), on), "p7t")
    # segments that no evaluation value has are the rarest of all; they need no row, only their number
    met = pair_join(train, rarity, on, rarity, "in_train", by=["cls"])
    whole = Window.partitionBy("cls")
    before = F.coalesce(F.sum("n").over(whole.orderBy("in_eval", "digest").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    size = F.when(F.col("total") == LEAST, SEGMENT - 1).otherwise(SEGMENT)
    ranked = met.withColumn("rarer", F.floor(F.col("total") / size) - F.sum("n").over(whole) + before)
    prefix = materialize(ranked.filter(F.col("rarer") <= F.floor(F.col("total") / 9)).drop("n", "rarer", "in_train", "in_eval", "kind", "train", "eval"), "p7u")
    named = lambda df, x: df.select(*on, *[F.col(c).alias(f"{c}_{x}") for c in ("cls", "total", "low", "high", *BITS)])
    near = pair_join(named(prefix, "train"), named(evals, "eval"), on, count(prefix, "rows"), "rows", by=["cls_train"])
    most = _most()
    return near.filter(_may_match() & (F.col("low_train") - most <= F.col("high_eval")) & (F.col("low_eval") - most <= F.col("high_train"))).select("field_name", "cls_eval", "cls_train")


def _most() -> Column:
    return F.floor(F.greatest("total_train", "total_eval") / 10)


def _may_match() -> Column:
    """An exact filter: no pair within the number of edits has sketches that differ in more bits."""
    bits = sum((F.bit_count(F.col(f"{x}_train").bitwiseXOR(F.col(f"{x}_eval"))) for x in BITS[1:]), F.bit_count(F.col(f"{BITS[0]}_train").bitwiseXOR(F.col(f"{BITS[0]}_eval"))))
    return (F.col("cls_train") != F.col("cls_eval")) & (F.abs(F.col("total_train") - F.col("total_eval")) <= _most()) & (bits <= 2 * _most())


def class_links(classes: DataFrame) -> DataFrame:
    """(field_name, cls_eval, cls_train, overlap): classes of almost equal values in different splits."""
    texts = classes.filter("words <> ''")
    parts = materialize(spread(texts.select("cls", "field_name", "words", "n_train", "n_eval")).mapInArrow(_parts, PARTS), "p7k")
    on = ["field_name", "digest"]
    found = parts.filter(F.col("kind") == CHUNK)
    rarity = found.groupBy(*on).agg(F.count_if("train").alias("in_train"), F.count_if("eval").alias("in_eval")).filter("in_train > 0 AND in_eval > 0")
    rarity = materialize(rarity, "p7r")
    # only chunks of both splits can be shared; the rarest come last here, in one order for all values
    rank = Window.partitionBy("cls").orderBy(F.desc(F.col("in_train") + F.col("in_eval")), F.asc_nulls_first("digest")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = pair_join(found, rarity, on, rarity.withColumn("rows", F.col("in_train") + F.col("in_eval")), "rows", by=["cls"]).withColumn("upto", F.sum("n").over(rank))
    prefix = ranked.filter(F.col("upto") >= MIN_OVERLAP * F.col("total"))
    prefix = materialize(prefix.select("cls", *on, "total", F.col("low").alias("at"), "train", "eval", *BITS), "p7p")
    side = lambda x: prefix.filter(x).select(*on, *[F.col(c).alias(f"{c}_{x}") for c in ("cls", "total", "at", *BITS)])
    left, right = side("train"), side("eval")
    sizes = left.groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))
    near = pair_join(left, right, on, sizes, "rows", by=["cls_train"]).filter(_may_match() & (F.abs(F.col("at_train") - F.col("at_eval")) <= _most()))
    candidates = near.select("field_name", "cls_eval", "cls_train").unionByName(_segment_pairs(parts)).distinct()
    text = lambda x: classes.select(F.col("cls").alias(f"cls_{x}"), F.col("words").alias(f"words_{x}"))
    checked = candidates.join(text("eval"), "cls_eval").join(text("train"), "cls_train").mapInPandas(_verify, "field_name string, cls_eval binary, cls_train binary, overlap double")
    same = classes.filter("n_train > 0 AND n_eval > 0").select("field_name", F.col("cls").alias("cls_eval"), F.col("cls").alias("cls_train"), F.lit(1.0).alias("overlap"))
    return materialize(checked.unionByName(same), "p7l")


def overlap_pairs(df: DataFrame, id_col: str, split_col: str, fields: list[str], train: str = "train") -> DataFrame:
    """(field_name, data_id_a, data_id_b): a training row and an evaluation row with (almost) the same value.

    Almost: at most a tenth of the longer value's words differ. Null values and rows without a split
    take no part; values without any word equal each other only. Copies are compared once and expanded
    at the end, in slices where a value has very many copies. An empty table gives an empty result.
    """
    members, classes = _classes(df, id_col, split_col, fields, train, [])
    links = class_links(classes)
    train_side = members.filter("training").select(F.col("cls").alias("cls_train"), F.col("id").alias("id_train"))
    eval_side = members.filter("NOT training").select(F.col("cls").alias("cls_eval"), F.col("id").alias("id_eval"))
    n = classes.select(F.col("cls").alias("cls_train"), "n_train")
    half = pair_join(train_side, links, ["cls_train"], n, "n_train", by=["id_train"])
    m = half.groupBy("cls_eval").agg(F.count(F.lit(1)).alias("rows"))
    pairs = pair_join(half, eval_side, ["cls_eval"], m, "rows", by=["id_train"])
    return pairs.filter("id_train <> id_eval").select("field_name", F.least("id_train", "id_eval").alias("data_id_a"), F.greatest("id_train", "id_eval").alias("data_id_b")).distinct()


def overlap_report(df: DataFrame, id_col: str, split_col: str, source_col: str, fields: list[str], train: str = "train") -> DataFrame:
    """(split, source, field_name, overlapping, rows): evaluation rows that overlap with training.

    Counts rows, not pairs: a row overlaps if its value is linked to any training value.
    """
    members, classes = _classes(df, id_col, split_col, fields, train, [split_col, source_col])
    hit = class_links(classes).select(F.col("cls_eval").alias("cls")).distinct().withColumn("hit", F.lit(1))
    own = members.filter("NOT training")
    return own.join(hit, "cls", "left").groupBy(F.col(split_col).alias("split"), F.col(source_col).alias("source"), "field_name").agg(F.count("hit").alias("overlapping"), F.count(F.lit(1)).alias("rows"))
