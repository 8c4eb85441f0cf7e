"""Benchmark decontamination: rare n-gram seeds, then local alignment.

1. Seeds of an item are its word n-grams (three words, two for items of up to ten words), without those that many items hold.
   An alignment with the least score leaves out or breaks a bounded number of an item's n-grams: a changed or lost word costs
   three points and breaks at most three of them, one inserted word costs a point and breaks none (seeds are
   looked for with up to one word inserted at each place), two cost two and break two.  An item always keeps more seeds than
   can be broken, frequent ones too if it has no others, so some are found in every copy that scores enough.
2. One pass finds seeds in the documents.  An item is looked at where as many of its seeds are hit as no copy can lose; the
   passages that they point at are scored against the item by Smith-Waterman alignment over words.  A passage with too few
   of the item's words for the least score is not aligned; that bound leaves out no match.  An item is matched where the best
   alignment reaches a share of the item's perfect score.
3. Items are matched by their text and joined to their ids afterwards, so repeated items cost nothing and ids may be of any type.

The benchmark's different texts are the small side: they travel to the tasks in chunks of a bounded number of
characters (``CHUNK_CHARS``); a larger benchmark takes more passes, chunk by chunk.

Words are runs of letters and digits, lower-cased.  Defined results: a null text
has no match.  Items of up to three words match only as a whole: their words must stand in the text consecutively; items without a
word, null items included, never match.  Repeated documents and items give repeated matches.  With a least score below
0.6 a copy may lose all its seeds.
"""

from __future__ import annotations

import hashlib
import re
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

WORD = re.compile(r"[^\W_]+")
GRAM = 3
#: Items of up to so many words have seeds of two words.
SHORT = 10
#: An n-gram that more items hold is a seed only of items that would have too few.
FREQUENT = 64
#: Places of a seed's words in a text: as they stand, and with a word inserted after the first, the second, both.
SHAPES = {1: ((0,),), 2: ((0, 1), (0, 2)), 3: ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 2, 4))}
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.6
CHUNK_CHARS = 8_000_000
#: Alignments that a task remembers (passages that many documents share).
REMEMBERED = 4_096


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Items:
    """A chunk of the benchmark with its words numbered from 1 and its n-grams by position."""

    def __init__(self, items: list[tuple]):
        self.number: dict[str, int] = {}
        self.ids = [i for i, _ in items]
        self.words = [np.array([self.number.setdefault(w, len(self.number) + 1) for w in words_of(t)], np.int64)
                      for _, t in items]
        self.base = len(self.number) + 1
        if self.base ** GRAM >= 1 << 62:
            raise ValueError("too many different words in one chunk of the benchmark")
        self.whole = np.array([len(w) <= GRAM for w in self.words], bool)
        self.size = np.array([len(w) if len(w) <= GRAM else 2 if len(w) <= SHORT else GRAM for w in self.words], np.int64)

    def grams(self, words: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
        """Code of the words at each position's places; 0 where one is none of the benchmark's."""
        n = len(words) - shape[-1]
        if n <= 0 or not len(shape):
            return np.zeros(0, np.int64)
        code, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in shape:
            part = words[k:k + n]
            code = code * self.base + part
            known &= part > 0
        return np.where(known, code, 0)

    def of(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.number.get, words, [0] * len(words)), np.int64, len(words))


def most_broken(m: int, size: int, min_score: float) -> int:
    """N-grams of an item of ``m`` words that an alignment with the least score can lack."""
    lost = MATCH * m * (1 - min_score) + 1e-9
    return int(lost if size == GRAM else lost * 2 / 3)


@dataclass(frozen=True)
class Seeds:
    """Sorted seed codes of one size; those numbered ``start[c]`` to ``start[c + 1]`` of ``item`` and ``position`` hold code ``c``."""

    size: int
    codes: np.ndarray
    start: np.ndarray
    item: np.ndarray
    position: np.ndarray
    bits: np.ndarray  # of mixed codes: most n-grams of a text are no seed

    def places(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of seeds among the codes, and the number of the code at each."""
        known = np.flatnonzero(self.bits[_mixed(codes, len(self.bits))] & (codes > 0))
        if not len(known):
            return known, known
        at = np.minimum(np.searchsorted(self.codes, codes[known]), len(self.codes) - 1)
        ok = self.codes[at] == codes[known]
        return known[ok], at[ok]


def _mixed(codes: np.ndarray, n: int) -> np.ndarray:
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - n.bit_length() + 1)).astype(np.int64)


def seeds_of(items: Items, min_score: float) -> tuple[list[Seeds], np.ndarray]:
    """Seeds of each size, and for each item the seeds that every copy hits."""
    found, needed = [], np.ones(len(items.words), np.int64)
    for size in (1, 2, 3):
        own = [k for k, n in enumerate(items.size.tolist()) if n == size]
        grams = [items.grams(items.words[k], SHAPES[size][0]) for k in own]
        codes = np.concatenate([np.zeros(0, np.int64), *grams])
        if not len(codes):
            continue
        holder = np.repeat(own, [len(g) for g in grams])
        different = np.unique(np.stack([codes, holder]), axis=1)[0]  # an item that repeats an n-gram holds it once
        values, holders = np.unique(different, return_counts=True)
        keep = []
        for k, g in zip(own, grams):
            often = holders[np.searchsorted(values, g)]
            broken = 0 if items.whole[k] else most_broken(len(items.words[k]), size, min_score)
            least = min(len(g), broken + 1)
            rare = np.argsort(often, kind="stable")
            n = max(least, int((often <= FREQUENT).sum()))
            kept = np.zeros(len(g), bool)
            kept[rare[:n]] = True
            keep.append(kept)
            needed[k] = max(1, n - broken)
        keep = np.concatenate(keep)
        item, position = holder[keep], np.concatenate([np.arange(len(g)) for g in grams])[keep]
        order = np.argsort(codes[keep], kind="stable")
        values, start = np.unique(codes[keep][order], return_index=True)
        bits = np.zeros(1 << 20, bool)
        bits[_mixed(values, len(bits))] = True
        found.append(Seeds(size, values, np.append(start, len(order)), item[order], position[order], bits))
    return found, needed


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over words: (best score, first and end word of the passage's aligned part)."""
    n = len(passage)
    steps = np.arange(n + 1) * -GAP
    last = np.zeros(n + 1, np.int64)
    begin = np.arange(n + 1)  # where the best alignment that ends here began
    best, span = 0, (0, 0)
    index = np.arange(n + 1)
    for w in item.tolist():
        diagonal = last[:-1] + np.where(passage == w, MATCH, MISMATCH)
        down = last + GAP
        here = np.maximum(down, 0)
        here[1:] = np.maximum(here[1:], diagonal)
        origin = np.where(here == 0, index, begin)
        from_diagonal = np.zeros(n + 1, bool)
        from_diagonal[1:] = (diagonal == here[1:]) & (here[1:] > 0)
        origin[1:] = np.where(from_diagonal[1:], begin[:-1], origin[1:])
        lifted = here + steps  # a gap in the item: the best cell to the left, less a gap for each word
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, index, 0))
        last, begin = top - steps, origin[source]
        if (k := int(last.argmax())) and last[k] > best:
            best, span = int(last[k]), (int(begin[k]), k)
    return best, *span


class Scanner:
    def __init__(self, items: Items, seeds: list[Seeds], needed: np.ndarray, min_score: float):
        self.items, self.seeds, self.needed, self.min_score = items, seeds, needed, min_score
        self.seen = np.zeros(items.base, bool)
        self.known: OrderedDict[tuple, tuple] = OrderedDict()

    def hits(self, ids: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """item -> [(position in the text, position in the item)], for items with seeds and words enough in the text."""
        items, places, positions = [], [], []
        for seeds in self.seeds:
            for shape in SHAPES[seeds.size]:
                at, code = seeds.places(self.items.grams(ids, shape))
                if not len(at):
                    continue
                first, n = seeds.start[code], seeds.start[code + 1] - seeds.start[code]
                every = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
                own = seeds.item[every]
                some = slice(None) if shape == SHAPES[seeds.size][0] else ~self.items.whole[own]  # a whole match has no gap
                items.append(own[some])
                places.append(np.repeat(at, n)[some])
                positions.append(seeds.position[every][some])
        if not items:
            return {}
        item, place, position = map(np.concatenate, (items, places, positions))
        width = int(position.max()) + 1
        owner, n = np.unique(np.unique(item * width + position) // width, return_counts=True)
        enough = owner[n >= self.needed[owner]]
        out: dict[int, list[tuple[int, int]]] = {}
        if len(enough):
            own = np.isin(item, enough)
            for k, p, q in zip(item[own].tolist(), place[own].tolist(), position[own].tolist()):
                out.setdefault(k, []).append((p, q))
        return {k: v for k, v in out.items() if self._enough(k, ids)}

    def least(self, item: np.ndarray) -> float:
        """Share of the perfect score that an item needs; a short one must match as a whole."""
        return self.min_score if len(item) > GRAM else 1

    def _enough(self, k: int, passage: np.ndarray) -> bool:
        """Whether as many of the item's words stand in the passage as the least score takes without any edit."""
        item = self.items.words[k]
        self.seen[passage] = True
        n = int(self.seen[item].sum())
        self.seen[passage] = False
        return n / len(item) >= self.least(item)

    def windows(self, hits: list[tuple[int, int]], m: int, n: int) -> list[tuple[int, int, int]]:
        """(first, end, seeds) of the passages that the hits point at; overlapping ones become one."""
        pad = max(4, int(MATCH * m * (1 - self.min_score)))  # words that may be inserted
        out: list[list[int]] = []
        for a, b in sorted((max(0, p - q - pad), min(n, p - q + m + pad)) for p, q in hits):
            if out and a < out[-1][1] and b - out[-1][0] <= 4 * (m + 2 * pad):
                out[-1][1] = max(out[-1][1], b)
                out[-1][2] += 1
            else:
                out.append([a, b, 1])
        return [tuple(x) for x in out]

    def matches(self, text: str | None) -> list[tuple]:
        """(item id, score, first word, end word, seeds) of each matched item: its best passage."""
        ids = self.items.of(text)
        out = []
        for k, hits in sorted(self.hits(ids).items()):
            item = self.items.words[k]
            best = None
            for a, b, seeds in self.windows(hits, len(item), len(ids)):
                if not self._enough(k, ids[a:b]):
                    continue
                key = (k, ids[a:b].tobytes())
                if key not in self.known:
                    self.known[key] = align(item, ids[a:b])
                    if len(self.known) > REMEMBERED:
                        self.known.popitem(last=False)
                score, first, end = self.known[key]
                score /= MATCH * len(item)
                if score >= self.least(item) and (best is None or score > best[1]):
                    best = (self.items.ids[k], score, a + first, a + end, seeds)
            if best:
                out.append(best)
        return out


FIELDS = (("items", "array<int>"), ("scores", "array<double>"), ("first_words", "array<bigint>"),
          ("end_words", "array<bigint>"), ("seeds", "array<bigint>"))


def chunks(benchmark: DataFrame, text_col: str, chunk_chars: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """The items' different texts in chunks of about ``chunk_chars`` characters, one at a time on the driver."""
    rows = benchmark.select(F.col(f"`{text_col}`").cast("string").alias("t")).dropna().distinct()
    total = rows.agg(F.sum(F.length("t") + F.lit(8)).alias("n")).first()["n"] or 0
    n = max(1, -(-int(total) // chunk_chars))
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("t"), F.lit(n)) == k)
        if own := [r["t"] for r in part.collect()]:
            yield sorted(own)


def matched(docs: DataFrame, texts: list[str], id_col: str = "doc_id", text_col: str = "text",
            min_score: float = MIN_SCORE, carry: bool = False) -> DataFrame:
    """Every document with the arrays of its matches against the texts of one chunk, by their numbers."""
    chunk = Items(list(enumerate(texts)))
    seeds, needed = seeds_of(chunk, min_score)
    scanner: dict[str, Scanner] = {}

    def run(texts: list) -> list:
        own = scanner.get("s") or scanner.setdefault("s", Scanner(chunk, seeds, needed, min_score))
        found = [own.matches(t) for t in texts]
        return [[[m[k] for m in ms] for ms in found] for k in range(len(FIELDS))]

    return map_texts(docs, run, FIELDS, id_col, text_col, carry=carry)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE,
                  chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row for each document and matched item: doc_id, item_id, score (share of the perfect
    alignment, 0 to 1), first_word, end_word (of the best passage), n_seeds (that point at it)."""
    spark = docs.sparkSession
    ids = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), F.md5(F.col(f"`{item_text_col}`").cast("string").cast("binary")).alias("_key"))
    out = None
    for texts in chunks(benchmark, item_text_col, chunk_chars):
        named = spark.createDataFrame([(k, hashlib.md5(t.encode()).hexdigest()) for k, t in enumerate(texts)], "_item int, _key string")
        found = (matched(docs, texts, id_col, text_col, min_score)
                 .select(F.col(f"`{id_col}`").alias("doc_id"),
                         F.explode(F.arrays_zip(*[n for n, _ in FIELDS])).alias("m"))
                 .select("doc_id", F.col("m.items").alias("_item"), F.col("m.scores").alias("score"),
                         F.col("m.first_words").alias("first_word"), F.col("m.end_words").alias("end_word"),
                         F.col("m.seeds").alias("n_seeds")))
        found = (found.join(named.join(ids, "_key"), "_item").select("doc_id", "item_id", "score", "first_word", "end_word", "n_seeds"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "score double, first_word long, end_word long, n_seeds long").select(
            F.lit(None).cast(docs.schema[id_col].dataType).alias("doc_id"), F.lit(None).cast(benchmark.schema[item_col].dataType).alias("item_id"), "*")
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_score: float = MIN_SCORE, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The documents (all their columns) that match no item."""
    for texts in chunks(benchmark, "text", chunk_chars):
        docs = (matched(docs, texts, id_col, text_col, min_score, carry=True)
                .filter(F.size("items") == 0).select("row.*"))
    return docs
