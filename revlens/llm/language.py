"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 (drawn from its code point).  A
letter trigram is bound into one vector: the product of the first letter's
vector permuted twice, the second's permuted once, and the third's.  A text is
bundled from its trigrams (the sum over all of them), a language prototype from
all texts of the language, and a text gets the language whose prototype has
the largest cosine with it.

Words are runs of letters, lower-cased, with a blank letter before and after each;
all else separates words.  Training sends one vector for each task and
language, so what the driver gets depends on the number of languages alone.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every
text when nothing could be learned.  Ties go to the first language by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, map_texts

DIMENSIONS = 1024
SEED = 20
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Trigrams of the texts that are bundled together (a longer text is alone), and different ones that have vectors at once:
#: a task holds 8 bytes a letter of its longest text, and vectors of bounded size.
STEP_CHARS, SLICE_TRIGRAMS = 400_000, 4_096


def letter_vectors(codes: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """+1/-1 vectors of code points: the bits of a counter hash (splitmix64) of letter and position."""
    words = -(-dimensions // 64)
    with np.errstate(over="ignore"):
        x = (codes.astype(np.uint64)[:, None] << np.uint64(20)) + np.arange(words, dtype=np.uint64)[None, :]
        x = (x + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.astype("<u8").view(np.uint8), axis=1)[:, :dimensions]
    return bits.astype(np.int8) * 2 - 1


class Bundler:
    """Trigram vectors by need, and their sums."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.cache: dict[int, np.ndarray] = {}

    def codes(self, text: str | None) -> np.ndarray | None:
        """The text's trigrams as numbers (21 bits a letter), or None if it has no letter."""
        words = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
        if not words:
            return None
        x = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        return (x[:-2] << 42) | (x[1:-1] << 21) | x[2:]

    def bundles(self, codes: list[np.ndarray], row: np.ndarray, n_rows: int) -> np.ndarray:
        """Sums of the trigrams' vectors; those of ``codes[k]`` go to row ``row[k]``.

        Different trigrams are taken slice by slice: sums of whole numbers do not depend on the order."""
        every = np.concatenate(codes)
        order = np.argsort(every)  # sorted once; equal trigrams may come in any order
        every, owner = every[order], np.repeat(row, [len(c) for c in codes])[order]
        new = np.concatenate([[True], every[1:] != every[:-1]])
        distinct, place = every[new], np.cumsum(new) - 1
        out = np.zeros((n_rows, self.dimensions))
        for first in range(0, len(distinct), SLICE_TRIGRAMS):
            some = distinct[first:first + SLICE_TRIGRAMS]
            a, b = np.searchsorted(place, (first, first + len(some)))
            counts = np.bincount(owner[a:b] * len(some) + place[a:b] - first, minlength=n_rows * len(some))
            out += counts.reshape(n_rows, len(some)).astype(np.float32) @ self.vectors(some)
        return out

    def vectors(self, trigrams: np.ndarray) -> np.ndarray:
        if new := [t for t in trigrams.tolist() if t not in self.cache]:
            if len(self.cache) > 30_000:
                self.cache.clear()
                new = trigrams.tolist()
            t = np.array(new, np.int64)
            mask = (1 << 21) - 1
            a, b, c = (letter_vectors(x, self.dimensions) for x in (t >> 42, (t >> 21) & mask, t & mask))
            made = np.roll(a, 2, axis=1) * np.roll(b, 1, axis=1) * c
            self.cache.update(zip(new, made))
        return np.stack([self.cache[t] for t in trigrams.tolist()]).astype(np.float32)

    def steps(self, texts: list) -> Iterator[tuple[list[int], list[np.ndarray]]]:
        """Texts with letters, in steps of bounded size: (their places, their trigrams)."""
        at, held, size = [], [], 0
        for k, text in enumerate(texts):
            if (codes := self.codes(text)) is None:
                continue
            at.append(k)
            held.append(codes)
            size += len(codes)
            if size >= STEP_CHARS:
                yield at, held
                at, held, size = [], [], 0
        if held:
            yield at, held


@dataclass(frozen=True)
class Profiles:
    languages: tuple[str, ...]
    prototypes: np.ndarray  # languages by dimensions, of length 1


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", dimensions: int = DIMENSIONS) -> Profiles:
    """Bundle all given texts by language; rows with a null language are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler, sums = Bundler(dimensions), {}
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at, codes in bundler.steps(texts):
                own, row = np.unique(np.array([langs[k] for k in at], object), return_inverse=True)
                for lang, total in zip(own.tolist(), bundler.bundles(codes, row, len(own))):
                    sums[lang] = sums.get(lang, 0) + total
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])],
                                             ["lang", "sums"])

    rows = (docs.select(F.col(f"`{text_col}`").cast("string").alias("t"), F.col(f"`{lang_col}`").cast("string").alias("l"))
            .filter("l IS NOT NULL AND t IS NOT NULL").transform(arrow_map, run, "lang string, sums array<double>")
            .select("lang", F.posexplode("sums").alias("k", "v")).groupBy("lang", "k").agg(F.sum("v").alias("v"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("p")).orderBy("lang").collect())
    # one row for each language, each of `dimensions` numbers
    vectors = np.array([[x["v"] for x in r["p"]] for r in rows], np.float64).reshape(len(rows), dimensions)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Profiles(tuple(r["lang"] for r in rows), (vectors / np.where(norms > 0, norms, 1)).astype(np.float32))


FIELDS = (("lang_pred", "string"), ("score", "double"))


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text",
             carry: bool = False) -> DataFrame:
    """doc_id, lang_pred and score (the cosine, 0 if negative)."""
    languages, prototypes = profiles.languages, profiles.prototypes
    state: dict[str, Bundler] = {}

    def run(texts: list) -> list:
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        if not languages:
            return [lang, score]
        bundler = state.setdefault("b", Bundler(prototypes.shape[1]))
        for at, codes in bundler.steps(texts):
            bundle = bundler.bundles(codes, np.arange(len(codes)), len(codes))
            norm = np.linalg.norm(bundle, axis=1)
            cosine = bundle @ prototypes.T / np.where(norm > 0, norm, 1)[:, None]
            best = cosine.argmax(axis=1)
            for k, j, c in zip(at, best.tolist(), cosine.max(axis=1).tolist()):
                lang[k], score[k] = languages[j], min(1.0, max(0.0, c))
        return [lang, score]

    return map_texts(docs, run, FIELDS, id_col, text_col, carry=carry)


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text leaves 2 when divided by 4 (a null id: not held out)."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))
