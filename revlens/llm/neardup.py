"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

1. Each text becomes its set of word 5-grams (a shorter text is one gram).  Texts with the
   same set are copies: they are grouped by a digest of the set, and only one
   representative for each set (the smallest doc_id) goes on.
2. A representative's MinHash values give it a key in each of ``TREES`` trees.
   The keys of all trees are range-partitioned and sorted once, which lays out
   every tree as a sorted prefix trie: texts that share a prefix stand side by side.
3. Candidates at prefix depth k are all members of a depth-k subtree, in two steps.  First each text with one other:
   the centre of its largest subtree, which is the text that sits in the largest subtrees over all trees.  That
   links the copies of one original with one comparison each.  Then every pair of a subtree whose texts are not in one class
   yet: the subtree is dealt into blocks of bounded size, and each pair of blocks compares the texts' MinHash values (a
   pair of the threshold's similarity has fewer equal ones than asked with a chance of less than one in a million).  What is left
   goes on as pairs, or, where pairs outnumber the texts many times, as texts to compare in blocks as in 6.
   Only links that join classes come out of a block, so rows grow with the number of texts.
4. Candidates are verified exactly on their gram sets.  The depth starts as the deepest
   one whose recall at the threshold reaches the target, and is shortened while the measured recall stays below
   it: a sample of texts, chosen by hash of doc_id, is compared with every text while signatures are made, and recall is the share
   of the links found so that have both ends in one class.  Links of the sample that no depth proposed are taken in as
   well.  If the shallowest depth stays below the target, the caller is warned and finds the figure in ``Joined.recall``.
5. Links give classes (connected components).
6. A text's links to the other texts of its class are counted exactly, also those that were no
   candidates: a class is dealt into blocks of bounded size, each pair of blocks is one small task that
   intersects gram sets as matrices, and only one number for each text and task comes out.

Words are runs of letters and digits, lower-cased.  Defined results: a text without a word
(null, empty) is never compared and is alone in its class.  Repeated rows are copies.  A null
doc_id represents no class: its row shows the class of its copies, or null.  An empty table
gives no row.
"""

from __future__ import annotations

import hashlib
import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, ship_package, stored

WORD = re.compile(r"[^\W_]+")
GRAM = 5
THRESHOLD = 0.8
TREES = 24
VALUES = 8  # MinHash values of a tree's own; deeper ones come from the next tree
TARGET_RECALL = 0.999
DEEPEST, SHALLOWEST = 7, 4
#: Ids below this number are broadcast (8 bytes each) to pick their texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Texts and bytes of grams in a block of a class, and grams of a matrix, when links are counted.
BLOCK_TEXTS, BLOCK_BYTES, COLUMNS = 2_048, 16_000_000, 4_096
#: Texts, and bytes of their grams, that are compared with every text to measure recall.
SAMPLE_TEXTS, SAMPLE_BYTES = 256, 16_000_000
#: Texts of a subtree's block when MinHash values are compared, and pairs of values that are compared at once.
COMPARED_TEXTS, AT_ONCE = 512, 8_000_000
#: Up to so many pairs for each text of a block are verified as pairs; where there are more, the texts are compared in blocks.
FEW = 8


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams(text: str | None, size: int = GRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(" ".join(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - size + 1
    x = np.zeros(n, np.uint64)
    for k in range(size):
        x = (x ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return np.unique(x)


@lru_cache(maxsize=4)
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(4)
    return (r.integers(0, 1 << 32, (n, 1), np.uint64).astype(np.uint32),
            r.integers(0, 1 << 32, (n, 1), np.uint64).astype(np.uint32) | np.uint32(1))


def signature(found: np.ndarray, n: int = TREES * VALUES) -> bytes:
    """One byte (of its own mix) for each MinHash value."""
    flip, factor = _permutations(n)
    x = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        least = np.minimum(least, ((x[None, at:at + 1024] ^ flip) * factor).min(axis=1))
    return ((least * np.uint32(0x85EBCA6B)) >> np.uint32(24)).astype(np.uint8).tobytes()


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows at most, which bound what a task makes of them at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def set_digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


class Sample:
    """Gram sets that every text is compared with."""

    def __init__(self, sets: list[np.ndarray], threshold: float = THRESHOLD):
        self.threshold, self.keys = threshold, [set_digest(x) for x in sets]
        self.size = np.array([len(x) for x in sets], np.int64)
        every = np.concatenate([np.zeros(0, np.uint64), *sets])
        order = np.argsort(every, kind="stable")
        self.grams, self.owner = every[order], np.repeat(np.arange(len(sets)), self.size)[order]
        self.bits = np.zeros(1 << 20, bool)  # of the grams' last 20 bits: most grams of most texts are in no set
        self.bits[(self.grams & np.uint64(len(self.bits) - 1)).astype(np.int64)] = True

    def near(self, found: np.ndarray) -> list[int]:
        """Numbers of the sets that differ from this one and have the threshold's similarity with it."""
        some = found[self.bits[(found & np.uint64(len(self.bits) - 1)).astype(np.int64)]]
        at, end = np.searchsorted(self.grams, some), np.searchsorted(self.grams, some, "right")
        n = end - at
        if not n.any():
            return []
        hit = np.arange(n.sum()) + np.repeat(at - (np.cumsum(n) - n), n)
        common = np.bincount(self.owner[hit], minlength=len(self.size))
        both = self.size + len(found) - common
        return np.flatnonzero((common >= self.threshold * both) & (common < both)).tolist()


def choose_sample(texts: DataFrame, threshold: float = THRESHOLD) -> Sample:
    """Texts with the smallest hashes of their doc_id, up to ``SAMPLE_TEXTS`` and ``SAMPLE_BYTES``."""
    ids = [r["doc_id"] for r in texts.select("doc_id").dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_TEXTS).collect()]
    own, room = {}, SAMPLE_BYTES
    chosen = texts.filter(F.col("doc_id").isin(ids)).transform(arrow_map, _gram_batches, "rep long, grams binary")
    for r in chosen.dropDuplicates(["rep"]).orderBy(F.xxhash64("rep"), "rep").toLocalIterator():
        found = np.frombuffer(bytes(r["grams"]), np.uint64)
        if len(found) and ((room := room - found.nbytes) >= 0 or not own):
            own.setdefault(set_digest(found), found)
    return Sample(list(own.values()), threshold)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: Sample | None = None) -> DataFrame:
    """doc_id, set_key (digest of the gram set; null without words), sig, near (numbers of the sample's sets that are linked)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 256):
            keys, sigs, near = [], [], []
            for text in b.column(1).to_pylist():
                found = grams(text)
                some = len(found) > 0
                keys.append(set_digest(found) if some else None)
                sigs.append(signature(found) if some else None)
                near.append(sample.near(found) if some and sample else [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()),
                                              pa.array(near, pa.list_(pa.int32()))], ["doc_id", "set_key", "sig", "near"])

    return _texts(docs, id_col, text_col).transform(arrow_map, run, "doc_id long, set_key binary, sig binary, near array<int>")


def forest(reps: DataFrame) -> DataFrame:
    """Sorted tries of all trees: rows (path, rep) for texts that share a prefix with a neighbour.

    ``path`` holds 5 bits of tree and 7 values of 8 bits, so a prefix is a shift.
    """
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.uint64(1) << (np.uint64(51) - np.uint64(8) * np.arange(7, dtype=np.uint64))
        more = np.uint64(1) << (np.uint64(56) - np.uint64(8) * np.arange(8, dtype=np.uint64))
        trees = np.arange(TREES, dtype=np.uint64) << np.uint64(59)
        take = (np.arange(TREES)[:, None] * VALUES + np.arange(15)[None, :]) % (TREES * VALUES)
        for b in sliced(batches, 2_048):
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1).astype(np.uint64)
            v = sig[:, take]
            path = (v[:, :, :7] * weight).sum(axis=2, dtype=np.uint64) | trees
            rest = (v[:, :, 7:] * more).sum(axis=2, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path.reshape(-1).view(np.int64)), pa.array(rest.reshape(-1).view(np.int64)),
                 pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), TREES))],
                ["path", "rest", "rep"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = 59 - 8 * SHALLOWEST
        last: tuple | None = None  # the row before, not yet given out: path, rep, whether it stays
        for b in batches:
            if not b.num_rows:
                continue
            path, rep = b.column(0).to_numpy(), b.column(1).to_numpy()
            # a task's first and last row may share with a row of another task, so both stay
            first = True
            if last is not None:
                path, rep, first = np.concatenate([[last[0]], path]), np.concatenate([[last[1]], rep]), last[2]
            same = (path[1:] >> shift) == (path[:-1] >> shift)
            keep = np.concatenate([[first], same])
            keep[:-1] |= same
            last = (path[-1], rep[-1], keep[-1])
            at = np.flatnonzero(keep[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(path[at]), pa.array(rep[at])], ["path", "rep"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array(last[:1], pa.int64()), pa.array(last[1:2], pa.int64())], ["path", "rep"])

    n = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (reps.select("rep", "sig").transform(arrow_map, keys, "path long, rest long, rep long")
            .repartitionByRange(n, "path", "rest").sortWithinPartitions("path", "rest").select("path", "rep")
            .transform(arrow_map, runs, "path long, rep long"))


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def candidates(members: DataFrame, depth: int) -> DataFrame:
    """Pairs (a, b), a < b: each text with the centre of its largest subtree, or of the next one where it is the centre itself."""
    own = members.select(F.shiftright("path", 59 - 8 * depth).alias("node"), "rep")
    size = own.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
    sized = own.join(size, "node")
    weight = sized.groupBy("rep").agg(F.sum("size").alias("weight"))
    centre = (sized.join(weight, "rep").groupBy("node")
              .agg(F.max(F.struct("weight", (-F.col("rep")).alias("least"))).alias("m"))
              .select("node", (-F.col("m.least")).alias("centre")))
    return (sized.join(centre, "node").filter("rep != centre").groupBy("rep")
            .agg(F.max(F.struct("size", "centre")).alias("m")).select("rep", "m.centre").select(*_ordered("rep", "centre")).distinct())


def apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose texts are in different classes."""
    own = lambda c: classes.select(F.col("rep").alias(c), F.col("class_id").alias(f"class_{c}"))
    return (pairs.join(own("a"), "a", "left").join(own("b"), "b", "left")
            .filter(~F.coalesce("class_a", "a").eqNullSafe(F.coalesce("class_b", "b"))).select("a", "b"))


def in_subtrees(members: DataFrame, depth: int) -> DataFrame:
    """doc_id of each text that shares a prefix of this depth with another one."""
    own = members.select(F.shiftright("path", 59 - 8 * depth).alias("node"), "rep")
    shared = own.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1").select("node")
    return own.join(shared, "node").select(F.col("rep").alias("doc_id")).distinct()


def mixed_subtrees(members: DataFrame, classes: DataFrame, depth: int) -> DataFrame:
    """Members of the subtrees that hold more than one class: node, rep, own (class), main (the node's largest
    class), rest (texts outside of it), size (texts)."""
    named = (members.select(F.shiftright("path", 59 - 8 * depth).alias("node"), "rep").join(classes, "rep", "left")
             .select("node", "rep", F.coalesce("class_id", "rep").alias("own")))
    nodes = (named.groupBy("node", "own").agg(F.count("*").alias("n"))
             .groupBy("node").agg(F.max(F.struct("n", "own")).alias("m"), F.sum("n").alias("size")).filter("size > m.n")
             .select("node", F.col("m.own").alias("main"), (F.col("size") - F.col("m.n")).alias("rest"), "size"))
    return named.join(nodes, "node")


def least_equal(threshold: float, n: int = TREES * VALUES) -> int:
    """Equal MinHash values of a pair with the threshold's similarity: five standard deviations below the mean."""
    return int(np.floor(n * threshold - 5 * np.sqrt(n * threshold * (1 - threshold))))


def suspects(mixed: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Texts of different classes in a subtree that may be linked by their MinHash values: pairs (a, b), or texts a without b
    that have such partners in the pair of blocks (node, i, j); block is the text's own, own its class.

    Texts of the subtree's largest class have blocks of their own, which are not compared with each other.
    """
    at_least = least_equal(threshold)

    def compare(node, i, j, block, rep, own, sig) -> pa.RecordBatch:
        first, second = np.flatnonzero(block == i), np.flatnonzero(block == j)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step = max(1, AT_ONCE // (sig.shape[1] * max(1, len(second))))
        for at in range(0, len(first), step):
            part = first[at:at + step]
            alike = (sig[part][:, None, :] == sig[second][None, :, :]).sum(axis=2) >= at_least
            alike &= own[part][:, None] != own[second][None, :]
            if i == j:
                alike &= part[:, None] < second[None, :]
            x, y = np.nonzero(alike)
            a.append(part[x])
            b.append(second[y])
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a) <= FEW * len(rep):
            return _suspect_batch(rep[a], rep[b], len(a), None, None, None, None, None)
        k = np.unique(np.concatenate([a, b]))
        return _suspect_batch(rep[k], None, len(k), node, i, j, block[k], own[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy() for c in ("node", "i", "j", "block", "rep", "own")]
            now.append(np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(batch.num_rows, -1))
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            new = np.any([x[1:] != x[:-1] for x in now[:3]], axis=0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
            for at, end in zip(cuts, cuts[1:]):
                part = [x[at:end] for x in now]
                yield compare(*(x[0] for x in part[:3]), *part[3:])
            held = [x[cuts[-1]:] for x in now]
        if held is not None:
            yield compare(*(x[0] for x in held[:3]), *held[3:])

    main, one = F.col("own") == F.col("main"), F.col("size") <= COMPARED_TEXTS
    n_rest, n_main = F.ceil(F.col("rest") / COMPARED_TEXTS), F.ceil((F.col("size") - F.col("rest")) / COMPARED_TEXTS)
    zero, number = F.lit(0).cast("long"), F.xxhash64("rep")
    dealt = (mixed.join(reps.select("rep", "sig"), "rep")
             .withColumn("block", F.when(one, zero).when(main, n_rest + F.pmod(number, n_main)).otherwise(F.pmod(number, n_rest)))
             .withColumn("other", F.explode(F.sequence(zero, F.when(one, zero).otherwise(n_rest - 1 + F.when(main, zero).otherwise(n_main)))))
             .select("node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "own", "sig"))
    n = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, "node", "i", "j").sortWithinPartitions("node", "i", "j")
            .transform(arrow_map, run, "a long, b long, node long, i long, j long, block long, own long"))


def _suspect_batch(a, b, n, node, i, j, block, own) -> pa.RecordBatch:
    none = pa.nulls(n, pa.int64())
    full = lambda x: none if x is None else pa.array(np.broadcast_to(x, n).astype(np.int64))
    return pa.RecordBatch.from_arrays([full(x) for x in (a, b, node, i, j, block, own)], ["a", "b", "node", "i", "j", "block", "own"])


def _pick(texts: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Texts whose doc_id is (left_semi) or is not (left_anti) among ``ids``; few enough ids are broadcast."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return texts.join(ids, "doc_id", how)


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([grams(t).tobytes() for t in part.column(1).to_pylist()], pa.binary())],
                ["rep", "grams"])


def gram_sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """rep, grams (sorted distinct 64-bit hashes) of the given representatives."""
    return _pick(texts, ids, "left_semi").transform(arrow_map, _gram_batches, "rep long, grams binary")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b, similarity): pairs whose sets have this Jaccard similarity or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sims = [], []
            for k in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[k].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column(3)[k].as_buffer(), np.uint64)
                if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                    continue
                at = np.searchsorted(x, y)
                common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                if common >= threshold * (len(x) + len(y) - common):
                    keep.append(k)
                    sims.append(common / (len(x) + len(y) - common))
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at),
                                              pa.array(sims, pa.float64())], ["a", "b", "similarity"])

    left = sets.select(F.col("rep").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("grams").alias("y"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
            .transform(arrow_map, run, "a long, b long, similarity double"))


def recall_at(similarity: float, depth: int) -> float:
    """Chance that two texts share a prefix of this depth in some tree."""
    return 1 - (1 - similarity ** depth) ** TREES


def measured_recall(sample: Sample, reps: DataFrame, classes: DataFrame) -> tuple[float, DataFrame]:
    """Share of the sample's links with both ends in one class, and the links (a, b) of the others."""
    place = {k: n for n, k in enumerate(sample.keys)}
    chosen = {place[bytes(r["set_key"])]: r["rep"] for r in reps.filter(F.col("set_key").isin(sample.keys)).select("set_key", "rep").collect()}
    own = {r["rep"]: r["class_id"] for r in classes.filter(F.col("rep").isin(list(chosen.values()))).collect()}
    names = [chosen.get(k, -1) for k in range(len(place))]
    label = F.array(*[F.lit(own.get(c, c)).cast("long") for c in names])
    ends = (reps.filter(F.size("near") > 0).join(classes, "rep", "left")
            .select("rep", "near", F.coalesce("class_id", "rep").alias("own")))
    apart = stored(ends.select("rep", F.size("near").alias("n"),
                               F.filter("near", lambda k: F.get(label, k) != F.col("own")).alias("near")), "sample_links")
    row = apart.agg(F.sum("n").alias("all"), F.sum(F.size("near")).alias("lost")).first()
    name = F.array(*[F.lit(c).cast("long") for c in names])
    lost = apart.select("rep", F.explode("near").alias("k")).select("rep", F.get(name, F.col("k")).alias("other"))
    return 1 - row["lost"] / row["all"] if row["all"] else 1.0, lost.select(*_ordered("rep", "other")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(rep, class_id): the smallest id that links lead to; labels jump to their label's label in each round."""
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .distinct(), "edges")
    label = stored(edges.groupBy("a").agg(F.min("b").alias("m"))
                   .select(F.col("a").alias("rep"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (edges.join(label.select(F.col("rep").alias("b"), F.col("label").alias("l")), "b")
                .groupBy("a").agg(F.min("l").alias("l")).select(F.col("a").alias("rep"), "l"))
        low = label.join(near, "rep").select("rep", F.col("label").alias("old"), F.least("label", "l").alias("low"))
        jump = label.select(F.col("rep").alias("low"), F.col("label").alias("far"))
        new = stored(low.join(jump, "low", "left").select("rep", "old", F.least("low", "far").alias("label")), "labels")
        if not new.filter("label != old").limit(1).count():
            return new.select("rep", F.col("label").alias("class_id"))
        label = new.select("rep", "label")


def _class_blocks(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """class_id, i, j, block, rep, grams: each text of a class of three or more, once for each pair of blocks
    (i <= j) of which one is its own.  A block holds about BLOCK_TEXTS texts or BLOCK_BYTES of grams."""
    own = stored(sets.join(classes, "rep").select("class_id", "rep", "grams"), "class_sets")
    size = (own.groupBy("class_id")
            .agg(F.count("*").alias("size"), F.sum(F.length("grams")).alias("bytes")).filter("size > 2")
            .select("class_id", F.greatest(F.ceil(F.col("size") / BLOCK_TEXTS), F.ceil(F.col("bytes") / BLOCK_BYTES))
                    .alias("n")))
    dealt = own.join(size, "class_id").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n")))
    return (dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
            .select("class_id", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "rep", "grams"))


def shared_grams(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Grams that each set numbered in ``first`` shares with each other one in ``second``, as a matrix."""
    found, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    often = times > 1  # a gram of one set only is shared by none
    number = np.cumsum(often) - 1
    keep = often[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(first), len(second)), np.float64)
    for at in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row[a:b], column[a:b] - at] = 1
        common += has[first] @ has[second].T  # at most COLUMNS, exact in 32 bits
    return common.astype(np.int64)


def joining(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links (row, column) of a matrix that join all classes its links lead to; no more than there are classes."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    rows, columns = np.nonzero(linked & (left[:, None] != right[None, :]))
    for r, c, x, y in zip(rows.tolist(), columns.tolist(), left[rows].tolist(), right[columns].tolist()):
        if (x := find(x)) != (y := find(y)):
            parent[x] = y
            out.append((r, c))
    return out


def block_links(crowded: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b, similarity) that join classes, of the texts (node, i, j, block, rep, own) of each pair of blocks."""
    def run(group: pa.Table) -> pa.Table:
        block, rep, own = (group.column(c).to_numpy() for c in ("block", "rep", "own"))
        grams_of = [np.frombuffer(g.as_buffer(), np.uint64) for g in group.column("grams")]
        size = np.array([len(g) for g in grams_of])
        first, second = (np.flatnonzero(block == group.column(c)[0].as_py()) for c in ("i", "j"))
        a, b, sims = [], [], []
        if len(first) and len(second):
            common = shared_grams(grams_of, first, second)
            both = size[first][:, None] + size[second][None, :] - common
            for r, c in joining(common >= threshold * both, own[first], own[second]):
                x, y = int(rep[first[r]]), int(rep[second[c]])
                a.append(min(x, y))
                b.append(max(x, y))
                sims.append(common[r, c] / both[r, c])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(sims, pa.float64())})

    ship_package(sets.sparkSession)
    return (crowded.join(sets, "rep").repartition("node", "i", "j").groupBy("node", "i", "j")
            .applyInArrow(run, "a long, b long, similarity double"))


def link_counts(sets: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """rep, n_links: texts of its class with this Jaccard similarity or more (classes of three or more)."""
    def run(group: pa.Table) -> pa.Table:
        block, rep = group.column("block").to_numpy(), group.column("rep").to_numpy()
        grams_of = [np.frombuffer(g.as_buffer(), np.uint64) for g in group.column("grams")]
        size = np.array([len(g) for g in grams_of])
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        first, second = np.flatnonzero(block == i), np.flatnonzero(block == j)
        n = np.zeros(len(rep), np.int64)
        if len(first) and len(second):
            common = shared_grams(grams_of, first, second)
            linked = common >= threshold * (size[first][:, None] + size[second][None, :] - common)
            if i == j:
                np.fill_diagonal(linked, False)
                n[first] = linked.sum(axis=1)
            else:
                n[first], n[second] = linked.sum(axis=1), linked.sum(axis=0)
        return pa.table({"rep": pa.array(rep, pa.int64()), "n": pa.array(n, pa.int64())})

    ship_package(sets.sparkSession)
    blocks = _class_blocks(sets, classes)
    # dealt by pairs of blocks: a partitioning by class would do for the groups, but put a large class into one task
    return (blocks.repartition("class_id", "i", "j").groupBy("class_id", "i", "j").applyInArrow(run, "rep long, n long")
            .groupBy("rep").agg(F.sum("n").alias("n_links")))


@dataclass(frozen=True)
class Joined:
    """Stored parts of a join: documents with their set_key, a representative for each set, gram sets
    of the candidates, classes of the linked representatives; the measured recall before the sample's own links."""

    signed: DataFrame
    reps: DataFrame
    sets: DataFrame
    classes: DataFrame
    recall: float


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
               target_recall: float = TARGET_RECALL) -> Joined:
    """Runs the join (steps 1 to 5); signatures, tries, candidates, links and classes are written to the shared folder."""
    texts = _texts(docs, id_col, text_col)
    sample = choose_sample(texts, threshold)
    signed = stored(signatures(docs, id_col, text_col, sample), "signatures")
    copies = (signed.filter("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key")
              .agg(F.min(F.struct("doc_id", "sig", "near")).alias("m"))
              .select("set_key", F.col("m.doc_id").alias("rep"), F.col("m.sig").alias("sig"), F.col("m.near").alias("near")))
    reps = stored(copies, "representatives")
    members = stored(forest(reps), "members")

    fits = [k for k in range(SHALLOWEST, DEEPEST + 1) if recall_at(threshold, k) >= target_recall]
    depth = max(fits, default=SHALLOWEST)
    links = tried = sets = None
    classes = docs.sparkSession.createDataFrame([], "rep long, class_id long")
    while True:
        ids = in_subtrees(members, depth)
        if sets is not None:
            ids = ids.join(sets.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti")
        own = stored(gram_sets(texts, stored(ids, "ids")).dropDuplicates(["rep"]), "sets")
        sets = own if sets is None else sets.unionByName(own)
        for step in ("centres", "subtrees"):
            if step == "centres":
                pairs, blocks = candidates(members, depth), None
            else:
                found = stored(suspects(mixed_subtrees(members, classes, depth), reps, threshold), "suspects")
                pairs = found.filter("b IS NOT NULL").select(*_ordered("a", "b")).distinct()
                blocks = found.filter("b IS NULL").withColumnRenamed("a", "rep").drop("b")
            if tried is not None:
                pairs = apart(pairs.join(tried, ["a", "b"], "left_anti"), classes)
            pairs = stored(pairs, "pairs")
            tried = pairs if tried is None else tried.unionByName(pairs)
            new = verified(pairs, sets, threshold)
            if blocks is not None and blocks.limit(1).count():
                new = new.unionByName(block_links(blocks, sets, threshold))
            new = stored(new, "links")
            if links is None or new.limit(1).count():
                links = new if links is None else links.unionByName(new)
                classes = components(links)
        recall, lost = measured_recall(sample, reps, classes)
        if depth <= SHALLOWEST or recall >= target_recall:
            break
        depth -= 1
    if recall < target_recall:
        warnings.warn(f"recall {recall:.4f} of the sampled links at the shallowest depth, asked for {target_recall}", stacklevel=2)
    if recall < 1:
        lost = stored(lost, "lost")
        ids = (lost.select(F.col("a").alias("doc_id")).unionByName(lost.select(F.col("b").alias("doc_id"))).distinct()
               .join(sets.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti"))
        sets = sets.unionByName(stored(gram_sets(texts, stored(ids, "ids")).dropDuplicates(["rep"]), "sets"))
        classes = components(links.select("a", "b").unionByName(lost))
    return Joined(signed, reps, sets, classes, recall)


def _classified(joined: Joined) -> DataFrame:
    known = joined.reps.select("set_key", "rep").join(joined.classes, "rep", "left")
    return (joined.signed.select("doc_id", "set_key").join(known, "set_key", "left")
            .select("doc_id", "rep", F.coalesce("rep", "doc_id").alias("rep_id"),
                    F.coalesce("class_id", "rep", "doc_id").alias("class_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row for each document: doc_id, rep_id (the smallest id with the same grams), class_id (the smallest id of
    its class) and n_links (links of its text to different texts).  Runs jobs, see ``ngram_join``.
    """
    joined = ngram_join(docs, id_col, text_col, threshold, target_recall)
    counts = link_counts(joined.sets, joined.classes, threshold)
    pairs = joined.classes.groupBy("class_id").agg(F.count("*").alias("size")).filter("size = 2").select("class_id")
    degree = counts.unionByName(joined.classes.join(pairs, "class_id").select("rep", F.lit(1).cast("long").alias("n_links")))
    return (_classified(joined).join(degree, "rep", "left")
            .select("doc_id", "rep_id", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents (all their columns) without those whose class has a smaller doc_id; of rows with
    the same doc_id and text one stays.  Documents without an id stay."""
    found = stored(_classified(ngram_join(docs, threshold=threshold)), "classes")
    gone = found.filter("doc_id != class_id").select("doc_id").distinct()
    twice = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1") \
        .select("doc_id")
    kept = _pick(docs, gone, "left_anti")
    if not twice.limit(1).count():
        return kept
    twice = stored(twice, "repeated")
    return _pick(kept, twice, "left_anti").unionByName(
        _pick(kept, twice, "left_semi").dropDuplicates(["doc_id", "text"]))
