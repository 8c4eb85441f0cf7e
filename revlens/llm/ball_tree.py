"""Ranked lexical search: exact inner products of sparse vectors, found through ball trees.

A document's score for an item is the inner product of the item's weights w (a term's rarity) with the document's
parts u (how often the term stands in it, against its length), all in whole numbers.

1. Items give the terms that count.  One pass over the texts keeps, for each document, its length and how often it has
   each of these terms; the stored result gives the counts of the corpus (documents, words, documents that hold a term).
2. Documents are gathered, where they lie, into blocks of bounded size.  Each block is a ball tree over its vectors u: a
   node has a centre of whole numbers and a radius that is rounded up, and is halved where its members spread most until
   it is small or all its members are copies.  The trees are written once; items can be searched in them group by group.
3. A node cannot hold a score above w * centre + |w| * radius, where w is the item's weights on terms that the node has
   (rounded up, so no document is lost).  Items go down a tree together: the node whose bound passes an item's
   threshold by most comes first, with the items whose threshold its bound reaches; documents of a leaf are scored exactly.
   A threshold is the k-th best score that the task has found.
4. Thresholds start from a probe: in a bounded number of blocks the best few leaves are scored.  The k-th best of some
   documents is never above that of all, so this loses nothing; tasks then pass on few documents.

Defined results: a null text has no term; documents without a term count nowhere.  Every row is a document, also repeated
ones; rows without an id come after those with the same score.  Rows of the same item_id are one item with the terms
of all; rows without item_id are none.  Other columns are not read.  Empty tables give no row.
Ids may be of any type that can be ordered.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, stored

#: Best documents of an item.
TOP = 50
#: Documents and parts of a block, and documents of a leaf.
BLOCK_DOCS, BLOCK_PARTS, LEAF = 8_192, 4_000_000, 64
#: Terms of the items that one pass over the texts looks for, about (they pass the driver).
PASS_TERMS = 2_000_000
#: Items that go down a tree together.
GROUP = 512
#: Blocks of the probe, and leaves that are scored in each.
PROBE_BLOCKS, PROBE_LEAVES = 64, 8
#: Hits that a task holds before it sorts them.
HELD = 20_000

#: Bytes of a term, A-Z as a-z; all others end it.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of digits, ASCII letters and other characters than ASCII, A-Z as a-z, in UTF-8."""
    return (text or "").encode("utf-8", "replace").translate(TERM_BYTES).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item, term: the distinct terms of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(set(terms_of(t))) for t in b.column(1).to_pylist()]
            at = pa.array(np.repeat(np.arange(b.num_rows), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array([t for x in found for t in x], pa.binary())],
                                             ["item", "term"])

    own = items.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").cast("string")).filter("item IS NOT NULL")
    schema = T.StructType([own.schema["item"], T.StructField("term", T.BinaryType())])
    return own.transform(arrow_map, run, schema).distinct()


def term_counts(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """doc, n (its terms with repeats), parts (numbers of the vocabulary's terms in it, 32 bits), times (of each, 32 bits)
    for documents with a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(vocabulary)}
        for b in batches:
            rows, n, parts, times = [], [], [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                if words := terms_of(text):
                    term, often = np.unique(np.array([number[w] for w in words if w in number], np.int32), return_counts=True)
                    rows.append(k)
                    n.append(len(words))
                    parts.append(term.tobytes())
                    times.append(often.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                                              pa.array(parts, pa.binary()), pa.array(times, pa.binary())], ["doc", "n", "parts", "times"])

    own = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").cast("string"))
    return own.transform(arrow_map, run, T.StructType([
        own.schema["doc"], T.StructField("n", T.LongType()), T.StructField("parts", T.BinaryType()), T.StructField("times", T.BinaryType())]))


def documents_with(counts: DataFrame, n_terms: int) -> np.ndarray:
    """For each term of the vocabulary, the documents that hold it (each task adds up its own)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32), minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    df = np.zeros(n_terms, np.int64)
    for r in counts.select("parts").transform(arrow_map, run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def parts_of(times: np.ndarray, length: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """u of each part from its times and its document's length."""
    m = np.array([100 - 50 + (50 * n * n_docs) // n_words for n in length.tolist()], np.int64)
    return (1_000_000_000 * times.astype(np.int64)) // (1000 * times.astype(np.int64) + 20 * m)


class Sparse:
    """Rows of (column, value) pairs; all numbers whole."""

    def __init__(self, size: np.ndarray, column: np.ndarray, value: np.ndarray):
        self.end = np.cumsum(size)
        self.size, self.column, self.value = size, column, value

    def take(self, rows: np.ndarray) -> Sparse:
        size = self.size[rows]
        at = np.arange(size.sum()) + np.repeat((self.end - self.size)[rows] - (np.cumsum(size) - size), size)
        return Sparse(size, self.column[at], self.value[at])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of ``values`` (one for each pair) in each row."""
        total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
        return total[self.end] - total[self.end - self.size]

    def dense(self, column: np.ndarray) -> np.ndarray:
        """As a matrix over sorted columns that hold all its own."""
        out = np.zeros((len(self.size), len(column)), np.int64)
        out[np.repeat(np.arange(len(self.size)), self.size), np.searchsorted(column, self.column)] = self.value
        return out


def _root_up(square: np.ndarray) -> np.ndarray:
    """Square roots of whole numbers, rounded up."""
    return np.where(square > 0, np.ceil(np.sqrt(square.astype(np.float64)) * (1 + 1e-12)), 0).astype(np.int64)


class Tree:
    """A ball tree over the rows of a sparse matrix.

    Nodes are numbered parents first; ``child`` is a node's first child (the second follows) or -1 at a leaf, ``begin`` and
    ``end`` its rows.  ``centres`` has a row for each node, with all columns that its rows have.
    """

    def __init__(self, rows: Sparse, order: np.ndarray, begin, end, child, radius, centres: Sparse):
        self.rows, self.order, self.begin, self.end, self.child, self.radius, self.centres = rows, order, begin, end, child, radius, centres

    @classmethod
    def grown(cls, rows: Sparse, leaf: int = LEAF) -> Tree:
        n = len(rows.size)
        column, local = np.unique(rows.column, return_inverse=True)
        own = Sparse(rows.size, local, rows.value)
        order = np.arange(n)
        begin, end, child, radius = [0], [n], [-1], [0]
        centres: list[tuple[np.ndarray, np.ndarray]] = []
        k = 0
        while k < len(begin):
            members = order[begin[k]:end[k]]
            part = own.take(members)
            total = np.bincount(part.column, part.value, len(column)).astype(np.int64)  # sums stay below 2 ** 53
            some = np.flatnonzero(total)
            centre = total // max(1, len(members))
            centres.append((column[some], centre[some]))
            norms = part.sums(part.value * part.value)
            far = norms - 2 * part.sums(part.value * centre[part.column]) + int((centre * centre).sum())
            radius[k] = int(_root_up(far.max(initial=0)))
            if len(members) > leaf and _differ(part):
                side = _spread(part, centre, len(column), k)
                order[begin[k]:end[k]] = members[np.argsort(side, kind="stable")]
                middle = begin[k] + len(members) // 2
                child[k] = len(begin)
                begin += [begin[k], middle]
                end += [middle, end[k]]
                child += [-1, -1]
                radius += [0, 0]
            k += 1
        size = np.array([len(c) for c, _ in centres])
        return cls(rows.take(order), order, np.array(begin), np.array(end), np.array(child), np.array(radius, np.int64),
                   Sparse(size, np.concatenate([c for c, _ in centres]), np.concatenate([v for _, v in centres])))

    FIELDS = (("order", "<i4"), ("size", "<i4"), ("column", "<i4"), ("value", "<i4"), ("begin", "<i4"), ("end", "<i4"), ("child", "<i4"),
              ("radius", "<i8"), ("centre_size", "<i4"), ("centre_column", "<i4"), ("centre_value", "<i4"))

    def packed(self) -> list[bytes]:
        parts = (self.order, self.rows.size, self.rows.column, self.rows.value, self.begin, self.end, self.child, self.radius,
                 self.centres.size, self.centres.column, self.centres.value)
        return [p.astype(kind).tobytes() for p, (_, kind) in zip(parts, self.FIELDS)]

    @classmethod
    def unpacked(cls, parts: list[bytes]) -> Tree:
        order, size, column, value, begin, end, child, radius, centre_size, centre_column, centre_value = (
            np.frombuffer(p, kind).astype(np.int64) for p, (_, kind) in zip(parts, cls.FIELDS))
        return cls(Sparse(size, column, value), order, begin, end, child, radius, Sparse(centre_size, centre_column, centre_value))

    def leaf(self, k: int) -> Sparse:
        return self.rows.take(np.arange(self.begin[k], self.end[k]))


def _differ(part: Sparse) -> bool:
    """False if all rows are copies of the first."""
    first = slice(0, part.size[0])
    return not ((part.size == part.size[0]).all() and (part.column.reshape(len(part.size), -1) == part.column[first]).all()
                and (part.value.reshape(len(part.size), -1) == part.value[first]).all())


def _spread(part: Sparse, centre: np.ndarray, width: int, seed: int, rounds: int = 2) -> np.ndarray:
    """Places of the rows along a direction in which they spread widely (power iterations from a random one).
    Rows that share terms lie close together; any direction gives a right tree."""
    way, value = np.random.default_rng(seed).normal(size=width), part.value.astype(np.float64)
    for _ in range(rounds):
        side = part.sums(value * way[part.column]) - centre @ way
        way = np.bincount(part.column, value * np.repeat(side, part.size), width) - centre * side.sum()
        way /= max(np.abs(way).max(), 1e-300)
    return part.sums(value * way[part.column])


class Search:
    """The best rows for a group of items, over any number of trees.

    ``items`` has a row of (term, weight) pairs for each item.
    """

    def __init__(self, items: Sparse, n_terms: int, threshold: np.ndarray, top: int = TOP):
        self.items, self.n_terms, self.top = items, n_terms, top
        self.threshold = np.maximum(threshold, 1)
        self.best: list[tuple[int, int, object]] = []  # (item, score, id) of the best
        self.new: list[tuple[np.ndarray, np.ndarray, list]] = []
        self.held = 0
        self.scored = 0

    def bounds(self, tree: Tree, k: int) -> np.ndarray:
        """No row of the node has a higher score with the item."""
        centre = np.zeros(self.n_terms, np.int64)
        has = np.zeros(self.n_terms, np.int64)
        at = slice(tree.centres.end[k] - tree.centres.size[k], tree.centres.end[k])
        centre[tree.centres.column[at]] = tree.centres.value[at]
        has[tree.centres.column[at]] = 1
        w = self.items.value * has[self.items.column]
        return self.items.sums(w * centre[self.items.column]) + _root_up(self.items.sums(w * w)) * tree.radius[k]

    def visit(self, tree: Tree, ids: list, leaves: int | None = None) -> None:
        """Best-first through a tree; ``leaves``: of which so many are scored at most."""
        waiting: list[tuple[int, int, np.ndarray]] = []

        def push(k: int, above: np.ndarray | None) -> None:
            bound = self.bounds(tree, k)
            if above is not None:
                bound = np.minimum(bound, above)
            if (bound >= self.threshold).any():
                heapq.heappush(waiting, (-int((bound - self.threshold).max()), k, bound))

        push(0, None)
        while waiting and (leaves is None or leaves > 0):
            _, k, bound = heapq.heappop(waiting)
            alive = np.flatnonzero(bound >= self.threshold)
            if not len(alive):
                continue
            if (first := int(tree.child[k])) >= 0:
                push(first, bound)
                push(first + 1, bound)
                continue
            self._score(tree, k, alive, ids)
            leaves = None if leaves is None else leaves - 1

    def _score(self, tree: Tree, k: int, alive: np.ndarray, ids: list) -> None:
        rows, items = tree.leaf(k), self.items.take(alive)
        column = np.unique(rows.column)
        at = np.searchsorted(column, items.column)
        at[at == len(column)] = 0
        known = column[at] == items.column if len(column) else np.zeros(len(items.column), bool)
        if not known.any():
            return
        u = rows.dense(column)
        owner = np.repeat(np.arange(len(alive)), items.size)[known]
        many = np.bincount(owner, minlength=len(alive))
        some = np.flatnonzero(many)
        w = np.ascontiguousarray(u.T)[at[known]] * items.value[known][:, None]
        score = np.add.reduceat(w, (np.cumsum(many) - many)[some], axis=0)  # item, row
        self.scored += score.size
        hit, row = np.nonzero(score >= self.threshold[alive[some]][:, None])
        if len(hit):
            self.new.append((alive[some[hit]], score[hit, row], [ids[int(o)] for o in tree.order[tree.begin[k] + row]]))
            self.held += len(hit)
            if self.held >= HELD:
                self.settle()

    def settle(self) -> None:
        """Keep the best of each item; its threshold becomes their last score."""
        rows = self.best + [x for item, score, ids in self.new for x in zip(item.tolist(), score.tolist(), ids)]
        rows.sort(key=lambda r: (r[0], -r[1], r[2] is None, r[2] if r[2] is not None else 0))
        self.best, self.new, self.held, seen, last = [], [], 0, 0, None
        for r in rows:
            seen = seen + 1 if r[0] == last else 1
            last = r[0]
            if seen <= self.top:
                self.best.append(r)
            if seen == self.top:
                self.threshold[r[0]] = max(self.threshold[r[0]], r[1])


def grow_trees(counts: DataFrame, n_docs: int, n_words: int, block_docs: int = BLOCK_DOCS, block_parts: int = BLOCK_PARTS) -> DataFrame:
    """A row for each block of documents: block, docs (their ids) and the tree's parts."""
    names = [n for n, _ in Tree.FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, made, waiting, docs, parts = TaskContext.get().partitionId(), 0, [], 0, 0

        def block() -> pa.RecordBatch:
            nonlocal waiting, docs, parts, made
            whole = pa.Table.from_batches(waiting)
            size = np.array([len(x) // 4 for x in whole.column("parts").to_pylist()], np.int64)
            column, times = (np.frombuffer(b"".join(whole.column(c).to_pylist()), np.int32) for c in ("parts", "times"))
            u = parts_of(times, np.repeat(whole.column("n").to_numpy(), size), n_docs, n_words)
            tree = Tree.grown(Sparse(size, column.astype(np.int64), u))
            ids = whole.column("doc").combine_chunks()
            out = [pa.array([(task << 32) + made], pa.int64()), pa.array([ids.to_pylist()], pa.list_(ids.type)),
                   *(pa.array([p], pa.binary()) for p in tree.packed())]
            waiting, docs, parts, made = [], 0, 0, made + 1
            return pa.RecordBatch.from_arrays(out, ["block", "docs", *names])

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                waiting.append(part)
                docs += part.num_rows
                parts += part.column("parts").nbytes // 4
                if docs >= block_docs or parts >= block_parts:
                    yield block()
        if docs:
            yield block()

    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(counts.schema["doc"].dataType)),
                           *(T.StructField(n, T.BinaryType()) for n in names)])
    return counts.filter(F.length("parts") > 0).transform(arrow_map, run, schema)


def search_trees(trees: DataFrame, items: Sparse, n_terms: int, threshold: np.ndarray, top: int = TOP, leaves: int | None = None) -> DataFrame:
    """item (its row's number), doc, score: what each task finds best."""
    names = [n for n, _ in Tree.FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = [(at, Search(items.take(np.arange(at, min(at + GROUP, len(items.size)))), n_terms, threshold[at:at + GROUP].copy(), top))
                  for at in range(0, len(items.size), GROUP)]
        kind = None
        for b in batches:
            kind = b.column("docs").type.value_type
            for k in range(b.num_rows):
                tree, ids = Tree.unpacked([b.column(n)[k].as_py() for n in names]), b.column("docs")[k].as_py()
                for _, search in groups:
                    search.visit(tree, ids, leaves)
        for at, search in groups:
            search.settle()
            if search.best:
                item, score, doc = zip(*search.best)
                yield pa.RecordBatch.from_arrays([pa.array([at + i for i in item], pa.int32()), pa.array(doc, kind),
                                                  pa.array(score, pa.int64())], ["item", "doc", "score"])

    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc", trees.schema["docs"].dataType.elementType),
                           T.StructField("score", T.LongType())])
    return trees.select("docs", *names).transform(arrow_map, run, schema)


def _searched(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, top: int) -> DataFrame:
    """item, doc, score for the items of one pass (pairs: item, term), as the tasks found them."""
    spark = docs.sparkSession
    own = pairs.orderBy("item", "term").collect()
    vocabulary = sorted({bytes(r["term"]) for r in own})
    number = {t: k for k, t in enumerate(vocabulary)}
    counts = stored(term_counts(docs, vocabulary, id_col, text_col), "term_counts")
    row = counts.agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
    names = list(dict.fromkeys(r["item"] for r in own))
    place = {x: k for k, x in enumerate(names)}
    df = documents_with(counts, len(vocabulary)) if row["docs"] else np.zeros(len(vocabulary), np.int64)
    w = weights(row["docs"], df)
    column = np.array([number[bytes(r["term"])] for r in own], np.int64)
    owner = np.array([place[r["item"]] for r in own], np.int64)
    keep = df[column] > 0  # a term of no document only loosens bounds
    items = Sparse(np.bincount(owner[keep], minlength=len(names)), column[keep], w[column[keep]])

    trees = stored(grow_trees(counts, row["docs"], row["words"] or 1), "trees")
    n_blocks = trees.count()
    threshold = np.ones(len(names), np.int64)
    probe = search_trees(trees.filter(F.pmod(F.xxhash64("block"), F.lit(max(1, n_blocks))) < PROBE_BLOCKS), items, len(vocabulary),
                         threshold, top, PROBE_LEAVES)
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    for r in probe.withColumn("k", F.row_number().over(order)).filter(F.col("k") == top).select("item", "score").collect():
        threshold[r["item"]] = r["score"]
    found = search_trees(trees, items, len(vocabulary), threshold, top)
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", pairs.schema["item"].dataType)])
    return found.join(spark.createDataFrame([(k, x) for k, x in enumerate(names)], schema), "item").select("item_id", "doc", "score")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", top: int = TOP, pass_terms: int = PASS_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents with the highest scores above 0 for each item.  Runs jobs: counts and
    trees are written to the shared folder.  Items with more than ``pass_terms`` terms in all take several passes."""
    pairs = stored(item_terms(items, item_col, item_text_col), "item_terms")
    n = max(1, -(-pairs.count() // pass_terms))
    found = None
    for k in range(n):
        own = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        if n > 1 or own.limit(1).count():
            part = _searched(docs, own, id_col, text_col, top)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_id", items.schema[item_col].dataType), T.StructField("doc", docs.schema[id_col].dataType),
            T.StructField("score", T.LongType())]))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select(F.col("item_id").alias(item_col), "rank", F.col("doc").alias(id_col), "score"))
