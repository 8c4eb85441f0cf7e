"""Hard-negative mining with bounds along spanning trees of the anchors.

Vectors become integers (floor(256 * x)), a row's score is its inner product with the anchor.  Scores of an
anchor tell much about the scores of an anchor near to it: if c and p are d apart, the scores of a row x differ
by d * |x| at most.

1. Anchors are grouped by label and by the nearest of a bounded number of pivots, large groups are dealt into
   sub-groups of about ``TREE`` anchors, and each gets its minimum spanning tree (Prim), in an order that keeps few
   parents waiting: a node's largest branch comes last.
2. Rows are dealt by vec_id into blocks, and each block gets all trees, one after another: nothing of the table
   passes the driver, and a task holds one block and one tree.
3. In a block the root of a tree is scored exactly against every row.  A child's scores are bounded by its parent's
   (exact or bounds themselves) plus or minus edge length times the row's norm, and by Cauchy-Schwarz.  Only rows
   whose bounds overlap the asked window are scored again, those with the highest upper bounds first, so that
   the k-th best of them closes the window for the rest.  Lengths and norms are rounded up: no row is lost.
4. First pass: an anchor's best rows of the same label.  Each block gives its best few, a window over one anchor's
   rows gives the best of all.  Second pass: for each anchor and positive, the best rows of other labels with a
   score in the positive's window.

Defined results: rows without vec_id, label or vector, or with a null or non-finite component, take no part.
Rows with the same vec_id are one vector, the one with the smallest label and then the smallest components as bytes.  A shorter
vector counts as filled up with zeros.  Equal scores go by vec_id.  A positive with a negative score has an empty window.
Other columns are not read; an empty table gives no row.  Components have to fit 32 bits when multiplied by 256
(others count as non-finite), and scores 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, ship_package, stored

#: Anchors of a tree, about; pivots that group them, at most (their vectors pass the driver).
TREE, PIVOTS = 512, 512
#: Rows of a block, about.
BLOCK_ROWS = 131_072
#: Rows with the highest bounds that are scored first.
FIRST = 256
#: Sums below these are exact in numbers of 32 and of 64 bits.
EXACT_32, EXACT_64 = 1 << 24, 1 << 53


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
              scale: int = 256) -> DataFrame:
    """vec_id, label, v (components as little-endian 32-bit integers) of the rows that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null components: nan
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(flat * scale)
                good = np.abs(x) < 2.0 ** 31  # false for nan and infinity
            end = np.cumsum(size)
            wrong = np.concatenate([[0], np.cumsum(~good)])
            keep = np.flatnonzero(wrong[end] == wrong[end - size])
            data = np.where(good, x, 0).astype("<i4")
            v = [data[end[k] - size[k]:end[k]].tobytes() for k in keep.tolist()]
            at = pa.array(keep)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(v, pa.binary())],
                                             ["vec_id", "label", "v"])

    own = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                         F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    return own.dropna().transform(arrow_map, run, "vec_id long, label long, v binary")


def _vectors(parts: list, dims: int = 0) -> np.ndarray:
    """Binary vectors as a matrix of 64-bit integers; shorter ones end in zeros."""
    parts = [x or b"" for x in parts]
    width = max([dims * 4, *map(len, parts)]) if parts else dims * 4
    whole = b"".join(x if len(x) == width else x.ljust(width, b"\0") for x in parts)
    return np.frombuffer(whole, "<i4").reshape(len(parts), width // 4).astype(np.int64)


def _norms(x: np.ndarray) -> np.ndarray:
    """Lengths, rounded up."""
    square = np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    return np.where(square > 0, np.ceil(np.sqrt(square) * (1 + 1e-12)), 0)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows: (order, parent, length).  ``order`` lists rows, parents before children and
    a node's largest branch last; ``parent`` is the parent's place in the order (root: -1); ``length`` is rounded up."""
    n = len(x)
    own = x.astype(np.float64)
    near = np.full(n, np.inf)
    link, up = np.full(n, -1), np.full(n, -1)
    done = np.zeros(n, bool)
    at, taken = 0, []
    for _ in range(n):
        done[at] = True
        taken.append(at)
        up[at] = link[at]
        gap = own - own[at]
        square = np.einsum("ij,ij->i", gap, gap)
        closer = ~done & (square < near)
        near[closer], link[closer] = square[closer], at
        at = int(np.where(done, np.inf, near).argmin())
    size = np.ones(n, np.int64)
    for k in reversed(taken):
        if up[k] >= 0:
            size[up[k]] += size[k]
    children: list[list[int]] = [[] for _ in range(n)]
    for k in taken[1:]:
        children[up[k]].append(k)
    order, waiting = [], [0] if n else []
    while waiting:
        k = waiting.pop()
        order.append(k)
        waiting += sorted(children[k], key=lambda c: -size[c])  # the smallest is taken first
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    parent = np.array([place[up[k]] if up[k] >= 0 else -1 for k in order], np.int64)
    length = np.array([_norms(x[k:k + 1] - x[up[k]:up[k] + 1])[0] if up[k] >= 0 else 0 for k in order])
    return np.array(order, np.int64), parent, length


TREES = "tree string, at int, parent int, length double, vec_id long, label long, v binary"


def anchor_trees(anchors: DataFrame, tree_size: int = TREE) -> DataFrame:
    """Anchors (vec_id, label, v) with tree, place in it (at), the parent's place and the edge's length."""
    n = anchors.count()
    pivots = _vectors([bytes(r["v"]) for r in anchors.select("v").orderBy(F.xxhash64("vec_id"), "vec_id")
                      .limit(min(PIVOTS, -(-n // tree_size))).collect()]).astype(np.float64)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _vectors(b.column(2).to_pylist(), pivots.shape[1]).astype(np.float64)
            own = np.pad(pivots, ((0, 0), (0, x.shape[1] - pivots.shape[1])))
            far = (own * own).sum(axis=1) - 2 * x @ own.T
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(far.argmin(axis=1).astype(np.int32) if len(own) else
                                                                   np.zeros(len(x), np.int32))], ["vec_id", "label", "v", "pivot"])

    def grow(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        order, parent, length = spanning_tree(_vectors(group.column("v").to_pylist()))
        own = group.take(pa.array(order))
        return pa.table({"tree": own.column("tree"), "at": pa.array(range(len(order)), pa.int32()),
                         "parent": pa.array(parent, pa.int32()), "length": pa.array(length, pa.float64()),
                         "vec_id": own.column("vec_id"), "label": own.column("label"), "v": own.column("v")})

    ship_package(anchors.sparkSession)
    near = anchors.transform(arrow_map, nearest, "vec_id long, label long, v binary, pivot int")
    size = near.groupBy("label", "pivot").agg(F.ceil(F.count("*") / tree_size).alias("n"))
    dealt = near.join(size, ["label", "pivot"]).withColumn(
        "tree", F.concat_ws("/", "label", "pivot", F.pmod(F.xxhash64("vec_id"), F.col("n"))))
    return dealt.select("tree", "vec_id", "label", "v").groupBy("tree").applyInArrow(grow, TREES)


class Block:
    """Rows of a block, sorted by vec_id, for scoring."""

    def __init__(self, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray):
        self.vec_id, self.label, self.norm = vec_id, label, _norms(x)
        self.top = float(self.norm.max(initial=0))
        self.kinds = {np.int64: x}

    def scores(self, anchor: np.ndarray, norm: float, rows: np.ndarray | None = None) -> np.ndarray:
        """Exact inner products (no sum passes the product of the norms)."""
        most = self.top * norm
        kind = np.float32 if most < EXACT_32 else np.float64 if most < EXACT_64 else np.int64
        if kind not in self.kinds:
            self.kinds[kind] = self.kinds[np.int64].astype(kind)
        x = self.kinds[kind] if rows is None else self.kinds[kind][rows]
        out = x @ anchor.astype(kind)
        if kind is np.int64 and most >= 1 << 63:  # a sum that 64 bits cannot hold stands rounded, not wrapped around
            near = x.astype(np.float64) @ anchor.astype(np.float64)
            beyond = np.abs(near) >= float(1 << 63) - 1e-12 * most
            return np.where(beyond, near, out) if beyond.any() else out
        return out if kind is np.int64 else out.astype(np.float64)


@dataclass
class Tally:
    """Scores that were worked out, of so many pairs of anchor and row."""

    scored: int = 0
    pairs: int = 0


@dataclass
class Bounded:
    """Bounds of an anchor's scores; equal ones are exact."""

    block: Block
    anchor: np.ndarray
    norm: float
    low: np.ndarray
    high: np.ndarray
    tally: Tally = field(default_factory=Tally)

    def score(self, rows: np.ndarray) -> None:
        rows = rows[self.low[rows] != self.high[rows]]
        if len(rows):
            self.tally.scored += len(rows)
            self.low[rows] = self.high[rows] = self.block.scores(self.anchor, self.norm, rows)

    def best(self, allowed: np.ndarray, windows: list[tuple[float, float]], k: int) -> list[np.ndarray]:
        """For each window (lowest and highest score) the rows with the k best scores in it, best first."""
        if not windows:
            return []
        first, last = min(w[0] for w in windows), max(w[1] for w in windows)
        rows = np.flatnonzero(allowed & (self.high >= first) & (self.low <= last))
        if len(rows) > max(FIRST, 4 * k):
            top = rows[np.argpartition(-self.high[rows], FIRST)[:FIRST]]
            self.score(top)
            least = min(self._kth(top, w, k) for w in windows)
            rows = rows[self.high[rows] >= least]
        self.score(rows)
        score = self.low[rows]
        out = []
        for w in windows:
            inside = rows[(score >= w[0]) & (score <= w[1])]
            if len(inside) > k:
                inside = inside[self.low[inside] >= self._kth(inside, w, k)]
            out.append(inside[np.argsort(-self.low[inside], kind="stable")][:k])  # rows are in the order of vec_id
        return out

    def _kth(self, rows: np.ndarray, window: tuple[float, float], k: int) -> float:
        """The k-th best score of scored rows in the window; the window's lowest if there are fewer."""
        s = self.low[rows]
        s = s[(s >= window[0]) & (s <= window[1])]
        return float(-np.partition(-s, k - 1)[k - 1]) if len(s) >= k else window[0]


def walk(block: Block, x: np.ndarray, parent: np.ndarray, length: np.ndarray, tally: Tally | None = None) -> Iterator[Bounded]:
    """The anchors of a tree with bounds from their parents, in the tree's order.  What the user scores exactly
    while it holds an anchor narrows the bounds of the anchor's children."""
    norm, waiting = _norms(x), np.bincount(parent[parent >= 0], minlength=len(x))
    tally = tally or Tally()
    held: dict[int, Bounded] = {}
    for k in range(len(x)):
        up = int(parent[k])
        tally.pairs += len(block.norm)
        if up < 0:
            low = block.scores(x[k], norm[k])
            now = Bounded(block, x[k], norm[k], low, low.copy(), tally)
            tally.scored += len(low)
        else:
            # numbers of 64 bits carry 53 bits: a relative margin keeps rounded bounds safe
            reach, most = length[k] * block.norm * (1 + 1e-12), norm[k] * block.norm * (1 + 1e-12)
            from_low, from_high = held[up].low, held[up].high
            margin = 0 if block.top * norm.max() < EXACT_64 else 1e-12 * most
            now = Bounded(block, x[k], norm[k], np.maximum(from_low - reach - margin, -most),
                          np.minimum(from_high + reach + margin, most), tally)
            waiting[up] -= 1
            if not waiting[up]:
                del held[up]
        if waiting[k]:
            held[k] = now
        yield now


def _by_block(rows: DataFrame, trees: DataFrame, per_tree, schema: str) -> DataFrame:
    """``per_tree(block, tree)`` (tree: a table of its rows in order) for each block and tree; it gives tables."""
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BLOCK_ROWS))
    extra = [f for f in trees.schema.fields if f.name not in ("vec_id", "label", "v")]
    left = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id", "label", "v",
                       *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])
    right = trees.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"), F.lit(1).alias("kind"), "vec_id", "label",
                         "v", *[f.name for f in extra])
    dealt = left.unionByName(right).repartitionById(n, F.col("block")).sortWithinPartitions("block", "kind", "tree", "at", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        candidates, block, tree, own, name = [], None, [], None, None

        def flush() -> list[pa.RecordBatch]:
            nonlocal tree
            made = per_tree(block, pa.Table.from_batches(tree)).to_batches() if tree and block is not None else []
            tree = []
            return made

        for b in batches:
            if not b.num_rows:
                continue
            places, kinds, names = b.column("block").to_numpy(), b.column("kind").to_numpy(), b.column("tree")
            codes = names.dictionary_encode().indices.fill_null(-1).to_numpy()  # candidates are of no tree
            new = (np.diff(places) != 0) | (np.diff(codes) != 0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(places)]
            for at, end in zip(cuts, cuts[1:]):
                part = b.slice(at, end - at)
                if own != places[at]:
                    yield from flush()
                    own, candidates, block, name = places[at], [], None, None
                if not kinds[at]:
                    candidates.append(part.select(["vec_id", "label", "v"]))
                    continue
                if candidates:
                    block, candidates = _block(pa.Table.from_batches(candidates)), []
                if names[at].as_py() != name:
                    yield from flush()
                    name = names[at].as_py()
                tree.append(part)
        yield from flush()

    return arrow_map(dealt, run, schema)


def _block(t: pa.Table) -> Block:
    ids = t.column("vec_id").to_numpy()
    order = np.argsort(ids)
    v = t.column("v").to_pylist()
    return Block(ids[order], t.column("label").to_numpy()[order], _vectors([v[k] for k in order.tolist()]))


def _walked(block: Block, tree: pa.Table, tally: Tally | None = None) -> Iterator[tuple[int, int, Bounded]]:
    x = _vectors(tree.column("v").to_pylist(), 0)
    width = block.kinds[np.int64].shape[1]
    if x.shape[1] < width:
        x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    elif x.shape[1] > width:  # what a shorter row lacks adds nothing to a score, but it does to a distance
        block = Block(block.vec_id, block.label, np.pad(block.kinds[np.int64], ((0, 0), (0, x.shape[1] - width))))
    parent, length = tree.column("parent").to_numpy(), tree.column("length").to_numpy()
    for k, now in enumerate(walk(block, x, parent, length, tally)):
        yield k, tree.column("label")[k].as_py(), now


def _positives(block: Block, tree: pa.Table, k: int) -> pa.Table:
    anchor, found, score = [], [], []
    ids = tree.column("vec_id").to_pylist()
    for n, label, now in _walked(block, tree):
        (rows,) = now.best((now.block.label == label) & (now.block.vec_id != ids[n]), [(-np.inf, np.inf)], k)
        anchor += [ids[n]] * len(rows)
        found += now.block.vec_id[rows].tolist()
        score += now.low[rows].astype(np.int64).tolist()
    return pa.table({"anchor_id": pa.array(anchor, pa.int64()), "positive_id": pa.array(found, pa.int64()),
                     "positive_score": pa.array(score, pa.int64())})


def _negatives(block: Block, tree: pa.Table, k: int, lowest: int, highest: int) -> pa.Table:
    anchor, positive, own, found, score = [], [], [], [], []
    ids, positives = tree.column("vec_id").to_pylist(), tree.column("positives").to_pylist()
    for n, label, now in _walked(block, tree):
        asked = [p for p in positives[n] or [] if p["positive_score"] >= 0]
        # lowest * positive <= 100 * negative <= highest * positive, in whole numbers
        windows = [(float(-(-lowest * p["positive_score"] // 100)), float(highest * p["positive_score"] // 100)) for p in asked]
        for p, rows in zip(asked, now.best(now.block.label != label, windows, k)):
            anchor += [ids[n]] * len(rows)
            positive += [p["positive_id"]] * len(rows)
            own += [p["positive_score"]] * len(rows)
            found += now.block.vec_id[rows].tolist()
            score += now.low[rows].astype(np.int64).tolist()
    return pa.table({n: pa.array(v, pa.int64()) for n, v in (
        ("anchor_id", anchor), ("positive_id", positive), ("positive_score", own), ("negative_id", found),
        ("negative_score", score))})


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, lowest: int = 30,
         highest: int = 90, tree_size: int = TREE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows (vec_id, label, v; see
    ``quantised``), of which those where ``is_anchor`` holds are anchors.  A negative's score lies between ``lowest`` and
    ``highest`` per cent of its positive's.  Runs jobs: rows, trees and positives are written to the shared folder."""
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("m")).select("vec_id", "m.label", "m.v")
    rows = stored(one, "vectors")
    trees = stored(anchor_trees(rows.filter(is_anchor), tree_size), "trees")
    found = _by_block(rows, trees, lambda b, t: _positives(b, t, n_positives), "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = stored(found.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= n_positives).drop("k"), "positives")
    asked = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    armed = trees.join(asked.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left")
    near = _by_block(rows, armed, lambda b, t: _negatives(b, t, n_negatives, lowest, highest),
                     "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def relabelled(rows: DataFrame, every: int, n_labels: int) -> DataFrame:
    """Rows whose vec_id is divisible by ``every`` get the next label, as in noisy data."""
    return rows.withColumn("label", F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % n_labels).otherwise(F.col("label")))
