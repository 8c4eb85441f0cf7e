"""Hard negatives (13) against all pairs."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from pyspark.sql import functions as F
from revlens.llm import hard_negatives as hn
from tests.llm import brute


def all_pairs(rows, every=100, n_positives=5, n_negatives=10):
    """rows: (vec_id, embedding, label); the contract by comparing everything with everything."""
    kept = {}
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        v = np.floor(256 * np.array(x, np.float64)).astype(np.int64)
        new = (label, v.astype("<i4").tobytes(), v)
        if vec_id not in kept or new[:2] < kept[vec_id][:2]:
            kept[vec_id] = new
    out = set()

    def product(a, b):
        n = min(len(a), len(b))
        return int(a[:n] @ b[:n])

    for anchor, (label, _, a) in kept.items():
        if anchor % every:
            continue
        scores = sorted((-product(a, v), k, own) for k, (own, _, v) in kept.items() if k != anchor)
        for s, positive, _ in [x for x in scores if x[2] == label][:n_positives]:
            fits = [x for x in scores if x[2] != label and -30 * s <= -100 * x[0] <= -90 * s][:n_negatives]
            out |= {(anchor, positive, r, k, -s, -t) for r, (t, k, _) in enumerate(fits, 1)}
    return out


def mined(df, every=100, **more):
    return [tuple(r) for r in hn.mine(hn.relabelled(hn.quantised(df), 7, 10), F.col("vec_id") % every == 0, **more).collect()]


def test_query_matches_all_pairs(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        got = [tuple(r) for r in entry.queries()["op13_hard_negatives"](spark, sf).collect()]
        want = all_pairs([(r["vec_id"], r["embedding"], r["label"]) for r in brute.rows("embeddings", sf)])
        assert len(got) == len(want) and set(got) == want


SCHEMA = "vec_id long, embedding array<float>, label int, rank int, positive_id string"


def test_odd_rows(spark):
    r = np.random.default_rng(3)
    data = [(k, r.normal(0, 0.3, 6).tolist(), int(r.integers(0, 4)), 1, "z") for k in range(300)]
    same = r.normal(0, 0.3, 6).tolist()
    data += [(k, same, k % 3, 1, "z") for k in range(300, 700)]  # a large group of copies, with anchors among them
    data += [(None, same, 1, 1, "z"), (800, None, 1, 1, "z"), (801, same, None, 1, "z"), (802, [0.1, None, 0.2], 1, 1, "z"),
             (803, [0.1, float("nan")], 1, 1, "z"), (804, [float("inf")], 1, 1, "z"), (900, [], 1, 1, "z"), (901, [0.5], 1, 1, None),
             (902, [0.1] * 9, 2, 1, "z"), (1000, [0.5, 0.1], 2, None, "z"), (-100, same, -5, 1, "z"), (-7, same, -5, 1, "z"),
             (10, same, 3, 1, "z"), (10, same, 3, 1, "z"), (10, [1.0] * 6, 2, 1, "z"), (1100, [300.0] * 6, 1, 1, "z"),
             (1101, [250.0] * 6, 1, 1, "z"), (1102, [200.0] * 6, 2, 1, "z")]
    df = spark.createDataFrame(data, SCHEMA)
    for every in (100, 10):
        got = mined(df, every, tree_size=7)
        want = all_pairs([x[:3] for x in data], every)
        assert len(got) == len(want) and set(got) == want
    assert mined(df.limit(0)) == [] and mined(df.filter("vec_id = 901")) == []


def test_one_vec_id_with_most_rows(spark):
    data = [(k, [0.1 * (k % 7), 0.3, -0.01 * k], k % 2) for k in range(50)] + [(100, [0.01 * k, 0.2, 0.1], 1) for k in range(400)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    assert set(mined(df)) == all_pairs(data)


def test_sums_beyond_64_bits_do_not_wrap_around():
    x = np.array([[2_000_000_000] * 4, [-2_000_000_000] * 4, [2_000_000_000, 1, 0, 0]])
    block = hn.Block(np.arange(3), np.zeros(3, np.int64), x)
    assert block.scores(x[0], 4e9).tolist() == [1.6e19, -1.6e19, 4_000_000_002_000_000_000.0]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 60), st.integers(1, 5), st.integers(0, 10_000), st.sampled_from([1, 30, 3_000, 2_000_000_000]))
def test_bounds_hold_and_best_rows_are_exact(n, dims, seed, size):
    r = np.random.default_rng(seed)
    x = np.repeat(r.integers(-size, size + 1, (n, dims)), 2, axis=0)
    order, parent, length = hn.spanning_tree(x)
    assert sorted(order.tolist()) == list(range(len(x))) and (parent < np.arange(len(x))).all() and parent[0] == -1
    y = r.integers(-size, size + 1, (90, dims))
    block = hn.Block(np.arange(90), np.zeros(90, np.int64), y)
    k, windows = 4, [(-math.inf, math.inf), (0.0, float(size) * size)]
    for at, now in enumerate(hn.walk(block, x[order], parent, length)):
        exact = [sum(int(a) * int(b) for a, b in zip(x[order[at]], v)) for v in y]
        if size < 2_000_000_000:
            assert all(lo <= s <= hi for lo, s, hi in zip(now.low, exact, now.high))
        else:  # bounds of numbers beyond 53 bits hold but for their own rounding
            assert all(lo <= s * (1 + np.sign(s) * 1e-9) + 1 and s <= hi + abs(hi) * 1e-9 + 1 for lo, s, hi in zip(now.low, exact, now.high))
            continue
        for w, rows in zip(windows, now.best(np.ones(90, bool), windows, k)):
            assert rows.tolist() == [i for _, i in sorted((-s, i) for i, s in enumerate(exact) if w[0] <= s <= w[1])[:k]]


def test_few_scores_where_anchors_lie_close():
    r = np.random.default_rng(1)
    centre = r.normal(0, 60, (1, 32))
    anchors = np.rint(centre + r.normal(0, 1, (200, 32))).astype(np.int64)
    rows = np.rint(r.normal(0, 60, (20_000, 32))).astype(np.int64)
    order, parent, length = hn.spanning_tree(anchors)
    tally = hn.Tally()
    block = hn.Block(np.arange(len(rows)), np.zeros(len(rows), np.int64), rows)
    for now in hn.walk(block, anchors[order], parent, length, tally):
        now.best(np.ones(len(rows), bool), [(-np.inf, np.inf)], 5)
    assert tally.pairs == 200 * 20_000 and tally.scored < 0.2 * tally.pairs
