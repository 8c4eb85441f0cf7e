"""Ranked lexical search (11) against scores of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from revlens.llm import ball_tree as bt
from tests.llm import brute

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, top=50):
    """docs: (doc_id, text), items: (item_id, text)."""
    own = [(k, Counter(terms(t))) for k, t in docs]
    own = [(k, c, sum(c.values())) for k, c in own if c]
    n_docs, total = len(own), sum(n for *_, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    asked = {}
    for k, t in items:
        if k is not None:
            asked.setdefault(k, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for k, c, n in own:
            m = 100 - 50 + (50 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in wanted if t in c)
            if s > 0:
                scores.append((-s, k is None, k if k is not None else 0))
        out += [(item, r, None if none else k, -s) for r, (s, none, k) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_all_scores(spark, sf):
    got = found(entry.queries()["op11_ball_tree_search"](spark, sf))
    assert got == ranked([(r["doc_id"], r["text"]) for r in brute.rows("documents", sf)],
                         [(r["item_id"], r["text"]) for r in brute.rows("benchmark", sf)])


def odd_docs():
    r = np.random.default_rng(5)
    words = [f"w{k}" for k in range(60)] + ["Über", "日本", "ß9", "AB", "ab"]
    docs = [(k, " ".join(r.choice(words, int(r.integers(1, 40))))) for k in range(400)]
    docs += [(k, "w1 w2, w3. w3 same text") for k in range(1000, 1400)]  # a large group of copies
    return docs + [(None, "w1 w2 w3"), (None, None), (2000, None), (2001, ""), (2002, ".,;"), (5, "w1"), (5, "w1"), (2003, "w7 " * 200_000),
                   (2004, " ".join(f"v{k}" for k in range(50_000))), (-3, "AB ab Ab")]


ITEMS = [(1, "w1 w2 w3"), (2, "ab, über"), (3, None), (4, ""), (5, "nothing here known?"), (None, "w1"), (6, "w4 w4"), (6, "w5"), (7, "日本 ß9"),
         (8, " ".join(f"w{k}" for k in range(60))), (9, "same text"), (10, "v7 v8 v9")]


def test_odd_rows(spark):
    docs = odd_docs()
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id long, text string, rank int, item string")
    items = spark.createDataFrame([(k, t, 2) for k, t in ITEMS], "item_id int, text string, score int")
    want = ranked(docs, ITEMS)
    assert found(bt.search(df.repartition(3), items)) == want
    assert found(bt.search(df, items, pass_terms=20)) == want  # several passes
    assert found(bt.search(df, items, top=3)) == ranked(docs, ITEMS, 3)
    assert found(bt.search(df.limit(0), items)) == [] and found(bt.search(df, items.limit(0))) == []


def test_ids_of_other_types(spark):
    docs = [(f"d{k}", t) for k, t in odd_docs() if k is not None and k != 5]
    items = [(f"i{k}", t) for k, t in ITEMS if k is not None]
    got = bt.search(spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame(items, "item_id string, text string"))
    n = {d: k for k, (d, _) in enumerate(sorted(docs))}
    want = ranked([(n[d], t) for d, t in docs], items)
    assert sorted(((i, r, n[d], s) for i, r, d, s in found(got)), key=repr) == want


@st.composite
def sparse(draw, n_terms=12):
    rows = draw(st.lists(st.dictionaries(st.integers(0, n_terms - 1), st.integers(1, 1_000_000), max_size=6), min_size=1, max_size=40))
    return bt.Sparse(np.array([len(r) for r in rows], np.int64), np.array([c for r in rows for c in sorted(r)], np.int64),
                     np.array([r[c] for r in rows for c in sorted(r)], np.int64))


@settings(max_examples=200, deadline=None)
@given(sparse(), sparse(), st.integers(1, 5), st.integers(1, 6))
def test_bounds_hold_and_the_best_are_found(rows, items, leaf, top):
    column = np.arange(12)
    exact = items.dense(column) @ rows.dense(column).T
    tree = bt.Tree.unpacked(bt.Tree.grown(rows, leaf).packed())
    search = bt.Search(items, 12, np.zeros(len(items.size), np.int64), top)
    for k in range(len(tree.begin)):
        members = tree.order[tree.begin[k]:tree.end[k]]
        assert (exact[:, members].max(axis=1, initial=0) <= search.bounds(tree, k)).all()
        assert tree.child[k] >= 0 or len(members) <= leaf or (exact[:, members] == exact[:, members[:1]]).all()
    search.visit(tree, list(range(len(rows.size))))
    search.settle()
    for q in range(len(items.size)):
        want = sorted((-int(s), k) for k, s in enumerate(exact[q]) if s > 0)[:top]
        assert [(-s, k) for i, s, k in search.best if i == q] == want


def test_subtrees_are_pruned():
    r = np.random.default_rng(2)
    topics = [np.arange(k * 20, k * 20 + 20) for k in range(50)]
    rows = [np.sort(r.choice(topics[k % 50], 12, replace=False)) for k in range(4_000)]
    size = np.full(4_000, 12)
    data = bt.Sparse(size, np.concatenate(rows), r.integers(300_000, 500_000, 48_000))
    items = bt.Sparse(np.full(20, 12), np.concatenate([rows[k] for k in range(20)]), np.full(240, 5_000))
    search = bt.Search(items, 1_000, np.zeros(20, np.int64), 10)
    search.visit(bt.Tree.grown(data), list(range(4_000)))
    assert search.scored < 0.3 * 20 * 4_000
