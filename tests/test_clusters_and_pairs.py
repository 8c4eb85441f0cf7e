"""Best two clusters of a column (N9) and collocations (N6) against plain Python."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from revlens.operators import ml
from revlens.operators import text as tx

VALUES = st.lists(st.sampled_from([None, -5.0, 0.0, 0.5, 1.0, 1.25, 3.0, 50.0, 1e6]), max_size=14)


def best_cut(values):
    """(cost, cut) by trying every cut."""
    v = sorted(x for x in values if x is not None)

    def cost(x):
        return sum((a - sum(x) / len(x)) ** 2 for a in x) if x else 0.0

    return min(((cost([x for x in v if x <= c]) + cost([x for x in v if x > c]), c) for c in sorted(set(v))[:-1]), default=None)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(VALUES, st.sampled_from([2, 5, 256]))
def test_two_means_is_the_best_cut(spark, values, n_ranges):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id int, x double")
    fit, want = ml.two_means(df, "x", n_ranges), best_cut(values)
    if want is None:
        assert fit.split is None and fit.sizes[1] == 0
    else:
        assert math.isclose(fit.cost, want[0], rel_tol=1e-6, abs_tol=1e-3)
        low = [v for v in values if v is not None and v <= fit.split]
        assert math.isclose(best_cut(values)[0], want[0]) and fit.sizes == (len(low), sum(v is not None for v in values) - len(low))
    rows = ml.two_means_anomaly(df, "x", n_ranges).collect()
    assert len(rows) == sum(v is not None for v in values)
    if fit.split is not None:
        flagged = {r.cluster for r in rows if r.is_anomaly}
        assert flagged == {fit.smallest} and all(r.cluster == (r.x > fit.split) for r in rows)


def test_sparks_fit_is_never_better(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "value")
    fit = ml.two_means(ev, "value")
    asm, model = ml.fit_kmeans(ev, ["value"], 2, 1)
    assert fit.cost <= model.summary.trainingCost * (1 + 1e-9)
    assert model.summary.trainingCost <= fit.cost * 1.05
    centres = sorted(float(c[0]) for c in model.clusterCenters())
    assert all(math.isclose(a, b, rel_tol=0.05) for a, b in zip(centres, fit.centres))


def test_many_distinct_values_in_ranges(spark):
    df = spark.range(5_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7.0 WHEN id < 4500 THEN id / 100.0 ELSE id * 1.0 END AS x")
    values = [r.x for r in df.collect()]
    assert math.isclose(ml.two_means(df, "x", 64).cost, sum((x - sum(g) / len(g)) ** 2 for g in (
        [v for v in values if v <= 100], [v for v in values if v > 100]) for x in g), rel_tol=1e-9)


STOP = ["the", "of"]


def plain(texts, min_score=30.0):
    """Counts of terms and the scored pairs, word by word."""
    import re
    words, pairs = Counter(), Counter()
    for t in texts:
        w = re.findall("[A-Za-z0-9_]+", (t or "").lower())
        words.update(x for x in w if x not in STOP)
        pairs.update((a, b) for a, b in zip(w, w[1:]) if a not in STOP and b not in STOP)

    def stem(w):
        return w[:-1] if w.endswith("s") and not w.endswith("ss") and len(w) > 1 else w

    def fold(counts, key):
        out = {}
        for w, n in counts.items():
            out.setdefault(key(w), []).append((w, n))
        return {k: (min((w for w, _ in v), key=len if not isinstance(v[0][0], tuple) else lambda p: len(p[1])), sum(n for _, n in v)) for k, v in out.items()}

    w, p = fold(words, stem), fold(pairs, lambda x: (x[0], stem(x[1])))
    total, found = sum(words.values()), {}
    for (a, b2), ((a_, b), k) in p.items():
        c1, c2 = w[stem(a)][1], w[b2][1]

        def likely(k, n, x):
            return math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (n - k)

        rate, r1, r2 = c2 / total, k / c1, (c2 - k) / (total - c1) if total > c1 else 0.0
        score = -2 * (likely(k, c1, rate) + likely(c2 - k, total - c1, rate) - likely(k, c1, r1) - likely(c2 - k, total - c1, r2))
        if score > min_score:
            found[a, b] = (k, score, stem(a), b2)
    left = {s: n for s, (_, n) in w.items()}
    for k, _, a, b in found.values():
        left[a] -= k
        left[b] -= k
    terms = {w[s][0]: n for s, n in left.items() if n > 0} | {f"{a} {b}": v[0] for (a, b), v in found.items()}
    return found, terms


TEXTS = ["New York is big. New York is new", "new york new yorks, York", None, "", "the of", "cats cat dogs", "glass glasses bus s ss",
         "credit card of credit cards"] + ["big data pipeline and big data model of big data"] * 12 + ["data card big model pipeline"] * 3


@pytest.mark.parametrize("min_score", [0.5, 10.0, 30.0])
def test_collocations_match_plain_python(spark, min_score):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    found, terms = plain(TEXTS, min_score)
    got = {(r.word1, r.word2): (r["count"], r.score) for r in tx.collocations(df, "text", STOP, min_score).collect()}
    assert got.keys() == found.keys() and ("big", "data") in got
    assert all(got[k][0] == found[k][0] and math.isclose(got[k][1], found[k][1], rel_tol=1e-9) for k in got)
    cloud = {r.term: r["count"] for r in tx.cloud_terms(df, "text", 1000, STOP, min_score).collect()}
    assert cloud == terms


def test_cloud_terms_without_words(spark):
    empty = spark.createDataFrame([(None,), ("",)], "text string")
    assert tx.cloud_terms(empty, "text").collect() == [] and tx.collocations(empty, "text").collect() == []


def test_heavy_words_are_the_most_frequent_ones(spark, monkeypatch):
    rows = [(" ".join(f"w{(k * j) % 997}" for j in range(1, 60)) + " alpha" * (k % 4) + " beta" * (k % 3),) for k in range(3_000)]
    df = spark.createDataFrame(rows, "text string").repartition(5)
    full = tx.word_freq
    want = [tuple(r) for r in full(df, "text", 5).collect()]
    asked = []
    monkeypatch.setattr(tx, "word_freq", lambda *a: asked.append(a) or full(*a))
    assert [tuple(r) for r in tx.heavy_words(df, "text", 2).collect()] == want[:2] and not asked
    assert [tuple(r) for r in tx.heavy_words(df, "text", 5, followed=512).collect()] == want and asked  # flat counts: all words are counted
    assert tx.heavy_words(spark.createDataFrame([(None,)], "text string"), "text").collect() == []
