"""Jaccard join (4), decontamination (5), quality (6), pipeline."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from revlens.llm import decontam, neardup, quality
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def links_of(texts):
    """{(a, b)} of different gram sets with a similarity of 0.8 or more, by brute force over an inverted index."""
    sets = {}
    for d, t in texts.items():
        if g := brute.gram_set(t):
            sets[g] = min(d, sets.get(g, d))
    index, common = {}, {}
    for g, d in sets.items():
        for x in g:
            for other in index.setdefault(x, []):
                common[other, d] = common.get((other, d), 0) + 1
            index[x].append(d)
    size = {d: len(g) for g, d in sets.items()}
    return {(min(p), max(p)) for p, c in common.items() if c >= 0.8 * (size[p[0]] + size[p[1]] - c)}, sets


def classes_of(texts):
    links, sets = links_of(texts)
    parent = {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    out = {}
    for d, t in texts.items():
        g = brute.gram_set(t)
        out[d] = find(sets[g]) if g else d
    return out, links


def n_links_of(got):
    return {r.rep_id: r.n_links for r in got if r.n_links}


@pytest.mark.parametrize("sf", [brute.SF, SF])
def test_classes_match_brute_force(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in brute.rows("documents", sf)}
    want, links = classes_of(texts)
    got = entry.queries()["op4_ngram_jaccard_join"](spark, sf).collect()
    assert {r.doc_id: r.class_id for r in got} == want and len(got) == len(texts)
    assert n_links_of(got) == Counter(d for p in links for d in p)


def test_crowd_of_edited_copies(spark, monkeypatch):
    """One text, many edited copies of it: everyone that is similar to it is in its class, candidates grow with
    the texts, not with their pairs, and every link is counted, over several blocks too."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(200)]
    texts = {0: " ".join(words)}
    for d in range(1, 400):
        own = list(words)
        for _ in range(rng.randrange(1, 9)):
            own[rng.randrange(200)] = f"x{rng.randrange(10 ** 6)}"
        texts[d] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    want, links = classes_of(texts)
    assert all(got[a].class_id == got[b].class_id for a, b in links)
    assert n_links_of(got.values()) == Counter(d for p in links for d in p)
    monkeypatch.setattr(neardup, "BLOCK_TEXTS", 64)
    assert n_links_of(neardup.near_duplicates(docs).collect()) == n_links_of(got.values())
    reps = neardup.signatures(docs).select(F.col("doc_id").alias("rep"), "sig")
    assert neardup.candidates(neardup.forest(reps).cache(), 6).count() <= len(texts)


def test_pairs_within_a_template_crowd(spark, monkeypatch):
    """A crowd on one template, 0.75 alike pairwise, that holds pairs of 0.81: no pair is lost between the others."""
    template = [f"t{k}" for k in range(244)]
    texts = {d: " ".join(template + [f"p{d // 2}s{k}" for k in range(10)] + [f"o{d}n{k}" for k in range(30)]) for d in range(500)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    want, links = classes_of(texts)
    assert len(links) == 250
    for block, few in ((512, 8), (100, 8), (512, 1000)):  # in one block, in several, as pairs
        monkeypatch.setattr(neardup, "COMPARED_TEXTS", block)
        monkeypatch.setattr(neardup, "FEW", few)
        got = neardup.near_duplicates(docs).collect()
        assert {r.doc_id: r.class_id for r in got} == want
        assert n_links_of(got) == Counter(d for p in links for d in p)


def test_depth_is_shortened_while_links_are_lost(spark, monkeypatch):
    """A first round that proposes nothing is measured as such, and a second one at a smaller depth finds the links."""
    texts = {}
    for d in range(20):
        words = [f"d{d}n{k}" for k in range(100)]
        texts |= {2 * d: " ".join(words), 2 * d + 1: " ".join(words[:-6])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    depths, propose, compare = [], neardup.candidates, neardup.suspects

    def first_is_empty(members, depth):
        depths.append(depth)
        return propose(members, depth).limit(0 if len(depths) == 1 else 10 ** 6)

    monkeypatch.setattr(neardup, "candidates", first_is_empty)
    monkeypatch.setattr(neardup, "suspects", lambda *x: compare(*x).limit(0 if len(depths) == 1 else 10 ** 6))
    got = neardup.near_duplicates(docs).collect()
    want, links = classes_of(texts)
    assert len(links) == 20 and depths == [6, 5]
    assert {r.doc_id: r.class_id for r in got} == want


def test_links_of_the_sample_are_kept(spark, monkeypatch):
    """Where no depth proposes a link, the sample's comparison with every text still gives it, with its count."""
    words = [f"n{k}" for k in range(100)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:-6])), (3, " ".join(words[6:])), (4, "else")],
                                 "doc_id long, text string")
    propose, compare = neardup.candidates, neardup.suspects
    monkeypatch.setattr(neardup, "candidates", lambda members, depth: propose(members, depth).limit(0))
    monkeypatch.setattr(neardup, "suspects", lambda *x: compare(*x).limit(0))
    with pytest.warns(UserWarning, match="recall 0"):
        assert neardup.ngram_join(docs).recall == 0
    assert sorted(tuple(r) for r in neardup.near_duplicates(docs).collect()) == [(1, 1, 1, 2), (2, 2, 1, 2), (3, 3, 1, 2), (4, 4, 4, 0)]


def test_two_texts_apart_by_a_range_border_are_candidates(spark):
    members = spark.createDataFrame([(5 << 20, 7), (5 << 20, 3)], "path long, rep long")
    assert [tuple(r) for r in neardup.candidates(members, 6).collect()] == [(3, 7)]


def test_joining_links():
    linked = np.array([[1, 1, 0], [0, 1, 0], [0, 0, 1]], bool)
    assert neardup.joining(linked, np.array([1, 2, 3]), np.array([1, 5, 3])) == [(0, 1), (1, 1)]


def test_shared_grams_over_several_matrices(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (1, 5, 20, 40, 40)]
    first, second = np.array([0, 2]), np.array([1, 3, 4])
    want = [[len(np.intersect1d(sets[a], sets[b])) for b in second] for a in first]
    assert neardup.shared_grams(sets, first, second).tolist() == want
    apart = [np.array([k], np.uint64) for k in range(3)]
    assert not neardup.shared_grams(apart, np.array([0]), np.array([1, 2])).any()


def test_joins_on_odd_rows(spark):
    data = [(1, "a b c d e f g", 5), (2, "A b, c d e f g", 5), (2, "A b, c d e f g", 5), (3, None, 5), (4, "", 5), (5, "a b", 5),
            (6, "A B!", 5), (None, "a b", 5), (None, None, 5), (7, "a b c d e f g " + "z " * 50_000, 5), (8, "q " * 30_000, 5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, class_id int")
    got = [tuple(r) for r in neardup.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 1, 0), (2, 1, 1, 0), (2, 1, 1, 0), (3, 3, 3, 0), (4, 4, 4, 0), (5, 5, 5, 0), (6, 5, 5, 0),
                                           (None, 5, 5, 0), (None, None, None, 0), (7, 7, 7, 0), (8, 8, 8, 0)], key=str)
    kept = neardup.one_of_each(docs.union(docs))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted("1 3 4 5 7 8 None None None None".split())
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_alignment_equals_smith_waterman():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 15)), rng.integers(0, 5, rng.integers(0, 25))
        score, first, end = decontam.align(a, b)
        assert score == brute.smith_waterman(a.tolist(), b.tolist())
        if score:  # the span alone gives the same score
            assert brute.smith_waterman(a.tolist(), b[first:end].tolist()) == score


def test_contamination_matches_brute_force(spark):
    items = {r["item_id"]: decontam.words_of(r["text"]) for r in brute.rows("benchmark")}
    want = {}
    for r in brute.rows("documents"):
        words = decontam.words_of(r["text"])
        known = set(words)
        for i, item in items.items():
            if 2 * sum(w in known for w in item) < 1.2 * len(item):
                continue  # too few words in common for the score
            score = brute.smith_waterman(item, words) / (2 * len(item))
            if score >= decontam.MIN_SCORE:
                want[r["doc_id"], i] = score
    got = entry.queries()["op5_decontamination"](spark, brute.SF).collect()
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}


def test_contamination_of_edited_and_common_passages(spark):
    rng = random.Random(9)
    item = [f"v{k}" for k in range(40)]
    edited = list(item)
    for k in (3, 11, 19, 27, 35):
        edited[k] = "zz"
    del edited[30]
    other = [f"u{rng.randrange(300)}" for _ in range(120)]
    data = [(k, " ".join(other[:50] + item + other[50:]), 1) for k in range(50)]  # a passage that many documents share
    data += [(100, " ".join(other + edited).upper(), 1), (101, " ".join(other), 1), (102, None, 1), (103, "", 1),
             (104, " ".join(item[:12] + other), 1), (105, "foo bar", 1), (106, "bar foo", 1), (100, " ".join(other + edited), 1),
             (None, " ".join(item), 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, scores int")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "Foo Bar"), (4, "")], "item_id long, text string")
    got = decontam.contamination(docs, bench, chunk_chars=200).collect()
    assert sorted({(r.doc_id, r.item_id) for r in got}, key=str) == sorted([*((k, 1) for k in range(50)), (100, 1), (105, 3), (None, 1)], key=str)
    r = next(r for r in got if r.doc_id == 0)
    assert (r.first_word, r.end_word, r.score) == (50, 90, 1.0)
    clean = decontam.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [101, 102, 103, 104, 106]
    assert decontam.contamination(docs, bench.limit(0)).count() == 0
    assert decontam.contamination(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("every", [4, 5])
def test_contamination_of_evenly_edited_copies(spark, every):
    """Copies with every 4th or 5th word replaced, in all phases, beside exact copies: each one that scores enough is found."""
    bench, data, want = [], [], {}
    for m in (13, 37, 40):
        for phase in range(every):
            i = 100 * m + phase  # an item for each phase: no other copy keeps the words that this one changes
            item = [f"i{i}w{k}" for k in range(m)]
            copy = [f"z{i}n{k}" if k % every == phase else w for k, w in enumerate(item)]
            bench.append((i, " ".join(item)))
            data += [(i, " ".join(["before", "it", *copy, "and", "after"])), (100_000 + i, " ".join(item))]
            want[100_000 + i, i] = 1.0
            if (score := brute.smith_waterman(item, copy) / (2 * m)) >= decontam.MIN_SCORE:
                want[i, i] = score
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = decontam.contamination(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert len(want) > len(bench) and {(r.doc_id, r.item_id): r.score for r in found} == pytest.approx(want)


@pytest.mark.parametrize("after", [2, 3, 5])
def test_contamination_of_copies_with_inserted_words(spark, after):
    """A word inserted after every second one leaves no three words in a row, and scores 0.75."""
    bench, data, want = [], [], {}
    for m in (8, 11, 25, 40):
        item = [f"i{m}w{k}" for k in range(m)]
        copy = [x for k, w in enumerate(item) for x in ([w, f"z{k}"] if k % after == after - 1 else [w])]
        bench.append((m, " ".join(item)))
        data.append((m, " ".join(["before", *copy, "after"])))
        want[m, m] = brute.smith_waterman(item, copy) / (2 * m)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = decontam.contamination(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert min(want.values()) >= 0.6 and {(r.doc_id, r.item_id): r.score for r in found} == pytest.approx(want)


def test_contamination_finds_every_copy_that_scores_enough():
    """Random edits up to the least score, for items that share their openings with many others."""
    rng = random.Random(4)
    opening = "which of the following is not".split()
    texts = [" ".join(opening + [f"i{i}w{k}" for k in range(rng.randrange(1, 40))]) for i in range(150)]
    texts += [" ".join(rng.choice("abcdef") + str(rng.randrange(4)) for _ in range(rng.randrange(4, 30))) for _ in range(60)]
    items = decontam.Items(list(enumerate(texts)))
    scanner = decontam.Scanner(items, *decontam.seeds_of(items, decontam.MIN_SCORE), decontam.MIN_SCORE)
    tried = 0
    for _ in range(1_500):
        k = rng.randrange(len(texts))
        item, copy = texts[k].split(), []
        rate = rng.choice([0.05, 0.15, 0.25, 0.35])
        for w in item:
            what = rng.random()
            if what < rate:
                copy += rng.choice([["zz"], [], [w, "zz"], ["yy", w, "zz"], [w, "yy", "zz"]])
            else:
                copy.append(w)
        score = brute.smith_waterman(item, copy) / (2 * len(item))
        if score >= decontam.MIN_SCORE:
            tried += 1
            found = {i: s for i, s, *_ in scanner.matches(" ".join(["some", "text", *copy, "more", "text"]))}
            assert found.get(k, 0) >= score - 1e-9, (item, copy)
    assert tried > 500


def test_contamination_time_with_a_shared_opening():
    import time
    took = []
    for n in (500, 5_000):
        items = decontam.Items([(i, "which of the following is " + " ".join(f"i{i}w{k}" for k in range(30))) for i in range(n)])
        scanner = decontam.Scanner(items, *decontam.seeds_of(items, decontam.MIN_SCORE), decontam.MIN_SCORE)
        text = " ".join(f"t{k}" for k in range(200)) + " which of the following is " + " ".join(f"u{k}" for k in range(200))
        scanner.matches(text)
        began = time.process_time()
        for _ in range(50):
            assert scanner.matches(text) == []
        took.append(time.process_time() - began)
    assert took[1] < 3 * took[0] + 0.1


def test_contamination_with_string_ids_and_repeated_items(spark):
    docs = spark.createDataFrame([("d", "x alpha beta gamma delta y"), ("e", "q " * 100_000)], "doc_id string, text string")
    bench = spark.createDataFrame([("i", "alpha beta gamma delta")] * 3 + [("j", "Alpha, beta gamma delta"), ("k", None)], "item_id string, text string")
    got = decontam.contamination(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [("d", "i")] * 3 + [("d", "j")]


def test_quality_finds_toxic_and_bad_documents(spark):
    got = {r.doc_id: r for r in entry.queries()["op6_quality_bayes"](spark, SF).collect()}
    labels = brute.rows("labels", SF)
    assert len(got) == len(brute.rows("documents", SF))
    for col, found in (("quality", lambda r: r.score >= 0.5), ("toxic", lambda r: r.toxic_score >= 0.5)):
        own = [x for x in labels if x[col] is not None]
        assert sum(found(got[x["doc_id"]]) == bool(x[col]) for x in own) >= 0.9 * len(own)


def test_quality_shrinks_sparse_sites(spark):
    rows = [(f"h{h}", f"h{h}/p{p}", 2.0 if h == 0 else -2.0, 0.0) for h in range(6) for p in range(3) for _ in range(40)]
    rows += [("new", "new/p", 2.0, 0.0)]
    found = spark.createDataFrame(rows, "host string, path string, llr_quality double, llr_toxic double")
    sites = {(r.host, r.path): r for r in quality.site_posteriors(found, {"quality": 0.5, "toxic": 0.1}).collect()}
    assert sites["h0", "h0/p1"].prior_quality > 0.7 > 0.3 > sites["h1", "h1/p0"].prior_quality
    one = 1 / (1 + np.exp(-2.0))
    assert sites["h1", "h1/p0"].prior_quality < sites["new", "new/p"].prior_quality < one - 0.1  # drawn towards the global rate


def _plain_judgement(docs, models, rates):
    """{doc_id: (score, toxic_score)} from the fitted classifiers, document by document and site by site."""
    def p(x):
        return 1 / (1 + np.exp(-x))

    def strength(groups, rate):  # groups: (n, expected positives, rate around which they spread)
        if len(groups) < 2:
            return 100.0
        noise = rate * (1 - rate)
        spread = (sum(n * (k / n - c) ** 2 for n, k, c in groups) - len(groups) * noise) / sum(n for n, _, _ in groups)
        return min(1e4, max(2.0, noise / spread - 1)) if spread > 0 else 1e4

    llr, out = {}, {}
    for d in docs:
        words = quality.WORD.findall((d["text"] or "").lower())
        has = set(words) | {w[:n] + "*" for w in words for n in (3, 5) if len(w) > n}
        own = np.array(quality.style(d["text"] or "", words))
        llr[d["doc_id"]] = [0.0 if m is None else float(np.clip(
            sum(v for w, v in m.words.items() if w in has) + ((own - m.mean) / m.scale) @ m.styles + m.bias, -30, 30)) for m in models.values()]
    for t, target in enumerate(models):
        base = np.log(rates[target] / (1 - rates[target]))
        paths, hosts = {}, {}
        for d in docs:
            host, path = d["source"] or "", "/".join(x for x in (d["source"], d["lang"]) if x is not None)
            for key, group in (((host, path), paths), (host, hosts)):
                n, k = group.get(key, (0, 0.0))
                group[key] = (n + 1, k + p(llr[d["doc_id"]][t] + base))
        total = sum(n for n, _ in hosts.values())
        rate = min(0.999, max(0.001, sum(k for _, k in hosts.values()) / total))
        weight = strength([(n, k, rate) for n, k in hosts.values()], rate)
        around = {h: (k + weight * rate) / (n + weight) for h, (n, k) in hosts.items()}
        own = strength([(n, k, around[h]) for (h, _), (n, k) in paths.items()], rate)
        for d in docs:
            host, path = d["source"] or "", "/".join(x for x in (d["source"], d["lang"]) if x is not None)
            n, k = paths[host, path]
            prior = (k + own * around[host]) / (n + own)
            out.setdefault(d["doc_id"], []).append(p(llr[d["doc_id"]][t] + np.log(prior / (1 - prior))))
    return out


def test_quality_query_matches_plain_judgement(spark):
    docs, labels = brute.rows("documents"), brute.rows("labels")
    models = quality.fit(spark.read.parquet(f"{brute.SF}/documents.parquet"), spark.read.parquet(f"{brute.SF}/labels.parquet"))
    rates = {}
    for t in quality.TARGETS:
        own = [r[t] for r in labels if r[t] in (0, 1)]
        rates[t] = min(0.99, max(0.01, sum(own) / len(own)))
    want = _plain_judgement(docs, models, rates)
    got = entry.queries()["op6_quality_bayes"](spark, brute.SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert [r.score, r.toxic_score] == pytest.approx(want[r.doc_id], abs=1e-6)
        assert r.kept == (r.score >= 0.5 and r.toxic_score < quality.MAX_TOXIC)


def test_quality_counts_an_id_once(spark, monkeypatch):
    """Thousands of rows with two labelled ids: the sample has two rows."""
    docs = spark.range(2_000).select((F.col("id") % 2).alias("doc_id"), F.concat(F.lit("some words "), F.col("id") % 7).alias("text"))
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 0), (1, 0, 1), (1, 1, 1)], "doc_id long, quality int, toxic int")
    sizes, keep = [], quality.stored
    monkeypatch.setattr(quality, "stored", lambda df, label: sizes.append((label, (out := keep(df, label)).count())) or out)
    quality.fit(docs, labels)
    assert sizes == [("labelled", 2)]


def test_quality_finds_toxic_documents_that_it_was_not_fitted_on(spark):
    sf = "/root/testdata/sf0.1"  # a smaller table shows too few toxic documents
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("path", F.col("lang"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    got = quality.judge(docs, labels.filter(~part)).join(labels.filter(part), "doc_id").collect()
    toxic, clean = ([r for r in got if r.toxic == x] for x in (1, 0))
    assert sum(r.toxic_score < quality.MAX_TOXIC for r in clean) >= 0.99 * len(clean)
    assert sum(r.toxic_score >= quality.MAX_TOXIC for r in toxic) >= 0.85 * len(toxic)


def test_quality_odd(spark):
    data = [(1, None, None, None, 1), (2, "", "s", None, 1), (2, "", "s", None, 1), (None, "a b", None, "p", 1), (3, "x" * 50_000, "s", "p", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, path string, kept int")
    labels = spark.createDataFrame([(1, 1, None), (2, 0, None), (None, 1, 1), (9, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.judge(docs, labels).count() == 5
    assert quality.judge(docs, labels.limit(0)).count() == 5
    assert quality.judge(docs.limit(0), labels).count() == 0


def test_pipeline_stages(spark):
    """Each stage against plain versions on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        steps[name] = docs
        if name != "packing":
            assert docs.schema == spark.read.parquet(f"{SF}/documents.parquet").schema
    kept = {n: {r.doc_id: r.text for r in steps[n].collect()} for n in list(steps)[:-1]}
    assert all(not brute.rule_base(t)[5] for t in kept["quality_rules"].values())
    want, _ = classes_of(kept["quality_rules"])
    assert set(kept["near_duplicates"]) == {d for d, c in want.items() if d == c}
    leaks = {r.doc_id for r in decontam.contamination(steps["near_duplicates"], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert set(kept["decontamination"]) == set(kept["near_duplicates"]) - leaks
    for d, t in kept["personal_data"].items():
        spans = brute.pii_base(before[d])
        assert not brute.pii_base(t) and (t == before[d]) == (not spans or t == before[d])
    from tests.llm.test_files import check_packing
    from revlens.llm.tokens import WordTokenizer, public_path
    library = WordTokenizer(public_path("byte_bpe_50k.json")).library
    rows = steps["packing"].collect()
    check_packing(rows, {d: brute.ids(library, t)[0] for d, t in kept["personal_data"].items()})
    again = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in again} == {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows}


def test_pipeline_on_odd_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = " ".join(f"word{k}" for k in range(30))
    data = [(1, text, "en", "s", len(text)), (1, text, "en", "s", len(text)), (2, None, None, None, None), (3, "", "en", "s", 0),
            (None, text + " more", None, None, None), (4, text + " a@b.org and other words that stand here", "en", "s", 3)]
    docs = spark.createDataFrame(data, schema)
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            rows = corpus_pipeline.stored(stage(spark, rows, SF), name)
            if name == "near_duplicates":
                # the longer copies are similar to document 1, which stays once; the row without an id stays too
                assert sorted(str(r.doc_id) for r in rows.collect()) in (["1", "None"], ["1", "4", "None"], [])
