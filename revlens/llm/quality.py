"""Quality by hierarchical empirical Bayes.

1. A document classifier (logistic regression over words, their beginnings and style measures) is fitted on a bounded
   sample of labelled rows for each target (good quality, toxic).  It gives evidence: the
   log-likelihood ratio of a document, free of the sample's base rate.
2. Grouped aggregation over all documents gives each site (host) and each path of it
   its number of documents and its expected positives.  A Beta prior is fitted by moments on
   the spread of the hosts around the global rate, and another on the spread of
   paths around their hosts; posteriors shrink sparse sites towards the global rate and sparse
   paths towards their host.
3. A document's probability is its evidence on top of its path's posterior rate.

Defined results: a null text is empty.  A null host or path counts as the site with the empty name.
Without labels of both classes a target has no evidence, and all documents get the prior (0.5
if nothing at all is known).  Repeated rows count as often as they occur.  Labels with a null
are left out for that target.  An empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, map_texts, stored

WORD = re.compile(r"[^\W_]+")
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Labelled rows that a classifier is fitted on, at most (chosen by a hash of doc_id), and its words.
SAMPLE_ROWS = 6_000
WORDS = 800
MIN_DOCS = 5
#: Letters of the beginnings that count beside whole words.
PREFIXES = (3, 5)
STYLES = 9
TARGETS = ("quality", "toxic")
#: A document is toxic from this probability on (a missed one costs about twice a clean one that is lost).
MAX_TOXIC = 0.35


def features(words: list[str]) -> set[str]:
    """The words, and the beginnings (marked with *) of longer ones, which stand for words that no label has shown."""
    own = set(words)
    return own | {w[:n] + "*" for w in own for n in PREFIXES if len(w) > n}


def style(text: str, words: list[str]) -> list[float]:
    """Style measures: shares in 0..1 but for the two lengths."""
    n = max(1, len(text))
    letters = NOT_LETTERS.sub("", text)
    lines = [x for x in text.split("\n") if x.strip()]
    upper = 0 if letters.islower() else len(letters) - len(re.sub(r"[A-ZÀ-ÖØ-Þ]+", "", letters))
    return [np.log1p(len(words)), sum(map(len, words)) / max(1, len(words)) / 10, upper / max(1, len(letters)),
            text.count("!") / n * 10, sum(map(text.count, "#*$%&|<>")) / n * 10, len(letters) / n,
            len(set(words)) / max(1, len(words)), len(set(lines)) / max(1, len(lines)),
            sum(map(text.count, "0123456789")) / n * 10]


@dataclass(frozen=True)
class Target:
    """One fitted classifier: weights by word, of the styles (after scaling), and the rest."""
    words: dict[str, float]
    mean: np.ndarray
    scale: np.ndarray
    styles: np.ndarray
    bias: float

    def evidence(self, found: set[str], styles: np.ndarray) -> float:
        return (sum(map(self.words.__getitem__, self.words.keys() & found))
                + float(((styles - self.mean) / self.scale) @ self.styles) + self.bias)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 300) -> np.ndarray:
    """Weights (the last is the bias) by accelerated gradient steps on the penalised likelihood."""
    n, m = x.shape
    xb = np.hstack([x, np.ones((n, 1))])  # all in float64: no copy in a step
    v = np.ones(m + 1)
    for _ in range(20):  # the largest curvature, by power iteration
        v = xb.T @ (xb @ v)
        v /= np.linalg.norm(v)
    step = 1 / (0.25 * float(np.linalg.norm(xb @ v) ** 2) + penalty)
    w = z = np.zeros(m + 1)
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(xb @ z, -30, 30)))
        grad = xb.T @ (p - y)
        grad[:-1] += penalty * z[:-1]
        new = z - step * grad
        z = new + k / (k + 3) * (new - w)
        w = new
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_cols: tuple[str, ...] = TARGETS, sample_rows: int = SAMPLE_ROWS) -> dict[str, Target | None]:
    """Fit on at most ``sample_rows`` labelled documents; None where labels lack one of the classes.

    The sample is the only thing of its kind that goes to the driver, as numbers of known words and style measures.  An id
    counts once: with the smallest labels and the smallest text of its rows.
    """
    ys = [f"_y{k}" for k in range(len(label_cols))]
    ids = (labels.select(F.col(id_col).alias("_id"), *[F.col(c).cast("int").alias(y) for y, c in zip(ys, label_cols)])
           .filter("_id IS NOT NULL").groupBy("_id").agg(F.min(F.struct(*ys)).alias("y")).select("_id", "y.*")
           .orderBy(F.xxhash64("_id"), "_id").limit(sample_rows))
    sample = stored(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
                    .join(F.broadcast(ids), "_id").groupBy("_id").agg(F.min("_text").alias("_text"), *[F.min(y).alias(y) for y in ys])
                    .drop("_id"), "labelled")  # one row for each id: bounded by sample_rows

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(features(WORD.findall((t or "").lower()))) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), *b.columns[1:]],
                                             ["words", *ys])

    words = sample.select("_text", *ys).transform(arrow_map, listed, "words array<string>, " + ", ".join(f"{y} int" for y in ys)) \
        .select(F.explode("words").alias("word"), *ys)
    models: dict[str, Target | None] = {}
    for name, y in zip(label_cols, ys):
        totals = sample.agg(F.sum((F.col(y) == 1).cast("int")).alias("p"), F.sum((F.col(y) == 0).cast("int")).alias("n")).first()
        pos, neg = totals["p"] or 0, totals["n"] or 0
        if not pos or not neg:
            models[name] = None
            continue
        p, n = (F.sum((F.col(y) == v).cast("int")) for v in (1, 0))
        per = words.groupBy("word").agg(p.alias("p"), n.alias("n")).filter(F.col("p") + F.col("n") >= MIN_DOCS)
        # how much a word tells: its log odds times the square root of its documents
        odds = F.log((F.col("p") + 0.5) / F.lit(pos + 1.0)) - F.log((F.col("n") + 0.5) / F.lit(neg + 1.0))
        known = [r["word"] for r in per.withColumn("tells", F.abs(odds) * F.sqrt(F.col("p") + F.col("n")))
                 .orderBy(F.desc("tells"), "word").limit(WORDS).collect()]
        place = {w: k for k, w in enumerate(known)}

        def featured(batches: Iterator[pa.RecordBatch], place=place) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for text in b.column(0).to_pylist():
                    own = WORD.findall((text or "").lower())
                    at = sorted(place[w] for w in place.keys() & features(own))
                    rows.append((np.array(at, np.int32).tobytes(), np.array(style(text or "", own)).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                                  pa.array([r[1] for r in rows], pa.binary()), b.column(1)],
                                                 ["at", "style", "y"])

        got = (sample.filter(F.col(y).isin(0, 1)).select("_text", y).transform(arrow_map, featured, "at binary, style binary, y int")
               .orderBy("style", "at", "y").collect())
        x = np.zeros((len(got), len(place) + STYLES))
        for k, r in enumerate(got):
            x[k, np.frombuffer(r["at"], np.int32)] = 1
            x[k, len(place):] = np.frombuffer(r["style"])
        styles = x[:, len(place):].copy()
        mean, scale = styles.mean(axis=0), np.maximum(styles.std(axis=0), 1e-3)
        x[:, len(place):] = (styles - mean) / scale
        target = np.array([r["y"] for r in got], np.float64)
        w = _logistic(x, target)
        models[name] = Target(dict(zip(known, w[:len(place)].tolist())), mean, scale, w[len(place):-1],
                              float(w[-1]) - float(np.log(pos / neg)))
    return models


def evidence(docs: DataFrame, models: dict[str, Target | None], host: Column, path: Column,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, host, path and each target's log-likelihood ratio (0 without a model)."""
    used = list(models.values())

    def run(texts: list) -> list:
        out: list[list[float]] = [[] for _ in used]
        for text in texts:
            words = WORD.findall((text or "").lower())
            found, styles = features(words), np.array(style(text or "", words))
            for k, m in enumerate(used):
                out[k].append(0.0 if m is None else max(-30.0, min(30.0, m.evidence(found, styles))))
        return out

    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                       F.coalesce(path.cast("string"), F.lit("")).alias("path"))
    found = map_texts(slim, run, [(f"llr_{n}", "double") for n in models], "doc_id", "text", carry=True)
    return found.select("doc_id", F.col("row.host").alias("host"), F.col("row.path").alias("path"),
                        *[f"llr_{n}" for n in models])


def _probability(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def _strength(groups: DataFrame, centre: Column, rate: float, target: str) -> float:
    """Weight of the prior in documents, by moments: between-group variance of the rates beyond what chance makes.

    One row goes to the driver."""
    mean = F.col(f"k_{target}") / F.col("n")
    row = (groups.filter("n > 0")
           .agg(F.sum(F.col("n") * (mean - centre) ** 2).alias("ss"), F.sum("n").alias("n"), F.count("*").alias("g")).first())
    if not row["g"] or row["g"] < 2:
        return 100.0
    noise = rate * (1 - rate)
    spread = (row["ss"] - row["g"] * noise) / row["n"]
    return float(min(1e4, max(2.0, noise / spread - 1))) if spread > 0 else 1e4


def site_posteriors(found: DataFrame, base_rates: dict[str, float]) -> DataFrame:
    """host, path, n and for each target ``prior_<target>``: the path's posterior rate.

    Documents are counted by path first, so a host with a third of all documents leaves a few rows a task."""
    names = list(base_rates)
    soft = [F.sum(_probability(F.col(f"llr_{t}") + F.lit(float(np.log(r / (1 - r)))))).alias(f"k_{t}")
            for t, r in base_rates.items()]
    paths = stored(found.groupBy("host", "path").agg(F.count("*").alias("n"), *soft), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(f"k_{t}").alias(f"k_{t}") for t in names])
    total = hosts.agg(F.sum("n").alias("n"), *[F.sum(f"k_{t}").alias(f"k_{t}") for t in names]).first()
    joined = paths.join(hosts.select("host", F.col("n").alias("host_n"),
                                     *[F.col(f"k_{t}").alias(f"host_k_{t}") for t in names]), "host")
    out = [F.col("host"), F.col("path"), F.col("n")]
    for t in names:
        rate = min(0.999, max(0.001, (total[f"k_{t}"] or 0) / total["n"])) if total["n"] else 0.5
        host_weight = _strength(hosts, F.lit(rate), rate, t)
        host_rate = (F.col(f"host_k_{t}") + F.lit(host_weight * rate)) / (F.col("host_n") + F.lit(host_weight))
        path_weight = _strength(joined, host_rate, rate, t)
        out.append(((F.col(f"k_{t}") + F.lit(path_weight) * host_rate) / (F.col("n") + F.lit(path_weight)))
                   .alias(f"prior_{t}"))
    return joined.select(*out)


def judge(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "path",
          id_col: str = "doc_id", text_col: str = "text", min_quality: float = 0.5, max_toxic: float = MAX_TOXIC,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row for each document: doc_id, score (probability of good quality), toxic_score, the site priors, and
    kept: good enough and not toxic."""
    models = fit(docs, labels, id_col, text_col, TARGETS, sample_rows)
    rates = {}
    for t in TARGETS:
        row = labels.agg(F.sum((F.col(t) == 1).cast("long")).alias("p"),
                         F.sum(F.col(t).isin(0, 1).cast("long")).alias("n")).first()
        rates[t] = min(0.99, max(0.01, (row["p"] or 0) / row["n"])) if row["n"] else 0.5
    found = stored(evidence(docs, models, F.col(f"`{host_col}`"), F.col(f"`{path_col}`"), id_col, text_col), "evidence")
    sites = site_posteriors(found, rates)
    both = found.join(sites.drop("n"), ["host", "path"])
    p = {t: _probability(F.col(f"llr_{t}") + F.log(F.col(f"prior_{t}") / (1 - F.col(f"prior_{t}")))) for t in TARGETS}
    return (both.select("doc_id", p["quality"].alias("score"), p["toxic"].alias("toxic_score"),
                        "prior_quality", "prior_toxic")
            .withColumn("kept", (F.col("score") >= min_quality) & (F.col("toxic_score") < max_toxic)))
