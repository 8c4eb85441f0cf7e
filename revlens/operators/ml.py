"""Topic model and clustering with ``pyspark.ml`` (distributed fits, fixed seeds)."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml.clustering import KMeans, KMeansModel, LDA, LDAModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def fit_count_vectors(df: DataFrame, words_col: str, vocab_size: int = 1000, min_df: float = 5,
                      out: str = "features") -> CountVectorizerModel:
    """Bag-of-words vocabulary (most frequent terms seen in >= ``min_df`` texts)."""
    return CountVectorizer(inputCol=words_col, outputCol=out, vocabSize=vocab_size, minDF=min_df).fit(df)


def vector_stats(df: DataFrame, key: str, features: str = "features") -> DataFrame:
    """Per row: total term count and distinct vocabulary terms of a count vector."""
    stored = F.unwrap_udt(F.col(features)).getField("values")  # of a sparse vector only the terms that occur
    return df.select(key, F.aggregate(stored, F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("n_terms"),
                     F.size(F.filter(stored, lambda x: x > 0)).alias("n_distinct_terms"))


def fit_lda(vectors: DataFrame, k: int = 5, max_iter: int = 10, seed: int = 11,
            features: str = "features") -> LDAModel:
    """LDA topic model (online optimizer, the Spark default)."""
    return LDA(k=k, maxIter=max_iter, seed=seed, featuresCol=features).fit(vectors)


def describe_topics(spark, model: LDAModel, vocabulary: list[str], n_terms: int = 5) -> DataFrame:
    """Top terms per topic as (topic, rank, term, weight).

    The vocabulary frame has at most ``vocabSize`` rows (a model parameter),
    so the join is against a bounded table.
    """
    vocab = spark.createDataFrame(list(enumerate(vocabulary)), "term_index int, term string")
    t = model.describeTopics(n_terms).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "tw"))
    t = t.select("topic", "rank", F.col("tw.termIndices").alias("term_index"), F.col("tw.termWeights").alias("weight"))
    return t.join(vocab, "term_index").select("topic", "rank", "term", "weight")


def fit_kmeans(df: DataFrame, cols: list[str], k: int = 2, seed: int = 1) -> tuple[VectorAssembler, KMeansModel]:
    """N9 fit: assemble the columns and cluster."""
    asm = VectorAssembler(inputCols=cols, outputCol="_features", handleInvalid="skip")
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(asm.transform(df))
    return asm, model


def kmeans_anomaly(df: DataFrame, cols: list[str], k: int = 2, seed: int = 1) -> DataFrame:
    """Rows of the smallest cluster are flagged as anomalies.

    Cluster numbers are arbitrary; the smallest cluster (sizes from the
    training summary, k numbers) is the anomalous one.
    """
    asm, model = fit_kmeans(df, cols, k, seed)
    sizes = model.summary.clusterSizes
    smallest = min(range(len(sizes)), key=lambda i: (sizes[i], i))
    out = model.transform(asm.transform(df)).drop("_features")
    return out.withColumn("is_anomaly", F.col("cluster") == F.lit(smallest))


@dataclass(frozen=True)
class TwoMeans:
    """The best two clusters of one column: values up to ``split`` and the others, with rows, means and the sum of
    squared distances.  With fewer than two different values there is no split."""

    split: float | None
    sizes: tuple[int, int]
    centres: tuple[float | None, float | None]
    cost: float

    @property
    def smallest(self) -> int | None:
        return None if self.split is None else int(self.sizes[1] < self.sizes[0])


def two_means(df: DataFrame, col: str, n_ranges: int = 256) -> TwoMeans:
    """N9 without a search: the optimal two clusters of one column.

    Clusters on a line are cut by one value, and the cost of each cut follows from the counts and sums below it.  Rows
    become a histogram (written once); its values are dealt into ranges, the sums before each range (``n_ranges`` rows) go through the
    driver, and a running sum within a range gives every cut, so no task sorts all values.
    """
    spark, v = df.sparkSession, F.col(f"`{col}`").cast("double")
    path = scratch_path(spark, "histogram")
    df.select(v.alias("v")).filter("v IS NOT NULL AND NOT isnan(v)").groupBy("v").agg(F.count("*").alias("n")).write.parquet(path)
    hist = spark.read.parquet(path)
    head = hist.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("mean"),
                    F.percentile_approx("v", [k / n_ranges for k in range(1, n_ranges)], 10 * n_ranges).alias("cuts")).first()
    if not head["n"]:
        return TwoMeans(None, (0, 0), (None, None), 0.0)
    cuts = F.array(*[F.lit(float(c)) for c in sorted(set(head["cuts"]))])
    x = F.col("v") - F.lit(head["mean"])  # sums of squares of centred values lose no digits
    placed = hist.select("v", "n", (F.col("n") * x).alias("s"), (F.col("n") * x * x).alias("q"),
                         F.size(F.filter(cuts, lambda c: c < F.col("v"))).alias("r"))
    totals = placed.groupBy("r").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("r").collect()
    n, s, q = (sum(t[c] for t in totals) for c in "nsq")
    before = zip([t["r"] for t in totals], accumulate((t["n"] for t in totals), initial=0), accumulate((t["s"] for t in totals), initial=0.0))
    offsets = spark.createDataFrame(list(before), "r int, n0 long, s0 double")
    run = Window.partitionBy("r").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    below = (placed.join(offsets, "r").select("v", (F.col("n0") + F.sum("n").over(run)).alias("n1"), (F.col("s0") + F.sum("s").over(run)).alias("s1"))
             .filter(F.col("n1") < n))
    gain = F.col("s1") * F.col("s1") / F.col("n1") + (F.lit(s) - F.col("s1")) * (F.lit(s) - F.col("s1")) / (F.lit(n) - F.col("n1"))
    best = below.agg(F.max(F.struct(gain.alias("gain"), (-F.col("v")).alias("least"), "n1", "s1")).alias("m")).first()["m"]
    if best is None:
        return TwoMeans(None, (n, 0), (head["mean"], None), max(0.0, q))
    n1, s1 = best["n1"], best["s1"]
    return TwoMeans(-best["least"], (n1, n - n1), (head["mean"] + s1 / n1, head["mean"] + (s - s1) / (n - n1)), max(0.0, q - best["gain"]))


def two_means_anomaly(df: DataFrame, col: str, n_ranges: int = 256) -> DataFrame:
    """Rows with a value, with their cluster (0 has the lower values) and whether it is the smaller one (of
    two alike the lower one).  Without two different values all rows are of cluster 0 and none is an anomaly."""
    fit = two_means(df, col, n_ranges)
    v = F.col(f"`{col}`").cast("double")
    rows = df.filter(v.isNotNull() & ~F.isnan(v))
    if fit.split is None:
        return rows.withColumns({"cluster": F.lit(0), "is_anomaly": F.lit(False)})
    cluster = F.when(v > F.lit(fit.split), 1).otherwise(0)
    return rows.withColumns({"cluster": cluster, "is_anomaly": cluster == F.lit(fit.smallest)})
