"""ML fits, physical hints, sampled counts and a time-bounded stream run."""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from revlens.operators import hints, ml, profile
from revlens.operators import text as tx
from revlens.session import scratch_path
from revlens.streaming import stream as st


def test_kmeans_flags_smallest_cluster(spark):
    vals = [1.0 + (i % 7) * 0.1 for i in range(200)] + [100.0 + i for i in range(10)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, value double")
    out = ml.kmeans_anomaly(df, ["value"], k=2, seed=1)
    flagged = sorted(r.value for r in out.filter("is_anomaly").collect())
    assert flagged == [100.0 + i for i in range(10)]
    assert out.count() == 210


def test_count_vectors_and_lda_shapes(spark):
    docs = ["red apple green apple", "green pear red pear", "apple pear fruit salad",
            "car engine wheel", "engine oil car wheel", "wheel car road trip"] * 5
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id int, text string")
    words = df.select("doc_id", tx.without_stop_words(tx.tokens("text")).alias("words"))
    cv = ml.fit_count_vectors(words, "words", vocab_size=5, min_df=2)
    assert len(cv.vocabulary) == 5
    stats = ml.vector_stats(cv.transform(words), "doc_id")
    assert stats.count() == 30 and stats.agg(F.max("n_distinct_terms")).first()[0] <= 5
    model = ml.fit_lda(cv.transform(words).select("doc_id", "features"), k=2, max_iter=5, seed=3)
    topics = ml.describe_topics(spark, model, cv.vocabulary, 3)
    assert topics.count() == 6 and set(topics.columns) == {"topic", "rank", "term", "weight"}


def test_small_inputs_are_dealt_over_the_cores(spark):
    path = scratch_path(spark, "one-file")
    spark.range(1000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    spread = hints.spread_small(df)
    sizes = spread.rdd.glom().map(len).collect()
    assert len(sizes) == spark.sparkContext.defaultParallelism and min(sizes) > 0 and sum(sizes) == 1000
    assert hints.spread_small(df, bytes_per_core=0) is df


def test_hints_keep_rows(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 5)
    cached = hints.cache(df)
    assert cached.storageLevel == StorageLevel.MEMORY_AND_DISK
    rep = hints.repartition_by(cached, 4, "k")
    assert rep.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, rep.collect())) == sorted(map(tuple, df.collect()))
    spread = hints.repartition_by(cached.filter("k = 1"), 8, "k", n_salts=32)
    assert sum(1 for p in spread.rdd.glom().collect() if p) > 3  # one key, several tasks
    cached.unpersist()


def test_approx_count_interval_covers_truth(spark):
    df = spark.range(20000)
    r = profile.approx_count(df, 0.1, seed=5).first()
    assert r.low <= 20000 <= r.high and abs(r.approx_rows - 20000) < 2000


def test_processing_time_run_is_bounded(spark):
    src = scratch_path(spark, "pt-src")
    df = spark.range(50).select(F.col("id"), (F.col("id") % 3).alias("g"))
    df.write.parquet(src)
    out = scratch_path(spark, "pt-out")
    q = st.stream_run(st.stream_parquet(spark, src, df.schema), out, scratch_path(spark, "pt-ck"),
                      processing_time="1 second", timeout=8)
    assert not q.isActive
    assert spark.read.parquet(out).count() == 50


def test_shuffle_partitions_sizing():
    from revlens.session import shuffle_partitions_for
    assert shuffle_partitions_for(100 * 1024 ** 4) == 409600
    assert shuffle_partitions_for(10 * 1024 ** 2) == 8
