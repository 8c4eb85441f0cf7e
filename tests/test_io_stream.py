"""Sources, sinks and streaming runs (each test writes under a fresh scratch folder)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import scratch_path
from revlens.sources import files as io
from revlens.streaming import stream as st


def _write_text(spark, lines, label):
    p = scratch_path(spark, label)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(p)
    return p


def test_scan_json_review_quirks(spark):
    lines = [
        '{"reviewerID": "A1", "asin": "B1", "overall": 3.0, "verified": "false", "vote": "5", '
        '"reviewTime": "12 11, 2015", "unixReviewTime": 1449792000, "summary": "ok"}',
        '{"reviewerID": "A2", "asin": "B1", "overall": 5.0, "verified": true, "vote": "1,234", '
        '"reviewTime": "02 2, 2018", "reviewText": null}',
        '{"reviewerID": "A3", "asin": ',
        '{"reviewerID": "A1", "asin": "B1", "overall": 4.0, "vote": null}',
    ]
    p = _write_text(spark, lines, "review-json")
    raw = io.scan_json(spark, p, io.REVIEW_RAW_SCHEMA)
    rows = io.normalize_reviews(raw).collect()
    assert len(rows) == 4
    bad = [r for r in rows if r[io.CORRUPT] is not None]
    assert len(bad) == 1 and bad[0].reviewerID is None
    a1 = [r for r in rows if r.reviewerID == "A1" and r.overall == 3][0]
    assert a1.verified is False and a1.vote == 5 and a1.review_date == dt.date(2015, 12, 11)
    assert a1.summary == "ok"
    a2 = [r for r in rows if r.reviewerID == "A2"][0]
    assert a2.verified is True and a2.vote is None and a2.review_date == dt.date(2018, 2, 2)


def test_load_counted(spark):
    p = _write_text(spark, ['{"reviewerID": "x"}'] * 3, "counted")
    df, n, secs = io.load_counted(spark, p, io.REVIEW_RAW_SCHEMA)
    assert n == 3 and secs >= 0


def test_json_array_round_trip_and_rejects(spark):
    rows = spark.range(100).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).cast("string").alias("v"))
    p = scratch_path(spark, "arr")
    io.write_json_arrays(rows, p, n_files=4)
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    back = io.scan_json_array(spark, p, schema)
    assert sorted(map(tuple, back.select("k", "v").collect())) == sorted(map(tuple, rows.collect()))
    empty = _write_text(spark, ["[]"], "arr-empty")
    with pytest.raises(ValueError):
        io.scan_json_array(spark, empty, schema)
    scalars = _write_text(spark, ["[1, 2, 3]"], "arr-scalars")
    with pytest.raises(ValueError):
        io.scan_json_array(spark, scalars, schema)


def test_partitioned_write_prunes(spark):
    df = spark.createDataFrame([(i, i % 5 + 1) for i in range(50)], "id int, overall int")
    p = scratch_path(spark, "part")
    io.write_partitioned(df, p, "overall")
    back = spark.read.parquet(p).filter(F.col("overall") == 5)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(overall" in plan
    assert back.count() == 10


def test_table_bytes_and_export(spark):
    df = spark.range(10)
    p = scratch_path(spark, "bytes")
    io.write_parquet(df, p)
    r = io.table_bytes(spark, p).first()
    assert r.bytes > 0 and r.files >= 1
    out = scratch_path(spark, "export")
    io.export_summary(df.groupBy((F.col("id") % 2).alias("k")).count(), out, fmt="json")
    assert spark.read.json(out).count() == 2


def test_stream_equals_batch_and_watermark_bounds_state(spark):
    schema = "k string, ts timestamp, v double"
    src = scratch_path(spark, "stream-src")
    batch1 = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 0), 1.0), ("a", dt.datetime(2024, 1, 1, 0, 5), 2.0),
                                    ("b", dt.datetime(2024, 1, 1, 0, 6), None)], schema)
    batch1.coalesce(1).write.mode("append").parquet(src)
    s = st.stream_parquet(spark, src, batch1.schema, max_files_per_trigger=1)
    clean = st.stream_clean(s, ["k"], ["k", "v"])
    out = scratch_path(spark, "stream-out")
    st.stream_run(clean, out, scratch_path(spark, "stream-ck"))
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a"]

    # watermark form: a repeat far later than the delay is a new row.  One file
    # arrives per run and each run restarts from the same checkpoint, so the
    # arrival order is fixed (and restart-from-checkpoint is exercised too).
    arrivals = [("a", dt.datetime(2024, 1, 1, 0, 0)), ("z", dt.datetime(2024, 1, 3, 0, 0)),
                ("a", dt.datetime(2024, 1, 5, 0, 0))]
    src2 = scratch_path(spark, "stream-src2")
    out2, ck2 = scratch_path(spark, "stream-out2"), scratch_path(spark, "stream-ck2")
    out3, ck3 = scratch_path(spark, "stream-out3"), scratch_path(spark, "stream-ck3")
    for k, ts in arrivals:
        spark.createDataFrame([(k, ts, 1.0)], schema).coalesce(1).write.mode("append").parquet(src2)
        st.stream_run(st.stream_dedup(st.stream_parquet(spark, src2, batch1.schema), ["k"], "ts", "1 hour"), out2, ck2)
        st.stream_run(st.stream_dedup(st.stream_parquet(spark, src2, batch1.schema), ["k"]), out3, ck3)
    # 'a' expired from state once the watermark passed it, so its late repeat is new
    assert sorted(r.k for r in spark.read.parquet(out2).collect()) == ["a", "a", "z"]
    # without a watermark every key is remembered for ever
    assert sorted(r.k for r in spark.read.parquet(out3).collect()) == ["a", "z"]


def test_stream_zscore_matches_batch(spark):
    from revlens.operators import stats
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 2, 1, 2, 3, 50]], "x double")
    src = scratch_path(spark, "z-src")
    df.write.parquet(src)
    fit = st.fit_zscore(df, "x")
    s = st.stream_zscore(st.stream_parquet(spark, src, df.schema), "x", fit, 2.0)
    out = scratch_path(spark, "z-out")
    st.stream_run(s, out, scratch_path(spark, "z-ck"))
    got = sorted((r.x, r.is_anomaly) for r in spark.read.parquet(out).collect())
    want = sorted((r.x, r.is_anomaly) for r in stats.zscore_flag(df, "x", 2.0).collect())
    assert got == want


def test_export_charts(spark):
    from revlens.operators import charts
    rows = [(f"B{i % 4}", float(1 + i % 5), "x " * (i % 9 + 1), dt.date(2020, 1 + i % 3, 1), i % 2 == 0)
            for i in range(60)]
    df = spark.createDataFrame(rows, "asin string, overall double, reviewText string, review_date date, verified boolean")
    out = scratch_path(spark, "charts")
    written = charts.export_charts(df, out)
    assert set(written) == {"top_reviewed_products", "review_distribution", "sentiment_distribution", "review_trends",
                            "verified_vs_non_verified", "review_length_vs_rating", "correlation_heatmap"}
    assert spark.read.json(written["review_trends"]).count() == 3
    assert spark.read.json(written["top_reviewed_products"]).count() == 4
    assert spark.read.json(written["correlation_heatmap"]).count() == 4
    # charts without their columns are skipped
    assert set(charts.chart_data(df.select("asin"))) == {"top_reviewed_products"}


def test_streams_read_folders_and_single_files_in_several_batches(spark, tmp_path):
    from revlens.plans import q_stream
    from revlens.streaming import stream as st
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(20).write.parquet(str(tmp_path / "events.parquet"))
    keys = ev.select("user_id", "event_type").distinct().count()
    for sf in (str(tmp_path), "/root/testdata/sf0.001"):
        assert q_stream.q_stream_parquet_sink(spark, sf).count() == ev.count()
        assert q_stream.q_stream_pipeline(spark, sf).count() == ev.count()
    s = st.event_time(st.stream_table(spark, str(tmp_path / "events.parquet"), max_files_per_trigger=5), "ts")
    clean = st.stream_clean(s, ["user_id", "event_type"], ["value"], "event_time", "36500 days")
    q = st.stream_run(clean, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert len(q.recentProgress) >= 4 and spark.read.parquet(str(tmp_path / "out")).count() == keys


def test_unfinished_available_now_run_raises(spark, tmp_path):
    import pytest
    from revlens.streaming import stream as st
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(20).write.parquet(str(tmp_path / "events.parquet"))
    s = st.stream_table(spark, str(tmp_path / "events.parquet"), max_files_per_trigger=1)
    with pytest.raises(TimeoutError):
        st.stream_run(s, str(tmp_path / "out"), str(tmp_path / "ck"), timeout=0.2)


def test_derived_table_notices_a_changed_source(spark):
    from revlens.sources import derived
    src = scratch_path(spark, "derived-src")
    read = lambda: derived.stored(spark, "probe", [src], lambda: spark.read.parquet(src)).count()
    spark.range(5).write.parquet(src)
    assert read() == 5 and read() == 5
    spark.range(3).write.mode("append").parquet(src)
    assert read() == 8


def test_v0_helpful_field(spark):
    p = _write_text(spark, ['{"reviewerID": "a", "helpful": "[2, 3]"}', '{"reviewerID": "b", "helpful": [4, 5]}',
                            '{"reviewerID": "c", "helpful": "many"}', '{"reviewerID": "d"}'], "v0")
    rows = io.normalize_reviews(io.scan_json(spark, p, io.REVIEW_V0_SCHEMA)).collect()
    got = {r.reviewerID: (r.helpful_votes, r.all_votes) for r in rows}
    assert got == {"a": (2, 3), "b": (4, 5), "c": (None, None), "d": (None, None)}


def test_json_arrays_follow_the_row_count(spark):
    p = scratch_path(spark, "arr-auto")
    io.write_json_arrays(spark.range(95), p, rows_per_file=10)
    assert spark.read.format("binaryFile").option("recursiveFileLookup", True).load(p).count() == 10
    io.write_json_arrays(spark.range(0), scratch_path(spark, "arr-none"), rows_per_file=10)
