"""Running statistics and bounded state on streams."""

import datetime as dt
import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from revlens.session import scratch_path
from revlens.streaming import running
from revlens.streaming import stream as streams

SCHEMA = "key string, x double, at int"


def flags(batches, threshold, keyed):
    """Flags of each row by the rows of earlier batches."""
    out, seen = [], {}
    for rows in batches:
        for key, x, at in rows:
            old = seen.get(key if keyed else 0, [])
            sd = statistics.stdev(old) if len(old) > 1 else 0
            out.append((key, x, at, bool(x is not None and sd and (x - statistics.fmean(old)) / sd > threshold)))
        for key, x, _ in rows:
            if x is not None:
                seen.setdefault(key if keyed else 0, []).append(x)
    return sorted(out, key=repr)


def sample_batches(n=5, seed=1):
    r = random.Random(seed)
    return [[(r.choice(["a", "b", None]), r.choice([None, r.gauss(10, 3), r.gauss(10, 30)]), 100 * b + k) for k in range(40)] for b in range(n)]


@pytest.mark.parametrize("keyed", [False, True])
def test_batches_are_flagged_by_earlier_ones_and_may_run_again(spark, keyed):
    batches, keys = sample_batches(), ["key"] if keyed else []
    sink, state = scratch_path(spark, "run-out"), running.RunningState(spark, scratch_path(spark, "run-state"))
    frames = [spark.createDataFrame(b, SCHEMA) for b in batches]
    for n, df in enumerate(frames):
        running.running_batch(df, n, "x", sink, state, 1.0, keys)
        if n in (1, 3):  # as after a failure before the batch was committed
            running.running_batch(df, n, "x", sink, state, 1.0, keys)
    got = sorted((tuple(r) for r in spark.read.parquet(sink).select("key", "x", "at", "is_anomaly").collect()), key=repr)
    assert got == flags(batches, 1.0, keyed) and any(g[3] for g in got)
    assert state.versions() == [3, 4]  # older states are gone
    want = running.moments(spark.createDataFrame([r for b in batches for r in b], SCHEMA), "x", keys)
    a, b = ({(r.asDict().get("key")): (r.n, r.mean, r.m2) for r in df.collect()} for df in (state.before(99), want))
    assert a.keys() == b.keys() and all(math.isclose(x, y, rel_tol=1e-9) for k in a for x, y in zip(a[k], b[k]))


def test_a_state_half_written_is_not_read(spark):
    state = running.RunningState(spark, scratch_path(spark, "run-state"))
    assert state.versions() == [] and state.before(0) is None
    one = running.moments(spark.createDataFrame([("a", 1.0, 1)], SCHEMA), "x")
    state.write(0, one)
    one.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{state.path}/batch=1")
    assert state.versions() == [0] and state.before(2).count() == 1


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(*[st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([None, float("nan"), 0.0, 1.5, -2.0, 1e6]), st.just(1)), max_size=8)] * 2)
def test_merged_moments_are_those_of_all_rows(spark, left, right):
    frames = [spark.createDataFrame(x, SCHEMA) for x in (left, right, left + right)]
    a, b, whole = (running.moments(f, "x", ["key"]) for f in frames)
    got = {r.key: (r.n, r.mean, r.m2) for r in running.merge_moments(a, b, ["key"]).collect()}
    want = {r.key: (r.n, r.mean, r.m2) for r in whole.collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-3) for k in got for x, y in zip(got[k], want[k]))


def test_a_restarted_stream_goes_on_with_its_state(spark):
    batches = sample_batches(4, 3)
    src, sink, state, check = (scratch_path(spark, f"restart-{x}") for x in ("src", "out", "state", "ck"))
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        running.run_running_zscore(streams.stream_parquet(spark, src, spark.createDataFrame(rows, SCHEMA).schema), "x", sink, state, check, 1.0, ["key"])
    got = sorted((tuple(r) for r in spark.read.parquet(sink).select("key", "x", "at", "is_anomaly").collect()), key=repr)
    assert got == flags(batches, 1.0, True)


def test_triggered_runs_end_after_their_time(spark):
    src, sink, state, check = (scratch_path(spark, f"trigger-{x}") for x in ("src", "out", "state", "ck"))
    df = spark.createDataFrame(sample_batches(1)[0], SCHEMA)
    df.coalesce(1).write.parquet(src)
    running.run_running_zscore(streams.stream_parquet(spark, src, df.schema), "x", sink, state, check, processing_time="1 second", timeout=6)
    assert spark.read.parquet(sink).count() == df.count()


def test_forgotten_keys_come_again(spark):
    """By batches: the key of slice 0 is dropped in slices 1 and 2 and comes again in slice 3."""
    from revlens.plans import q_stream
    first = dt.datetime.fromisoformat(q_stream.FIRST_DAY)
    rows = [(k, first + dt.timedelta(days=5 * s + 1), 7, "t", 1.0) for k, s in enumerate([0, 0, 1, 2, 3, 4])]
    folder = scratch_path(spark, "evict")
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{folder}/events.parquet")
    got = q_stream.q_stream_dedup_eviction(spark, folder).collect()
    assert sorted(r.slice for r in got) == [0, 3]


def test_fingerprints_follow_the_files(spark):
    from revlens.sources import derived
    path = scratch_path(spark, "prints")
    spark.range(5).repartition(3).write.parquet(path)
    one = derived.fingerprint(spark, [path])
    assert one == derived.fingerprint(spark, [path])
    spark.range(1).write.mode("append").parquet(path)
    assert one != derived.fingerprint(spark, [path])
