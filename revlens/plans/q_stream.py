"""Queries: streaming runs over the events table (bounded with availableNow)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.files import write_json_lines
from ..sources.tables import table
from ..streaming import running
from ..streaming import stream as st
from .catalog import register


def _events_stream(spark, sf, fmt="parquet"):
    """The events table as a file stream: the stored table (one file or a folder of
    part files), or, for the JSON source, a JSON-lines copy of it."""
    ev = table(spark, sf, "events")
    if fmt == "json":
        src = scratch_path(spark, "events-json-src")
        write_json_lines(ev, src)
        return st.stream_json(spark, src, ev.schema), ev
    return st.stream_table(spark, f"{sf.rstrip('/')}/events.parquet"), ev


def _run(spark, df, label):
    sink = scratch_path(spark, f"{label}-out")
    st.stream_run(df, sink, scratch_path(spark, f"{label}-ck"))
    return spark.read.parquet(sink)


@register("stream_json", "SELECT * FROM events")
def q_stream_json(spark, sf):
    s, _ = _events_stream(spark, sf, "json")
    return _run(spark, s, "stream-json")


@register("stream_parquet_sink", "SELECT * FROM events")
def q_stream_parquet_sink(spark, sf):
    s, _ = _events_stream(spark, sf, "parquet")
    return _run(spark, s, "stream-parquet")


@register("stream_clean", """
SELECT DISTINCT user_id, event_type FROM events
WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL""")
def q_stream_clean(spark, sf):
    s, _ = _events_stream(spark, sf)
    # state is bounded by a delay longer than the table's span, so every repeated key is seen
    clean = st.stream_clean(st.event_time(s, "ts"), ["user_id", "event_type"], ["user_id", "event_type", "value"],
                            "event_time", "36500 days")
    return _run(spark, clean, "stream-clean").select("user_id", "event_type")


@register("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def q_stream_dedup(spark, sf):
    s, _ = _events_stream(spark, sf)
    s = st.event_time(s, "ts")
    d = st.stream_dedup(s, ["user_id", "event_type"], "event_time", "36500 days")
    return _run(spark, d, "stream-dedup").select("user_id", "event_type")


@register("stream_zscore", """
SELECT event_id, value,
       coalesce((value - (SELECT avg(value) FROM events)) / nullif((SELECT stddev_samp(value) FROM events), 0) > 2, false)
       AS is_anomaly
FROM events""")
def q_stream_zscore(spark, sf):
    s, ev = _events_stream(spark, sf)
    fit = st.fit_zscore(ev, "value")
    flagged = st.stream_zscore(s.select("event_id", "value"), "value", fit, 2.0)
    return _run(spark, flagged, "stream-zscore")


@register("stream_pipeline", """
SELECT event_id, value,
       coalesce((value - (SELECT avg(value) FROM events)) / nullif((SELECT stddev_samp(value) FROM events), 0) > 2, false)
       AS is_anomaly
FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL""")
def q_stream_pipeline(spark, sf):
    """Read, clean, flag, write: one stream (event ids are unique, so the dedup keeps every event)."""
    s, ev = _events_stream(spark, sf)
    clean = st.stream_clean(st.event_time(s, "ts"), ["event_id"], ["user_id", "event_type", "value"],
                            "event_time", "36500 days")
    flagged = st.stream_zscore(clean, "value", st.fit_zscore(ev, "value"), 2.0)
    return _run(spark, flagged, "stream-pipeline").select("event_id", "value", "is_anomaly")


@register("stream_run", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def q_stream_run(spark, sf):
    s, _ = _events_stream(spark, sf)
    out = _run(spark, s.select("event_id", "event_type"), "stream-run")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))


#: Days of a slice of the events; the table spans 30 days from this one on.
SLICE_DAYS, FIRST_DAY = 5, "2024-01-01"
SLICE_SQL = f"CAST(floor(date_diff('day', DATE '{FIRST_DAY}', CAST(ts AS DATE)) / {SLICE_DAYS}) AS INTEGER)"


def _sliced(df):
    return df.withColumn("slice", F.floor(F.datediff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date")) / SLICE_DAYS).cast("int"))


def _slices_stream(spark, sf):
    """The events as a stream of slices in the order of time: one micro-batch for each slice (files are read in the
    order in which they were written)."""
    ev = _sliced(table(spark, sf, "events"))
    src = scratch_path(spark, "events-slices")
    for row in ev.select("slice").distinct().orderBy("slice").collect():
        part = ev.filter(F.col("slice") == row["slice"]) if row["slice"] is not None else ev.filter("slice IS NULL")
        part.coalesce(1).write.mode("append").parquet(src)
    return st.stream_parquet(spark, src, ev.schema, max_files_per_trigger=1)


def _running(spark, sf, keys=()):
    sink, state, check = (scratch_path(spark, f"running-{x}") for x in ("out", "state", "ck"))
    running.run_running_zscore(_slices_stream(spark, sf).select("event_id", "event_type", "value", "slice"), "value", sink, state, check,
                               threshold=1.5, keys=keys)
    return spark.read.parquet(sink)


@register("stream_running_zscore", f"""
WITH e AS (SELECT event_id, value, {SLICE_SQL} AS slice FROM events),
s AS (SELECT a.slice, avg(value) AS mean, stddev_samp(value) AS sd
      FROM (SELECT DISTINCT slice FROM e) a JOIN e ON e.slice < a.slice GROUP BY a.slice)
SELECT event_id, value, e.slice, coalesce((value - mean) / nullif(sd, 0) > 1.5, false) AS is_anomaly
FROM e LEFT JOIN s ON e.slice = s.slice""")
def q_stream_running_zscore(spark, sf):
    """Each slice of events is flagged by all earlier slices."""
    return _running(spark, sf).select("event_id", "value", "slice", "is_anomaly")


@register("stream_running_zscore_by_type", f"""
WITH e AS (SELECT event_id, event_type, value, {SLICE_SQL} AS slice FROM events),
s AS (SELECT a.slice, e.event_type, avg(value) AS mean, stddev_samp(value) AS sd
      FROM (SELECT DISTINCT slice FROM e) a JOIN e ON e.slice < a.slice GROUP BY a.slice, e.event_type)
SELECT event_id, e.event_type, value, e.slice, coalesce((value - mean) / nullif(sd, 0) > 1.5, false) AS is_anomaly
FROM e LEFT JOIN s ON e.slice = s.slice AND e.event_type IS NOT DISTINCT FROM s.event_type""")
def q_stream_running_zscore_by_type(spark, sf):
    """The same with a state for each type of event."""
    return _running(spark, sf, ["event_type"]).select("event_id", "event_type", "value", "slice", "is_anomaly")


#: The slice's first day is its event time.  A key seen in slice s is remembered for 2 days: the watermark, 2 days behind
#: the latest slice before, passes that time in slice s + 2 (5 - 2 >= 2), at whose end the key is forgotten.
EVICTION_SQL = f"""
WITH RECURSIVE k AS (SELECT DISTINCT user_id, event_type, {SLICE_SQL} AS slice FROM events WHERE ts IS NOT NULL),
seen AS (
  SELECT user_id, event_type, min(slice) AS slice FROM k GROUP BY ALL
  UNION ALL
  SELECT s.user_id, s.event_type, min(k.slice) FROM seen s JOIN k
    ON k.user_id IS NOT DISTINCT FROM s.user_id AND k.event_type IS NOT DISTINCT FROM s.event_type AND k.slice >= s.slice + 3
  GROUP BY s.user_id, s.event_type)
SELECT user_id, event_type, slice FROM seen"""


@register("stream_dedup_eviction", EVICTION_SQL)
def q_stream_dedup_eviction(spark, sf):
    """Repeated keys are dropped while the state remembers them; what the watermark has passed is forgotten and seen again."""
    s = _slices_stream(spark, sf).filter("ts IS NOT NULL")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("slice") * SLICE_DAYS)
    s = s.select("user_id", "event_type", "slice", day.cast("timestamp").alias("event_time"))
    return _run(spark, st.stream_dedup(s, ["user_id", "event_type"], "event_time", "2 days"), "stream-evict").select("user_id", "event_type", "slice")
