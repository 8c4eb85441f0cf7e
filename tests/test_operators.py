"""Unit tests on tiny in-line frames, nulls included."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from revlens.functions import dates, scalar
from revlens.operators import aggregate as ag
from revlens.operators import clean, lod, profile, stats, text


@pytest.fixture(scope="module")
def rv(spark):
    rows = [("u1", "p1", 5, True, 3, 1, dt.date(2020, 1, 5)),
            ("u1", "p1", 4, True, 2, 1, dt.date(2020, 1, 3)),
            ("u2", "p1", 1, False, 0, 0, dt.date(2020, 1, 3)),
            ("u3", "p2", 3, None, 10, 4, dt.date(2020, 2, 1)),
            ("u4", "p2", None, True, 5, 5, None),
            ("u5", "p3", 5, False, 1, 1, dt.date(2021, 3, 7))]
    return spark.createDataFrame(
        rows, "reviewer_id string, asin string, overall int, verified boolean, votes int, helpful int, review_date date")


def test_top_reviewed_ties_by_key(rv):
    out = [(r.asin, r.review_count) for r in ag.top_reviewed(rv, "asin", k=2).collect()]
    assert out == [("p1", 3), ("p2", 2)]


def test_sentiment_null_is_negative(rv):
    got = {r.sentiment: r["count"] for r in ag.sentiment_counts(rv).collect()}
    assert got == {"Positive": 3, "Neutral": 1, "Negative": 2}


def test_avg_by_flag_keeps_null_group(rv):
    got = {r.verified: r.avg_rating for r in ag.avg_by_flag(rv).collect()}
    assert set(got) == {True, False, None} and got[None] == 3.0


def test_rating_stats_mode_tie_smallest(spark):
    df = spark.createDataFrame([(1,), (1,), (3,), (3,), (5,), (None,)], "overall int")
    r = ag.rating_stats(df).first()
    assert r["mode"] == 1 and r["min"] == 1 and r["max"] == 5 and r["median"] == 3
    assert math.isclose(r["mean"], 2.6)


def test_box_stats_linear_quartiles(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "x double")
    r = ag.box_stats(df, "x").first()
    assert (r.q1, r.median, r.q3) == (2.0, 3.0, 4.0)
    assert r.upper_fence == 7.0 and r.upper_whisker == 4.0 and r.n_outliers == 1


def test_polarized_and_keyword_share(rv, spark):
    p = {r.asin: (r.one_star_reviews, r.five_star_reviews) for r in ag.polarized(rv, k=None).collect()}
    assert p == {"p1": (1, 1), "p3": (0, 1)}
    docs = spark.createDataFrame([("A Refund please",), ("fine",), (None,), ("RETURNED it",)], "t string")
    assert ag.keyword_share(docs, "t").first().keyword_pct == 50.0
    assert ag.keyword_share(docs.limit(0), "t").first().keyword_pct == 0.0


def test_week_and_names(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1),), (dt.date(2022, 1, 2),), (dt.date(2023, 12, 31),)], "d date")
    out = df.select(dates.week_part("d").alias("w"), dates.weekday_name("d").alias("n"),
                    dates.month_name("d").alias("m")).collect()
    # 2022-01-01 is a Saturday: week 1; Sunday the 2nd starts week 2.
    assert [(r.w, r.n) for r in out[:2]] == [(1, "Saturday"), (2, "Sunday")]
    assert out[2].m == "December"


def test_parse_review_time_both_day_widths(spark):
    df = spark.createDataFrame([("12 11, 2015",), ("02 2, 2018",), ("garbage",), (None,)], "t string")
    got = [r.d for r in df.select(dates.parse_review_time("t").alias("d")).collect()]
    assert got == [dt.date(2015, 12, 11), dt.date(2018, 2, 2), None, None]


def test_numeric_prefix(spark):
    df = spark.createDataFrame([("12abc",), (" -3.5e2x",), (".5",), ("abc",), ("",), (None,), ("1,234",)], "s string")
    got = [r.v for r in df.select(scalar.numeric_prefix("s").alias("v")).collect()]
    assert got == [12.0, -350.0, 0.5, None, None, None, 1.0]


def test_profile_inference(spark):
    df = spark.createDataFrame(
        [("12abc", True, None, "x", 1.5), ("7", False, None, "", 2.5), ("", None, None, "y", None)],
        "a string, b boolean, c string, d string, e double")
    prof = {r.column_name: r for r in profile.profile_columns(df).collect()}
    assert prof["a"].type == "numeric" and (prof["a"].min, prof["a"].max) == (7.0, 12.0)
    assert prof["b"].type == "categorical" and prof["b"].n_distinct == 3
    assert prof["c"].type == "categorical" and prof["c"].n_distinct == 1
    values = {(r.column_name, r.value) for r in profile.profile_values(df, ["b", "c"]).collect()}
    assert values == {("b", "false"), ("b", "null"), ("b", "true"), ("c", "null")}
    assert prof["d"].type == "categorical" and prof["d"].n_distinct == 3
    assert prof["e"].type == "numeric" and prof["e"].max == 2.5
    w = {r.column_name: r.widget for r in profile.filter_widgets(profile.profile_columns(df)).collect()}
    assert w["a"] == "range" and w["b"] == "list"


def test_profile_nan_is_numeric_but_not_a_bound(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    r = profile.profile_columns(df).first()
    assert r.type == "numeric" and (r.min, r.max) == (1.0, 3.0) and r.n_distinct == 3


def test_profile_keeps_every_value(spark):
    df = spark.range(3000).select(F.concat(F.lit("v"), "id").alias("s"))
    prof = profile.profile_columns(df)
    assert prof.first().n_distinct == 3000 and profile.profile_values(df).count() == 3000
    w = profile.filter_widgets(prof).first()
    assert w.widget == "none" and w.n_options == 3000


def test_null_keys_keep_their_group(spark):
    from revlens.operators import aggregate, lod
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 90)], "k string, v int")
    rows = lod.lod_join(df, ["k"], F.count(F.lit(1))).collect()
    assert sorted((r.k or "", r.fixed_value) for r in rows) == [("", 2), ("", 2), ("a", 1), ("b", 1)]
    total = lod.fixed_lod(df, ["k"], F.count(F.lit(1)), [F.lit(1).alias("one")]).first()
    assert total.value == 4
    box = {r.k: r for r in aggregate.box_stats(df, "v", "k").collect()}
    assert (box[None].lower_whisker, box[None].upper_whisker, box[None].n_outliers) == (3.0, 90.0, 0)


def test_spike_deviation_at_large_counts(spark):
    from revlens.operators import lod
    counts = [10 ** 9 + x for x in (0, 3, 1, 5, 2, 4, 6)]
    daily = spark.createDataFrame([(f"2024-01-{d + 1:02d}", c) for d, c in enumerate(counts)], "day string, day_count long")
    original, lod.daily_counts = lod.daily_counts, lambda *a: daily.withColumn("day", F.to_date("day"))
    try:
        out = {str(r.day): r for r in lod.spike_days_z(daily, "day").collect()}
    finally:
        lod.daily_counts = original
    assert abs(out["2024-01-07"].trailing_sd - 1.8708286933869707) < 1e-6

def test_filters(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, None), (5.0, "c")], "x double, s string")
    assert clean.range_filter(df, "x").count() == 2
    assert clean.range_filter(df, "x", 2, 9).count() == 1
    assert clean.in_filter(df, "s", ["null", "a"]).count() == 2
    assert clean.in_filter(df, "s", []).count() == 4
    assert clean.set_filter(df, "s", ["a", "b"]).count() == 2
    both = clean.filter_all(df, {"x": {"type": "numeric", "min": 0, "max": 10},
                                 "s": {"type": "categorical", "selected": ["c"]}})
    assert both.count() == 1


def test_null_handling(spark):
    df = spark.createDataFrame([(None, None, None, 3), ("u", None, "t", None), (None, "p", None, 1)],
                               "reviewer_id string, asin string, review_text string, overall int")
    assert clean.malformed_rows(df, ["reviewer_id", "asin", "review_text"]).count() == 1
    assert clean.drop_missing(df, ["reviewer_id"]).count() == 1
    filled = clean.fill_missing(df, {"review_text": "Unknown"})
    assert [r.review_text for r in filled.collect()] == ["Unknown", "t", "Unknown"]
    nulls = profile.null_counts(df).first().asDict()
    assert nulls == {"reviewer_id": 2, "asin": 2, "review_text": 2, "overall": 1}


def test_keyword_flag_null_text_is_zero(spark):
    df = spark.createDataFrame([("DEFECTIVE unit",), (None,), ("ok",)], "t string")
    assert [r.contains_keyword for r in clean.keyword_flag(df, "t").collect()] == [1, 0, 0]


def test_dedup_keys_deterministic_and_idempotent(rv):
    d = clean.dedup_keys(rv, ["reviewer_id", "asin"], ["review_date"])
    u1 = d.filter("reviewer_id = 'u1'").first()
    assert u1.review_date == dt.date(2020, 1, 3) and u1.overall == 4
    assert d.count() == 5
    again = clean.dedup_keys(d, ["reviewer_id", "asin"], ["review_date"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, d.collect()))
    assert d.columns == rv.columns


def test_zscore_one_sided_and_zero_spread(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 20.0, None]], "x double")
    flags = [r.is_anomaly for r in stats.zscore_flag(df, "x", 2.0).collect()]
    assert flags.count(True) == 1 and flags[-1] is False
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r.is_anomaly for r in stats.zscore_flag(flat, "x").collect()] == [False, False]


def test_upper_outlier_and_normalize(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 20 + [100]], "x double")
    assert clean.upper_outlier_filter(df, "x", 3.0).count() == 20
    assert clean.normalize_rating(spark.createDataFrame([(5,)], "overall int")).first().overall_normalized == 1.0


def test_corr_matrix_long_form(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 3.0), (3.0, 6.0, 1.0), (None, 1.0, 1.0)],
                               "a double, b double, c double")
    m = {(r.x, r.y): r.r for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(m) == 9 and math.isclose(m[("a", "b")], 1.0) and math.isclose(m[("c", "a")], -1.0)


def test_helpful_ratio(spark):
    df = spark.createDataFrame([(1, 2), (0, 0), (3, None)], "helpful int, votes int")
    assert [r.helpful_ratio for r in stats.helpful_ratio(df).collect()] == [0.5, None, None]


def test_fixed_lod_before_filter(spark):
    rows = [(dt.date(2020, 1, 1), "c1", 5), (dt.date(2020, 1, 1), "c2", 3), (dt.date(2020, 1, 1), "c3", 5),
            (dt.date(2020, 1, 2), "c1", 3)]
    df = spark.createDataFrame(rows, "d date, cust string, rating int")
    out = lod.fixed_lod(df, ["d"], F.count("cust"), [F.dayofmonth("d").alias("day")],
                        where=F.col("rating") == 5).collect()
    # the fixed count (3) is computed before the rating filter and counted once per mark
    assert [(r.day, r.value) for r in out] == [(1, 3)]
    joined = lod.lod_join(df, ["d"], F.count(F.lit(1)))
    assert sorted(r.fixed_value for r in joined.collect()) == [1, 3, 3, 3]


def test_manual_order(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    got = [r.k for r in ag.manual_order(df, "k", ["c", "a"]).collect()]
    assert got == ["c", "a", "b", None]


def test_tokens_and_stop_words(spark):
    df = spark.createDataFrame([("The café's GREAT, isn't it? the_end 42",)], "t string")
    toks = df.select(text.tokens("t").alias("w")).first().w
    assert toks == ["the", "caf", "s", "great", "isn", "t", "it", "the_end", "42"]
    kept = df.select(text.without_stop_words(text.tokens("t")).alias("w")).first().w
    assert "the" not in kept and "great" in kept and "42" in kept
    assert "the" in text.default_stop_words()


def test_word_repetition_and_sentiment(spark):
    df = spark.createDataFrame([(1, "a a a b", 5), (2, "a b c", 1), (3, None, 3)], "id int, t string, r int")
    rep = [(r.id, r.word_repetition_ratio) for r in text.word_repetition(df, "t", "id").collect()]
    assert rep == [(1, 2.0), (2, 1.0)]
    ws = {r.word: (r.avg_rating, r.word_count) for r in text.word_sentiment(df, "t", "r", 0).collect()}
    assert ws["a"] == (4.0, 4) and ws["c"] == (1.0, 1)


def test_verified_sentiment_pivot(rv):
    got = {r.verified: r for r in ag.verified_sentiment_pivot(rv).collect()}
    assert got[True]["Positive_count"] == 2 and got[True]["Positive_sum_rating"] == 9
    assert got[True]["Negative_count"] == 1 and got[None]["Neutral_count"] == 1


def test_shape_and_estimate(rv):
    assert tuple(profile.shape(rv).first()) == (6, 7)
    assert profile.estimated_size(rv).first().estimated_mb == pytest.approx(600 / 1048576)
    d = {r.column_name: r for r in profile.describe_long(rv).collect()}
    assert d["overall"]["count"] == 5 and d["overall"]["max"] == "5" and d["review_date"]["mean"] is None


def test_profile_types_agree_with_the_profile(spark):
    from revlens.operators import profile
    df = spark.createDataFrame([(1, "7", "x", None, ""), (2, "8 kg", "", None, ""), (None, None, "9", None, "3")],
                               "a int, b string, c string, d string, e string")
    types = {tuple(r) for r in profile.profile_types(df).collect()}
    assert types == {tuple(r) for r in profile.profile_columns(df).drop("n_distinct").collect()}
    assert {r[0]: r[1] for r in types} == {"a": "numeric", "b": "numeric", "c": "categorical", "d": "categorical",
                                           "e": "numeric"}
