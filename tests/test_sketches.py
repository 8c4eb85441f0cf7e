"""The store of daily sketches against exact counts and ranks."""

import contextlib
import datetime as dt
import io
import random


from revlens.operators.sketches import RANK_ERROR, SketchStore, count_error, daily_sketches
from revlens.session import scratch_path

SCHEMA = "day date, g string, who long, x double"
RANGES = {"one day": ("2024-01-05", "2024-01-05"), "week": ("2024-01-03", "2024-01-09"), "all": ("2024-01-01", "2024-01-31"), "none": ("2030-01-01", "2030-01-02")}


def rows(n, seed, people=30_000):
    r = random.Random(seed)
    return [(dt.date(2024, 1, r.randrange(1, 21)), r.choice(["a", "b", None]), r.choice([None, r.randrange(people)]), r.choice([None, r.gauss(0, 5)]))
            for _ in range(n)]


def inside(data, name):
    a, b = map(dt.date.fromisoformat, RANGES[name])
    return [r for r in data if r[0] is not None and a <= r[0] <= b]


def store_of(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return SketchStore.write(daily_sketches(df, "day", ["g"], "who", "x"), scratch_path(spark, "sk"))


def test_counts_and_quartiles_of_any_range(spark):
    data = rows(30_000, 1) + [(None, "a", 1, 1.0)]
    store = store_of(spark, data)
    got = {r.range: r for r in store.distinct(RANGES).collect()}
    assert set(got) == {"one day", "week", "all"}
    for name, r in got.items():
        exact = len({x[2] for x in inside(data, name) if x[2] is not None})
        assert abs(r.estimate - exact) <= r.error and (r.error == 0) == (exact < 2048)
    for r in store.quantiles(RANGES, [0.1, 0.5, 0.9], ["g"]).collect():
        own = sorted(x[3] for x in inside(data, r.range) if x[1] == r.g and x[3] is not None)
        share = sum(v <= r.value for v in own) / len(own)
        assert abs(share - r.share) <= RANK_ERROR + 1 / len(own)


def test_customers_in_all_of_several_ranges(spark):
    data = rows(20_000, 2, 9_000)
    store = store_of(spark, data)
    sets = {"both": ["one day", "week"], "with none": ["week", "none"]}
    got = {r.name: r for r in store.in_all({n: [RANGES[x] for x in own] for n, own in sets.items()}).collect()}
    first, second = ({x[2] for x in inside(data, n) if x[2] is not None} for n in sets["both"])
    assert abs(got["both"].estimate - len(first & second)) <= max(got["both"].error, count_error() * len(first | second))
    assert got["with none"].estimate == 0


def test_appended_rows_unite_with_their_days(spark):
    first, more = rows(1_500, 3, 900), rows(1_500, 4, 900)
    store = store_of(spark, first)
    store.append(daily_sketches(spark.createDataFrame(more, SCHEMA), "day", ["g"], "who", "x"))
    got = {(r.range, r.g): r.estimate for r in store.distinct(RANGES, ["g"]).collect()}
    for (name, g), estimate in got.items():
        assert estimate == len({x[2] for x in inside(first + more, name) if x[1] == g and x[2] is not None})


def test_a_question_reads_sketches_of_its_days_only(spark):
    store = store_of(spark, rows(500, 5))
    with contextlib.redirect_stdout(buf := io.StringIO()):
        store.distinct({"week": RANGES["week"]}).explain("formatted")
    plan = buf.getvalue()
    assert "GreaterThanOrEqual(day,2024-01-03), LessThanOrEqual(day,2024-01-09)" in plan
    assert "ReadSchema: struct<day:date,customers:binary>" in plan and "who" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_days_without_values(spark):
    store = store_of(spark, [(dt.date(2024, 1, 5), "a", None, None)] * 3)
    assert [r.estimate for r in store.distinct({"d": RANGES["one day"]}).collect()] == [0]
    assert store.quantiles({"d": RANGES["one day"]}).collect() == []
    empty = SketchStore.write(daily_sketches(spark.createDataFrame([], SCHEMA), "day", [], "who", "x"), scratch_path(spark, "sk"))
    assert empty.distinct(RANGES).collect() == []
