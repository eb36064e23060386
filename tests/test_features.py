import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardbook.operators import features, reports, snapshots

GRID = "hour timestamp_ntz, line string, delays long, delays_5min long, delay_minutes long"


def test_flags(spark):
    rows = [(dt.datetime(2026, 9, 20, 3), "YU", 0, 0, 0), (dt.datetime(2026, 9, 22, 8), "BD", 1, 1, 7)]
    got = features.add_features(spark.createDataFrame(rows, GRID)).orderBy("hour").collect()
    assert [(r.is_weekend, r.is_service_hour, r.any_delay_5min) for r in got] == [(1, 0, 0), (0, 1, 1)]
    assert [(r.hour_of_day, r.weekday, r.month) for r in got] == [(3, 6, 9), (8, 1, 9)]


def test_service_hours(spark):
    rows = [(dt.datetime(2026, 1, 1, h), "YU", 0, 0, 0) for h in range(24)]
    got = features.add_features(spark.createDataFrame(rows, GRID)).filter("is_service_hour = 0").collect()
    assert sorted(r.hour_of_day for r in got) == [2, 3, 4, 5]


def test_grid_is_dense(spark):
    at = dt.datetime(2025, 3, 9, 2, 40)
    rows = [(at.date(), at, "YU", 5), (at.date(), at, "YU", None), (at.date(), at, "OTHER", 9), (dt.date(2025, 3, 10), None, "BD", 4)]
    fct = spark.createDataFrame(rows, "delay_date date, delay_at timestamp_ntz, line_group string, delay_minutes int")
    grid = features.build_grid(fct)
    assert grid.count() == 48 * 3
    assert [tuple(r) for r in grid.filter("delays > 0").collect()] == [(dt.datetime(2025, 3, 9, 2), "YU", 2, 1, 5)]


@pytest.mark.parametrize("block", [1024, 30, 24])
def test_history_matches_row_shift(spark, monkeypatch, block):
    monkeypatch.setattr(features, "_BLOCK", block)
    rng = random.Random(1)
    start, rows = dt.datetime(2025, 1, 30), []
    for line in ("YU", "BD", "SHP"):
        # Holes of a few hours, and one of more than a month.
        hours = [h for h in range(200) if rng.random() < 0.8] + [h for h in range(1200, 1300) if rng.random() < 0.7]
        rows += [(start + dt.timedelta(hours=h), line, rng.randrange(5), 0, 0) for h in hours]
    rows.append((start, "ONE", 3, 0, 0))
    want = []
    for line in {r[1] for r in rows}:
        ordered = sorted(r for r in rows if r[1] == line)
        for i, r in enumerate(ordered):
            past = [p[2] for p in ordered[max(0, i - 24) : i]]
            want.append((r[0], line, past[-1] if past else 0, sum(past)))
    got = features.add_history_features(spark.createDataFrame(rows, GRID)).select("hour", "line", *features_names())
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def features_names():
    return ["delays_prev_1h", "delays_prev_24h"]


def test_split_instant(spark):
    last = dt.datetime(2026, 8, 31, 23)
    hours = [last, last - dt.timedelta(days=90), last - dt.timedelta(days=90, hours=1), last - dt.timedelta(days=89, hours=23)]
    train, test = features.time_split(spark.createDataFrame([(h,) for h in hours], "hour timestamp_ntz"))
    assert [r.hour for r in train.collect()] == [hours[2]]
    assert sorted(r.hour for r in test.collect()) == sorted([hours[0], hours[1], hours[3]])


def test_training_frame_takes_history_before_dropping(spark):
    day = dt.date(2025, 1, 1)
    at = dt.datetime(2025, 1, 1, 0, 10)
    fct = spark.createDataFrame([(day, at, "YU", 6)], "delay_date date, delay_at timestamp_ntz, line_group string, delay_minutes int")
    weather = spark.createDataFrame([(dt.datetime(2025, 1, 1, 1), 3.0, None, 0.0, 1.0), (dt.datetime(2025, 1, 1), None, 1.0, 1.0, 1.0)], "hour timestamp_ntz, temperature_2m double, precipitation double, snowfall double, wind_speed_10m double")
    got = features.training_frame(fct, weather).filter("line = 'YU'").collect()
    assert [(r.hour.hour, r.delays_prev_1h, r.delays_prev_24h, r.any_delay_5min) for r in got] == [(1, 1, 1, 0)]


def test_repeated_weather_hour_fails(spark):
    hour = dt.datetime(2025, 1, 1)
    schema = "hour timestamp_ntz, temperature_2m double, precipitation double, snowfall double, wind_speed_10m double"
    weather = spark.createDataFrame([(hour, 1.0, 0.0, 0.0, 0.0), (hour, 2.0, 0.0, 0.0, 0.0)], schema)
    grid = spark.createDataFrame([(hour, "YU", 0, 0, 0)], GRID)
    with pytest.raises(Exception, match="more than one weather row at 2025-01-01"):
        features.join_weather(grid, weather).collect()


def test_history_needs_delays(spark):
    frame = spark.createDataFrame([(dt.datetime(2025, 1, 1), "YU")], "hour timestamp_ntz, line string")
    assert features.add_history_features(frame).columns == ["hour", "line"]


def test_baseline_falls_back_to_overall_rate(spark):
    schema = "line string, weekday int, hour_of_day int, any_delay_5min int"
    train = spark.createDataFrame([("YU", 0, 8, 1), ("YU", 0, 8, 0), ("BD", 0, 8, 0), ("BD", 1, 8, 0)], schema)
    test = spark.createDataFrame([("YU", 0, 8, 1), ("SHP", 0, 8, 0)], schema)
    assert {r.line: r.p for r in features.baseline_rate(train, test).collect()} == {"YU": 0.5, "SHP": 0.25}


def test_yoy_and_top_n(spark):
    df = spark.createDataFrame([(2019, "a", 10), (2020, "a", 15), (2022, "a", 3), (2020, "b", 4)], "year int, k string, n long")
    got = {(r.year, r.k): (r.n, r.previous, r.change) for r in reports.yoy(df, "year", "n", ["k"]).collect()}
    assert got[(2020, "a")] == (15, 10, 0.5) and got[(2022, "a")] == (3, 0, None) and got[(2021, "a")] == (0, 15, -1.0)
    assert got[(2021, "b")] == (0, 4, -1.0)
    best = reports.top_n(df, [F.desc("n"), F.asc("year")], 1, per=["k"])
    assert sorted((r.k, r.n) for r in best.collect()) == [("a", 15), ("b", 4)]
    assert [r.n for r in reports.top_n(df, [F.desc("n")], 2).collect()] == [15, 10]


def test_rate_measures_keep_unknown_places(spark):
    fct = spark.createDataFrame([(1,), (1,), (9,), (None,)], "neighbourhood_id int")
    dim = spark.createDataFrame([(1, "x", 500), (2, "x", 500), (3, "y", 0), (4, None, 100)], "neighbourhood_id int, area string, population_2021 int")
    got = {r.area: (r.incidents, r.population, r.per_1000) for r in reports.b3(fct, dim, ["area"]).collect()}
    assert got == {"x": (2, 1000, 2.0), "y": (None, 0, None), None: (2, 100, 20.0)}
    total = reports.b3(fct, dim).first()
    assert (total.incidents, total.population) == (4, 1100) and total.per_1000 == 4000 / 1100


def test_snapshot_operators(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "d"), (5, None)], "k int, v string")
    assert sorted(tuple(r) for r in snapshots.snapshot_diff(old, new, "k").collect()) == [(2, "changed"), (4, "changed"), (5, "added")]
    assert [tuple(r) for r in snapshots.snapshot_diff(new, old, "k").filter("change = 'removed'").collect()] == [(5, "removed")]
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    df = spark.createDataFrame([("e", 1, t1), ("e", 2, t2), ("e", 3, t2), ("f", 4, t1)], "event_id string, n int, _loaded_at timestamp")
    assert sorted(r.n for r in snapshots.latest_by_key(df, "event_id").collect()) == [2, 3, 4]
    nameless = df.withColumn("event_id", F.lit(None).cast("string"))
    assert sorted(r.n for r in snapshots.latest_by_key(nameless, "event_id").collect()) == [2, 3]
    volume = spark.createDataFrame([(m, g) for g in "ab" for m in range(12) for _ in range(50 if (m, g) == (5, "a") else 5)], "m int, g string")
    assert [(r.m, r.g) for r in snapshots.volume_check(volume, "m", ["g"]).collect()] == [(5, "a")]
