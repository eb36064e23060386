import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardbook.functions import dates, numbers
from wardbook.operators import marts, reshape, staging
from wardbook.schema import PROFILE_METRICS

CRIME = (
    "id event_unique_id report_date occ_date occ_year occ_hour occ_dow report_hour division location_type premises_type "
    "ucr_code ucr_ext offence mci_category hood_158 neighbourhood_158 long_wgs84 lat_wgs84"
).split()
DELAYS = "id date time day station code min_delay min_gap bound line vehicle".split()


def raw(spark, columns, *rows, **defaults):
    data = [tuple({**defaults, **r}.get(c) for c in columns) for r in rows]
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame(data, schema).withColumn("_loaded_at", F.lit("2026-01-01 00:00:00").cast("timestamp"))


def crime(spark, *rows):
    return raw(spark, CRIME, *rows, id="1", report_date="2015-02-03", occ_date="2015-02-01", hood_158="7")


def test_stg_crime(spark):
    got = staging.stg_crime(
        crime(
            spark,
            {"hood_158": "NSA", "occ_hour": "", "mci_category": " Assault "},
            {"hood_158": "", "occ_hour": " 5 ", "long_wgs84": "-79.25", "lat_wgs84": ""},
            {"hood_158": None},
            {"hood_158": " 12 ", "occ_year": "2015"},
        )
    ).collect()
    assert [r.neighbourhood_id for r in got] == [None, None, None, 12]
    assert [r.occurrence_hour for r in got] == [None, 5, None, None]
    assert got[0].mci_category == "Assault" and got[1].longitude == -79.25 and got[1].latitude is None
    assert got[3].occurrence_year == 2015 and got[0].report_date == dt.date(2015, 2, 3)
    assert len(got[0]) == 20


@pytest.mark.parametrize("bad", [{"id": "x"}, {"occ_hour": "12.0"}, {"occ_date": "2015-02"}, {"occ_date": "1/2/2015"}, {"hood_158": "n/a"}])
def test_strict_casts_fail_on_read(spark, bad):
    with pytest.raises(Exception):
        staging.stg_crime(crime(spark, bad)).collect()


def test_bad_values(spark):
    df = crime(spark, {"occ_hour": "noon", "occ_date": "2015-02"}, {"occ_hour": "", "hood_158": "NSA"}, {"occ_hour": "7", "id": "a1"})
    found = staging.bad_values(df, staging.CRIME_TYPES).filter("n_bad > 0")
    assert sorted((r.column_name, r.n_bad, r.example) for r in found.collect()) == [
        ("id", 1, "a1"),
        ("occ_date", 1, "2015-02"),
        ("occ_hour", 1, "noon"),
    ]


@pytest.mark.parametrize("kind, column", [("crime", c) for c in staging.CRIME_TYPES] + [("delays", c) for c in staging.DELAY_TYPES])
def test_reported_are_the_values_that_staging_rejects(spark, kind, column):
    values = ["", " ", "7", "x", "2015-02", "2015-02-03T10:00:00", "25:61", "NSA", None]
    bad = []
    for v in values:
        if kind == "crime":
            df, stage, types = crime(spark, {column: v}), staging.stg_crime, staging.CRIME_TYPES
        else:
            df = raw(spark, DELAYS, {"date": "2025-03-09", "time": "02:30", "min_delay": "", "min_gap": "", "id": "1", column: v})
            stage, types = staging.stg_delays, staging.DELAY_TYPES
        try:
            stage(df).collect()
            fails = False
        except Exception:
            fails = True
        reported = staging.bad_values(df, types).filter("n_bad > 0").count() > 0
        if reported != fails:
            bad.append((v, reported, fails))
    assert bad == []


def test_stg_delays(spark):
    lines = ["YU", "yus ", "YU/BD", "LINE 1 X", "Line 2 Bloor-Danforth", "BD", "LINE 4", "SHP", None]
    df = raw(spark, DELAYS, *[{"line": x} for x in lines], id="1", date="2025-03-09", time="02:30", bound="", vehicle="  ", min_delay="", station=" a b ")
    got = staging.stg_delays(df).collect()
    assert [r.line_group for r in got] == ["YU", "YU", "YU", "YU", "BD", "BD", "OTHER", "SHP", "OTHER"]
    assert got[0].delay_at == dt.datetime(2025, 3, 9, 2, 30)
    assert (got[0].bound, got[0].vehicle, got[0].delay_minutes, got[0].station) == (None, None, None, "A B")
    no_time = staging.stg_delays(raw(spark, DELAYS, {"id": "1", "date": "2025-03-09"})).first()
    assert no_time.delay_at is None


def test_stg_neighbourhoods(spark):
    df = raw(
        spark,
        ["area_short_code", "area_name", "classification", "geometry"],
        {"area_short_code": "1", "area_name": " A ", "classification": "Neighbourhood Improvement Area"},
        {"area_short_code": "2", "classification": " Neighbourhood Improvement Area"},
        {"area_short_code": "3"},
    )
    got = staging.stg_neighbourhoods(df).collect()
    assert [r.is_improvement_area for r in got] == [True, False, None] and got[0].neighbourhood_name == "A"


def test_profile_pivot(spark):
    pop, income = PROFILE_METRICS["population_2021"], PROFILE_METRICS["median_income_2020"]
    df = spark.createDataFrame(
        [("1", pop, "12.5"), ("1", pop, ""), ("1", "Other", "n/a"), ("2", "Other", "x"), ("3", income, "12.49999999")],
        "neighbourhood_number string, metric string, value string",
    )
    got = {r.neighbourhood_id: (r.population_2021, r.median_income_2020, r.households_2021) for r in reshape.pivot_metrics(df, PROFILE_METRICS).collect()}
    assert got == {1: (13, None, None), 2: (None, None, None), 3: (None, 12, None)}


def test_fact_filter_and_keys(spark):
    stg = staging.stg_crime(crime(spark, {"occ_date": "2013-12-31"}, {"id": "2", "occ_date": "2014-01-01", "report_date": "2014-01-31"}, {"occ_date": None}))
    rows = marts.fct_crime(stg).collect()
    assert [(r.crime_incident_key, r.occurrence_date_key, r.report_date_key, r.days_to_report) for r in rows] == [(2, 20140101, 20140131, 30)]


def test_fct_delays_unknown_code(spark):
    stg = staging.stg_delays(raw(spark, DELAYS, {"code": " euac "}, {"code": "ZZ"}, {"code": None}, id="1", date="2025-01-01", time="10:05"))
    codes = marts.dim_delay_code(spark.createDataFrame([("EUAC", "Air", "subway")], "delay_code string, delay_description string, system string"))
    got = sorted((r.delay_code or "", r.delay_description, r.delay_hour) for r in marts.fct_delays(stg, codes).collect())
    assert got == [("", "Unknown code", 10), ("EUAC", "Air", 10), ("ZZ", "Unknown code", 10)]
    assert [r.code_family_hint for r in codes.collect()] == ["Equipment"]


def test_crime_aggregate(spark):
    day = dt.date(2015, 2, 9)
    fct = spark.createDataFrame([(day, 1, "Assault")] * 2 + [(day, 2, "Assault"), (day, 3, "Assault"), (day, 9, "Assault"), (day, None, "Assault")], "occurrence_date date, neighbourhood_id int, mci_category string")
    dim = spark.createDataFrame([(1, "A", True, 3), (2, "B", False, 0), (3, "C", None, None)], "neighbourhood_id int, neighbourhood_name string, is_improvement_area boolean, population_2021 int")
    got = {r.neighbourhood_id: (r.incidents, r.incidents_per_1000) for r in marts.agg_crime_monthly(fct, dim).collect()}
    assert got == {1: (2, Decimal("666.667")), 2: (1, None), 3: (1, None)}


def test_delay_aggregate(spark):
    day = dt.date(2025, 1, 5)
    minutes = [None, 9, 10, 10, 10, 10, 10, 10]
    fct = spark.createDataFrame([(day, "S", "YU", m) for m in minutes] + [(day, "T", None, None)], "delay_date date, station string, line string, delay_minutes int")
    got = {r.station: tuple(r)[3:] for r in marts.agg_delays_station_month(fct).collect()}
    assert got == {"S": (8, 69, Decimal("9.86"), 10, 6), "T": (1, None, None, None, 0)}


def test_exact_average_rounds_once(spark):
    # 535 / 200 = 2.675 rounds up; 2.67499 must not.
    df = spark.createDataFrame([(1, 535)] + [(1, 0)] * 199 + [(2, 267499)] + [(2, 0)] * 99999, "k int, v int")
    got = {r.k: r.a for r in df.groupBy("k").agg(numbers.exact_avg(F.col("v"), 2).alias("a")).collect()}
    assert got == {1: Decimal("2.68"), 2: Decimal("2.67")}


def test_calendar(spark):
    cal = marts.dim_date(spark, dt.date(2026, 9, 22))
    assert cal.count() == (dt.date(2027, 12, 31) - dt.date(2014, 1, 1)).days + 1
    row = cal.filter("date_day = date'2026-09-20'").first()
    assert tuple(row) == (20260920, dt.date(2026, 9, 20), 2026, 3, 9, "Sep", dt.date(2026, 9, 1), 7, "Sun", True)


def test_hours_ignore_clock_changes(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        days = spark.createDataFrame([(dt.date(2026, 3, 7),), (dt.date(2026, 3, 9),)], "delay_date date")
        assert reshape.hour_spine(days).distinct().count() == 72
        ts = spark.sql("select timestamp_ntz'2026-03-08 02:31:10.5' as t")
        assert ts.select(dates.floor_hour(F.col("t")).cast("string")).first()[0] == "2026-03-08 02:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
