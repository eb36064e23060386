from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from wardbook.functions.text import clean_ident
from wardbook.operators.reshape import unpivot_profile
from wardbook.schema import PROFILE_METRICS, SEED_LENGTHS, SEED_SCHEMA
from wardbook.sources import landing

AT = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


def texts(df):
    return [tuple(r) for r in df.drop("_loaded_at").collect()]


def land(spark, tmp_path, data, **options):
    path = tmp_path / "in.csv"
    path.write_bytes(data)
    return landing.land_csv(spark, str(path), loaded_at=AT, **options)


@pytest.mark.parametrize(
    "label, ident",
    [
        ("EVENT_UNIQUE_ID", "event_unique_id"),
        ("Min Delay", "min_delay"),
        ("2021 Pop", "c_2021_pop"),
        ("  ", "col"),
        ("", "col"),
        ("_id", "id"),
        ("é x", "x"),
    ],
)
def test_clean_ident(spark, label, ident):
    assert spark.createDataFrame([(label,)], "s string").select(clean_ident(F.col("s"))).first()[0] == ident


def test_csv_fidelity(spark, tmp_path):
    data = '﻿_id,Min Delay,2021 Pop,"  "\r\n1,,"",a\\b\r\n2,"say ""hi""", 3 ,4\r\n'.encode()
    df = land(spark, tmp_path, data)
    assert df.columns == ["id", "min_delay", "c_2021_pop", "col", "_loaded_at"]
    assert texts(df) == [("1", None, "", "a\\b"), ("2", 'say "hi"', " 3 ", "4")]
    assert df.select(F.unix_seconds("_loaded_at")).distinct().collect()[0][0] == int(AT.timestamp())


def test_csv_quoted_line_break(spark, tmp_path):
    data = b'a,b\n1,"x\ny"\n'
    assert texts(land(spark, tmp_path, data, multiline=True)) == [("1", "x\ny")]
    with pytest.raises(Exception, match="(?i)malformed"):
        land(spark, tmp_path, data).collect()


@pytest.mark.parametrize("row", [b"1,2\n", b"1,2,3,4\n"])
@pytest.mark.parametrize("action", ["collect", "count"])
def test_csv_ragged_row_fails(spark, tmp_path, row, action):
    df = land(spark, tmp_path, b"a,b,c\n1,2,3\n" + row)
    with pytest.raises(Exception, match="(?i)malformed"):
        getattr(df, action)()


def test_csv_duplicate_header_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="duplicate column names"):
        land(spark, tmp_path, b"Min Delay,min_delay\n1,2\n")


def pages(spark, tmp_path, *envelopes, **options):
    for i, envelope in enumerate(envelopes):
        (tmp_path / f"page{i}.json").write_text(envelope)
    return landing.land_pages(spark, str(tmp_path), loaded_at=AT, **options)


def test_pages_until_total(spark, tmp_path):
    df = pages(
        spark,
        tmp_path,
        '{"success": true, "result": {"records": [{"_id": 1, "Min Delay": "3"}, {"_id": 2}], "total": 3}}',
        '{"success": true, "result": {"records": [{"Min Delay": "", "_id": 3}], "total": 3}}',
    )
    assert df.columns == ["id", "min_delay", "_loaded_at"]
    assert sorted(texts(df)) == [("1", "3"), ("2", None), ("3", None)]


def test_pages_without_total_are_all_read(spark, tmp_path):
    with pytest.warns(UserWarning, match="no page states the total"):
        df = pages(spark, tmp_path, *[f'{{"success": true, "result": {{"records": [{{"a": {i}}}]}}}}' for i in range(3)])
    assert sorted(texts(df)) == [("0",), ("1",), ("2",)]


def test_page_spread_over_lines(spark, tmp_path):
    df = pages(
        spark, tmp_path, '{"success": true,\n "result": {"records": [{"a": 1}],\n "total": 1}}', whole_files=True
    )
    assert texts(df) == [("1",)]


@pytest.mark.parametrize(
    "envelope, message",
    [
        ('{"success": false, "error": {"message": "no"}}', "unsuccessful"),
        ('{"success": true, "result": {"records": [{"a": 1}], "total": 2}}', "1 records of 2"),
        ('{"success": true, "result": {"records": [{"a": 1}, {"a": 2}, {"a": 3}], "total": 2}}', "3 records of 2"),
        ("not json", "unsuccessful"),
    ],
)
def test_bad_pages_fail(spark, tmp_path, envelope, message):
    with pytest.raises(RuntimeError, match=message):
        pages(spark, tmp_path, envelope)


def test_page_record_with_an_extra_key_fails(spark, tmp_path):
    df = pages(spark, tmp_path, '{"success": true, "result": {"records": [{"a": 1}, {"a": 2, "b": 3}], "total": 2}}')
    with pytest.raises(Exception, match="unexpected keys: b"):
        df.collect()


def test_snapshot_kept_once_per_date(spark, tmp_path):
    root = str(tmp_path)
    path = landing.land_snapshot(spark.range(3), root, "major_crime_indicators", date(2026, 1, 2))
    assert path.endswith("/major_crime_indicators/snapshot_date=20260102")
    landing.land_snapshot(spark.range(9), root, "major_crime_indicators", date(2026, 1, 2))
    landing.land_snapshot(spark.range(5), root, "major_crime_indicators", date(2026, 1, 3))
    counts = spark.read.parquet(f"{root}/major_crime_indicators").groupBy("snapshot_date").count().collect()
    assert sorted(tuple(r) for r in counts) == [(20260102, 3), (20260103, 5)]


def failing(spark, columns="id string, v string"):
    """A load of which one row can't be made."""
    rows = spark.createDataFrame([(str(i), str(i)) for i in range(20)], columns)
    name = rows.columns[1]
    return rows.withColumn(name, F.when(F.col(name) == "13", F.raise_error(F.lit("bad row")).cast("string")).otherwise(F.col(name)))


def test_snapshot_after_a_crash(spark, tmp_path):
    day = date(2026, 1, 2)
    with pytest.raises(Exception, match="bad row"):
        landing.land_snapshot(failing(spark), str(tmp_path), "t", day)
    path = landing.land_snapshot(spark.range(4), str(tmp_path), "t", day)
    assert landing.land_snapshot(spark.range(9), str(tmp_path), "t", day) == path
    assert spark.read.parquet(path).count() == 4


def test_failed_load_keeps_the_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE landing_f LOCATION '{tmp_path}/landing_f'")
    landing.write_raw(spark.range(100).selectExpr("string(id) AS id", "'x' AS v"), "landing_f.a")
    for columns in ("id string, v string", "other string, v string"):
        with pytest.raises(Exception, match="bad row"):
            landing.write_raw(failing(spark, columns), "landing_f.a")
        spark.catalog.refreshTable("landing_f.a")
        assert spark.table("landing_f.a").columns == ["id", "v"] and spark.table("landing_f.a").count() == 100
    landing.materialize(spark.range(50), "landing_f.mart", "table")
    with pytest.raises(Exception, match="bad row"):
        landing.materialize(failing(spark), "landing_f.mart", "table")
    spark.catalog.refreshTable("landing_f.mart")
    assert spark.table("landing_f.mart").count() == 50


def test_csv_files_in_another_column_order_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,Full Name\n1,x\n")
    (tmp_path / "b.csv").write_text("Full Name,ID\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.land_csv(spark, str(tmp_path), loaded_at=AT).collect()
    (tmp_path / "b.csv").write_text("ID,Full Name\n2,y\n")
    df = landing.land_csv(spark, str(tmp_path), loaded_at=AT)
    assert df.columns == ["id", "full_name", "_loaded_at"] and sorted(texts(df)) == [("1", "x"), ("2", "y")]


def test_seed(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_bytes(b"delay_code,delay_description,system\r\nEUAC,Air,subway\r\nERBO,Body,srt\r\n")
    seed = landing.load_seed(spark, str(path), SEED_SCHEMA, SEED_LENGTHS)
    assert [tuple(r) for r in seed.collect()] == [("EUAC", "Air", "subway"), ("ERBO", "Body", "srt")]
    path.write_bytes(b"delay_code,delay_description,system\nABCDEFGHIJK,Air,subway\n")
    with pytest.raises(Exception, match="delay_code is too long"):
        landing.load_seed(spark, str(path), SEED_SCHEMA, SEED_LENGTHS).collect()


def test_write_raw_and_view_over_it(spark, tmp_path):
    spark.sql(f"CREATE DATABASE landing_t LOCATION '{tmp_path}/landing_t'")
    first = spark.createDataFrame([("1", "x")], "id string, v string")
    assert landing.write_raw(first, "landing_t.a")
    landing.materialize(spark.table("landing_t.a").select("id"), "staging.stg_a")
    assert not landing.write_raw(spark.createDataFrame([("2", "y"), ("3", "z")], "id string, v string"), "landing_t.a")
    assert sorted(r.id for r in spark.table("stg_a").collect()) == ["2", "3"]
    assert landing.write_raw(spark.createDataFrame([("w", "4")], "v string, id string"), "landing_t.a")
    assert spark.table("landing_t.a").columns == ["v", "id"]


def test_unpivot(spark):
    metric = PROFILE_METRICS["population_2021"]
    wide = spark.createDataFrame(
        [(f" {metric} ", 100, 200, 7), (None, None, None, None), ("Empty", None, 5, 7)],
        "m string, c1 int, c2 int, c3 int",
    )
    rows = [tuple(r) for r in unpivot_profile(wide, ["A", "B", "C"], [1, 2, None]).collect()]
    assert rows == [("1", "A", metric, "100"), ("2", "B", metric, "200"), ("1", "A", "Empty", None), ("2", "B", "Empty", "5")]
    assert unpivot_profile(wide, ["A"], [1, 2, 3]).count() == 2
