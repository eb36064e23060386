"""What the plans must and must not contain."""

import pathlib
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wardbook.operators import features, marts, monthly, reports, snapshots
from wardbook.plans.queries import Tables
from wardbook.sources import landing

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no benchmark tables")

# These write files or fit models before they return.
EAGER = {n for n in entry.queries() if n.startswith(("s", "m", "q10", "a6", "a10", "j7", "w3", "f24", "x4", "x2_incremental", "p11_year", "p11_weekend", "op", "pipeline"))}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - EAGER))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert [f for f in FORBIDDEN if f in text] == []


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact") / "fct")
    marts.fct_crime(Tables(spark, SF).stg_crime).write.parquet(path)
    return spark.read.parquet(path)


def test_date_filter_and_columns_reach_the_scan(fact):
    text = plan(reports.b1(fact.filter("occurrence_date >= date'2018-01-01'"), ["mci_category"]))
    assert "GreaterThanOrEqual(occurrence_date,2018-01-01)" in text
    assert "ReadSchema: struct<occurrence_date:date,mci_category:string>" in text


def test_counts_are_partial_before_the_shuffle(spark, fact):
    t = Tables(spark, SF)
    text = plan(marts.agg_crime_monthly(fact, t.dim_neighbourhood))
    assert text.index("Join") < text.index("partial_count")


def test_top_per_group_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(entry.queries()["b14_top_station"](spark, SF))


def test_top_n_keeps_n_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["b16_top_station_months"](spark, SF))


@pytest.fixture(scope="module")
def monthly_fact(spark, tmp_path_factory):
    spark.sql(f"CREATE DATABASE plans_m LOCATION '{tmp_path_factory.mktemp('monthly')}'")
    fct = monthly.with_month(marts.fct_crime(Tables(spark, SF).stg_crime), "occurrence_date")
    yield landing.materialize(fct, "plans_m.fct", "table", "occurrence_date", [monthly.MONTH])
    spark.sql("DROP DATABASE plans_m CASCADE")


def files_read(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan()
    scans = [m for m in _scans(text)]
    return sum(s.metrics().apply("numFiles").value() for s in scans)


def _scans(node):
    if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        node = node.executedPlan()
    if node.getClass().getSimpleName() == "FileSourceScanExec" and "fct" in str(node.relation().location().rootPaths()):
        yield node
    inner = [node.plan()] if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName() else []
    children = node.children()
    for child in [*inner, *(children.apply(i) for i in range(children.size()))]:
        yield from _scans(child)


def test_a_year_reads_its_own_months(monthly_fact):
    year = monthly.between(monthly_fact, "occurrence_date", date(2018, 1, 1), date(2018, 12, 31))
    text = plan(reports.b1(year, ["mci_category"]))
    assert "PartitionFilters: [isnotnull(fact_month" in text and "(fact_month" in text
    months = {f.split("fact_month=")[1][:7] for f in year.inputFiles()}
    assert files_read(reports.b1(year, ["mci_category"])) == sum("fact_month=2018" in f for f in monthly_fact.inputFiles()) > 0
    assert len(months) > 12 or months == {f"2018-{m:02}" for m in range(1, 13)}


def test_the_calendar_prunes_months(spark, monthly_fact):
    days = Tables(spark, SF).dim_date.filter("year = 2018 AND month = 3")
    found = monthly.on_days(monthly_fact, "occurrence_date_key", days).groupBy("date_day").count()
    assert "dynamicpruning" in plan(found)
    assert files_read(found) == sum("fact_month=2018-03" in f for f in monthly_fact.inputFiles()) > 0


def test_keys_of_a_grid_stay_on_the_cluster(spark, monkeypatch):
    fct = Tables(spark, SF).fct_delays
    fetched, real = [], type(fct).collect
    monkeypatch.setattr(type(fct), "collect", lambda df: fetched.append(real(df)) or fetched[-1])
    grid = features.build_grid(fct.withColumn("station", F.concat("station", F.lit("x"))), None, key="station")
    text = plan(grid)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Station 1" not in text
    assert max(map(len, fetched)) <= 1


def test_bucketed_snapshots_are_compared_in_place(spark):
    found = entry.queries()["x1_bucketed_diff"](spark, SF)
    assert found.count() > 0
    assert "Exchange" not in plan(found) and "SortMergeJoin" in plan(found) and "Exchange" in plan(entry.queries()["x1_snapshot_diff"](spark, SF))


def test_bucketed_snapshots_keep_null_keys_and_finished_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE plans_b LOCATION '{tmp_path}'")
    try:
        days = []
        for day, rows in enumerate(([(None, 1), ("", 1), ("a", 1), ("b", None)], [(None, 2), ("a", 1), ("b", 1), ("c", 1)]), 1):
            df = spark.createDataFrame(rows, "k string, v int")
            days.append(landing.land_bucketed(df, "plans_b.t", date(2024, 2, day), "k", 3))
        assert landing.land_bucketed(df.limit(0), "plans_b.t", date(2024, 2, 2), "k", 3) == days[1]
        old, new = map(spark.table, days)
        got = {tuple(r) for r in snapshots.bucketed_diff(old, new, "k").collect()}
        assert got == {(None, "changed"), ("", "removed"), ("b", "changed"), ("c", "added")}
        assert got == {tuple(r) for r in snapshots.snapshot_diff(old.select("k", "v"), new.select("k", "v"), "k").collect()}
    finally:
        spark.sql("DROP DATABASE plans_b CASCADE")
