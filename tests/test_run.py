import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from wardbook.plans import run
from wardbook.plans.queries import _csv, _pages, _published_delays, Tables
from wardbook.schema import FEATURES

SF = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 2, 1, 6, tzinfo=dt.timezone.utc)
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no benchmark tables")


def inputs(t, root):
    return {
        "crime": _csv(t.raw_crime, f"{root}/crime"),
        "ttc": _pages(_published_delays(t), "_id", f"{root}/ttc"),
        "neighbourhoods": _csv(t.raw_neighbourhoods, f"{root}/neighbourhoods"),
        "profiles": _csv(t.raw_profiles, f"{root}/profiles"),
        "codes": _csv(t.codes, f"{root}/codes"),
    }


def databases(spark, tmp_path, name):
    for layer in ("raw", "marts"):
        spark.sql(f"CREATE DATABASE {name}_{layer} LOCATION '{tmp_path}/{layer}'")
    return {"raw": f"{name}_raw", "schema": f"{name}_marts"}


def test_whole_run(spark, tmp_path):
    t = Tables(spark, SF, clean=True)
    out, files, names = f"{tmp_path}/out", inputs(t, tmp_path), databases(spark, tmp_path, "whole")
    results = run.run_all(
        spark, files, today=dt.date(2024, 6, 30), loaded_at=AT, weather=t.weather, out=out, days=7,
        maxIter=2, maxDepth=2, **names,
    )
    landed = {r.table_name: (r.n_rows, r.shape_changed) for r in results["landed"].collect()}
    assert landed["ttc_subway_delays"] == (1000, True) and landed["major_crime_indicators"] == (1500, True)
    assert results["checks"].filter("status = 'pass'").count() == 41
    record = json.loads(results["metrics"].toJSON().first())
    assert record["features"] == FEATURES and record["trained_at"] == "2024-02-01T06:00:00+00:00"
    assert set(record["model"]) == {"roc_auc", "pr_auc", "brier"}
    assert {"baseline_line_weekday_hour", "experiment_with_recent_history", "rows_train", "rows_test", "test_from"} <= set(record)
    assert pathlib.Path(out, "model").exists()

    # The next day's run finds the tables in place, and its views and tests still work.
    later = AT + dt.timedelta(days=1)
    again = run.run_all(
        spark, files, today=dt.date(2024, 7, 1), loaded_at=later, steps=("land", "tests"), **names
    )
    assert {r.shape_changed for r in again["landed"].collect()} == {False}
    stamps = again["stg_ttc_delays"].select(F.unix_seconds("_loaded_at")).distinct().collect()
    assert [r[0] for r in stamps] == [int(later.timestamp())]
    assert again["checks"].filter("status = 'pass'").count() == 41


def test_failed_checks_stop_the_run(spark, tmp_path):
    t = Tables(spark, SF)
    with pytest.raises(RuntimeError, match="failed checks: .*accepted_values"):
        run.run_all(
            spark, inputs(t, tmp_path), today=dt.date(2024, 6, 30), loaded_at=AT, weather=t.weather, out=f"{tmp_path}/out",
            **databases(spark, tmp_path, "dirty"),
        )
    assert not pathlib.Path(tmp_path, "out").exists()


def test_one_dataset(spark, tmp_path):
    t = Tables(spark, SF, clean=True)
    results = run.run_all(
        spark, {"profiles": _csv(t.raw_profiles, f"{tmp_path}/p")}, today=dt.date(2024, 6, 30), loaded_at=AT,
        only=["profiles"], steps=("land",), **databases(spark, tmp_path, "one"),
    )
    assert [r.table_name for r in results["landed"].collect()] == ["neighbourhood_profiles"]
