"""The whole job in dependency order: land, seed, model, test, train."""

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.operators import features, marts, metrics, model, monthly, quality, staging
from wardbook.schema import DATASETS, FEATURES, HOLDOUT_DAYS, SEED_LENGTHS, SEED_SCHEMA
from wardbook.sources import landing, sinks

STEPS = ("land", "seed", "models", "tests", "train")


def land(spark: SparkSession, inputs: dict[str, str], only: Sequence[str] | None, loaded_at: datetime, schema: str) -> DataFrame:
    """Land the named datasets; one row each with its count and whether its shape changed."""
    results = []
    for key in only or DATASETS:
        spec = DATASETS[key]
        reader = landing.land_pages if spec.kind == "pages" else landing.land_csv
        table = f"{schema}.{spec.raw_table}"
        changed = landing.write_raw(reader(spark, inputs[key], loaded_at=loaded_at), table)
        count = spark.table(table).agg(F.count("*").alias("n_rows"))
        results.append(count.select(F.lit(spec.raw_table).alias("table_name"), "n_rows", F.lit(changed).alias("shape_changed")))
    landed = results[0]
    for other in results[1:]:
        landed = landed.unionByName(other)
    return landed


def build_models(spark: SparkSession, today: date, raw: str, schema: str, rebuild: bool = True) -> dict[str, DataFrame]:
    """Staging views and mart tables from the raw tables and the seed table. Without ``rebuild`` the
    mart tables are read as they stand."""

    def view(name, df):
        return landing.materialize(df, name)

    def table(name, df, day=None):
        # Facts are partitioned by month, and sorted by day within it, so that date filters skip folders and
        # row groups; their partition column stays beside the mart's own.
        full = f"{schema}.{name}"
        if not rebuild:
            return spark.table(full)
        if day:
            return landing.materialize(monthly.with_month(df, day), full, "table", day, [monthly.MONTH])
        return landing.materialize(df, full, "table")

    source = {d.key: spark.table(f"{raw}.{d.raw_table}") for d in DATASETS.values()}
    t = {"ttc_delay_codes": spark.table(f"{schema}.ttc_delay_codes")}
    t["stg_crime_incidents"] = view("stg_crime_incidents", staging.stg_crime(source["crime"]))
    t["stg_ttc_delays"] = view("stg_ttc_delays", staging.stg_delays(source["ttc"]))
    t["stg_neighbourhoods"] = view("stg_neighbourhoods", staging.stg_neighbourhoods(source["neighbourhoods"]))
    t["stg_neighbourhood_profiles"] = view("stg_neighbourhood_profiles", staging.stg_profiles(source["profiles"]))
    t["dim_date"] = table("dim_date", marts.dim_date(spark, today))
    t["dim_neighbourhood"] = table(
        "dim_neighbourhood", marts.dim_neighbourhood(t["stg_neighbourhoods"], t["stg_neighbourhood_profiles"])
    )
    t["dim_ttc_delay_code"] = table("dim_ttc_delay_code", marts.dim_delay_code(t["ttc_delay_codes"]))
    t["fct_crime_incidents"] = table(
        "fct_crime_incidents", marts.fct_crime(t["stg_crime_incidents"]), day="occurrence_date"
    )
    t["fct_ttc_delays"] = table(
        "fct_ttc_delays", marts.fct_delays(t["stg_ttc_delays"], t["dim_ttc_delay_code"]), day="delay_date"
    )
    t["agg_crime_monthly_neighbourhood"] = table(
        "agg_crime_monthly_neighbourhood",
        marts.agg_crime_monthly(t["fct_crime_incidents"], t["dim_neighbourhood"]),
    )
    t["agg_ttc_delays_station_month"] = table(
        "agg_ttc_delays_station_month", marts.agg_delays_station_month(t["fct_ttc_delays"])
    )
    return t


def train_model(
    fct: DataFrame, weather: DataFrame, out: str, *, trained_at: str, days: int = HOLDOUT_DAYS, **gbt
) -> DataFrame:
    """Evaluate on the held-out days beside the baseline and the history experiment, refit on all rows,
    save model and metrics under ``out``; returns the metrics as written."""
    path = f"{out}/training_frame"
    features.training_frame(fct, weather).write.mode("overwrite").parquet(path)
    frame = fct.sparkSession.read.parquet(path)
    train, test = features.time_split(frame, days)
    plain, informed, served = model.fit_each(
        [(train, FEATURES), (train, model.informed_features()), (frame, FEATURES)], **gbt
    )
    scored = {
        "model": model.predict(plain, test),
        "baseline_line_weekday_hour": features.baseline_rate(train, test),
        "experiment_with_recent_history": model.predict(informed, test),
    }
    split = features.split_instant(frame, days)
    sinks.write_metrics(metrics.metrics_row(train, test, split, scored, trained_at), f"{out}/metrics")
    sinks.save_model(served, f"{out}/model")
    return fct.sparkSession.read.json(f"{out}/metrics")


def run_all(
    spark: SparkSession,
    inputs: dict[str, str],
    *,
    today: date,
    loaded_at: datetime,
    only: Sequence[str] | None = None,
    steps: Sequence[str] = STEPS,
    raw: str = "raw",
    schema: str = "marts",
    weather: DataFrame | None = None,
    out: str | None = None,
    **train_args,
) -> dict[str, DataFrame]:
    """Run the steps in order and stop at the first failure: training only sees tested tables.

    ``inputs`` names the file or folder of each dataset key and of ``codes``; ``only`` limits landing
    to some datasets.
    """
    results: dict[str, DataFrame] = {}
    for name in (raw, schema):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    if "land" in steps:
        results["landed"] = land(spark, inputs, only, loaded_at, raw)
    if "seed" in steps:
        seed = landing.load_seed(spark, inputs["codes"], SEED_SCHEMA, SEED_LENGTHS)
        landing.materialize(seed, f"{schema}.ttc_delay_codes", "table")
    if "models" in steps or "tests" in steps:
        tables = build_models(spark, today, raw, schema, rebuild="models" in steps)
        results |= tables
    if "tests" in steps:
        landing.materialize(quality.run_checks(tables, quality.declared_checks(today)), f"{schema}.test_results", "table")
        results["checks"] = spark.table(f"{schema}.test_results")
        quality.require_passing(results["checks"])
    if "train" in steps:
        fct = spark.table(f"{schema}.fct_ttc_delays")
        results["metrics"] = train_model(fct, weather, out, trained_at=loaded_at.isoformat(timespec="seconds"), **train_args)
    return results
