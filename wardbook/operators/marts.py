"""The star schema: three dimensions, two facts, two aggregates."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.functions.dates import date_key, iso_day_of_week, month_start
from wardbook.functions.numbers import exact_avg, rate_per_1000
from wardbook.functions.text import code_family
from wardbook.operators.reshape import calendar
from wardbook.schema import FIRST_DATE, LONG_DELAY_MINUTES, UNKNOWN_CODE


def calendar_attributes(days: DataFrame, column: str = "date_day") -> DataFrame:
    day = F.col(column)
    return days.select(
        date_key(day).alias("date_key"),
        day.alias("date_day"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_abbr"),
        month_start(day).alias("month_start"),
        iso_day_of_week(day).alias("iso_day_of_week"),
        F.date_format(day, "E").alias("day_abbr"),
        (iso_day_of_week(day) >= 6).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, today: date) -> DataFrame:
    return calendar_attributes(calendar(spark, date.fromisoformat(FIRST_DATE), today))


def dim_neighbourhood(stg_n: DataFrame, stg_p: DataFrame) -> DataFrame:
    return stg_n.join(stg_p, "neighbourhood_id", "left").select(
        "neighbourhood_id",
        "neighbourhood_name",
        "tsns_classification",
        "is_improvement_area",
        "population_2021",
        "median_income_2020",
        "households_2021",
        "geometry_geojson",
    )


def dim_delay_code(seed: DataFrame) -> DataFrame:
    return seed.select(
        "delay_code", "delay_description", "system", code_family(F.col("delay_code")).alias("code_family_hint")
    )


def fct_crime(stg: DataFrame, min_date: str = FIRST_DATE) -> DataFrame:
    """One row per offence; older occurrences, and those without a date, are left out here only."""
    return stg.filter(F.col("occurrence_date") >= F.lit(min_date).cast("date")).select(
        F.col("source_row_id").alias("crime_incident_key"),
        "event_id",
        date_key(F.col("occurrence_date")).alias("occurrence_date_key"),
        "occurrence_date",
        "occurrence_hour",
        date_key(F.col("report_date")).alias("report_date_key"),
        "report_date",
        F.datediff("report_date", "occurrence_date").alias("days_to_report"),
        "neighbourhood_id",
        "police_division",
        "mci_category",
        "offence",
        "location_type",
        "premises_type",
        "longitude",
        "latitude",
    )


def fct_delays(stg: DataFrame, dim_code: DataFrame) -> DataFrame:
    """One row per log entry. The code table's size is left to the optimizer: broadcast when its
    statistics say it is small, else a sort-merge join with AQE splitting hot codes."""
    codes = dim_code.select("delay_code", "delay_description")
    return stg.join(codes, "delay_code", "left").select(
        F.col("source_row_id").alias("ttc_delay_key"),
        date_key(F.col("delay_date")).alias("delay_date_key"),
        "delay_date",
        "delay_at",
        F.hour("delay_at").alias("delay_hour"),
        "station",
        "line",
        "line_group",
        "bound",
        "delay_code",
        F.coalesce("delay_description", F.lit(UNKNOWN_CODE)).alias("delay_description"),
        "delay_minutes",
        "gap_minutes",
        "vehicle",
    )


def agg_crime_monthly(fct: DataFrame, dim_n: DataFrame) -> DataFrame:
    """Counts first, then the dimension: the join sees one row per group, never the fact's hot keys."""
    monthly = (
        fct.filter(F.col("neighbourhood_id").isNotNull())
        .groupBy(month_start(F.col("occurrence_date")).alias("month_start"), "neighbourhood_id", "mci_category")
        .agg(F.count("*").alias("incidents"))
    )
    dim = dim_n.select("neighbourhood_id", "neighbourhood_name", "is_improvement_area", "population_2021")
    return monthly.join(dim, "neighbourhood_id").select(
        "month_start",
        "neighbourhood_id",
        "neighbourhood_name",
        "is_improvement_area",
        "mci_category",
        "incidents",
        "population_2021",
        rate_per_1000(F.col("incidents"), F.col("population_2021")).alias("incidents_per_1000"),
    )


def agg_delays_station_month(fct: DataFrame, min_minutes: int = LONG_DELAY_MINUTES) -> DataFrame:
    minutes = F.col("delay_minutes")
    return fct.groupBy(month_start(F.col("delay_date")).alias("month_start"), "station", "line").agg(
        F.count("*").alias("delay_events"),
        F.sum(minutes.cast("long")).alias("total_delay_minutes"),
        exact_avg(minutes, 2).alias("avg_delay_minutes"),
        F.max(minutes).alias("max_delay_minutes"),
        F.count_if(minutes >= min_minutes).alias("delays_10min_plus"),
    )
