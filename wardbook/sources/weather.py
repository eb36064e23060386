"""Hourly weather: payload to rows, coverage, and the forecast hour of a request."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.functions.dates import floor_hour
from wardbook.schema import WEATHER_VARS


def weather_rows(payload: DataFrame, column: str = "hourly") -> DataFrame:
    """Parallel arrays ``{time: [...], <variable>: [...]}`` to one row per hour."""
    arrays = F.arrays_zip(*[F.col(f"{column}.{name}") for name in ("time", *WEATHER_VARS)])
    return payload.select(F.explode(arrays).alias("row")).select(
        F.col("row.time").cast("timestamp_ntz").alias("hour"),
        *[F.col(f"row.{name}").cast("double").alias(name) for name in WEATHER_VARS],
    )


def one_per_hour(weather: DataFrame) -> DataFrame:
    """The weather by hour; reading an hour that has two rows is an error, since joins would repeat rows."""
    by_hour = weather.groupBy("hour").agg(*[F.first(n).alias(n) for n in WEATHER_VARS], F.count("*").alias("_rows"))
    repeated = F.raise_error(F.concat(F.lit("more than one weather row at "), F.col("hour").cast("string")))
    return by_hour.select(
        "hour", *[F.when(F.col("_rows") > 1, repeated).otherwise(F.col(n)).cast("double").alias(n) for n in WEATHER_VARS]
    )


def weather_coverage(weather: DataFrame, hours: DataFrame) -> DataFrame:
    """One row: is the stored weather enough, judged by the days of its first and last hour?"""
    have = weather.agg(F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"))
    start = hours.agg(F.min("hour").cast("date").cast("timestamp_ntz")).scalar()
    end = hours.agg(F.max("hour").cast("date").cast("timestamp_ntz")).scalar()
    covered = (F.col("first_hour") <= start) & (F.col("last_hour") >= end)
    return have.select("first_hour", "last_hour", F.coalesce(covered, F.lit(False)).alias("covered"))


def weather_gaps(weather: DataFrame, hours: DataFrame) -> DataFrame:
    """Hours without a weather row."""
    return hours.select("hour").join(weather.select("hour"), "hour", "left_anti")


def forecast_at(requests: DataFrame, forecast: DataFrame) -> DataFrame:
    """Each request with the forecast of its hour; ``has_forecast`` is false outside the window.

    The hour counts as covered only when all four variables are present.
    """
    values = one_per_hour(forecast).withColumnRenamed("hour", "at")
    joined = requests.withColumn("at", floor_hour(F.col("at"))).join(values, "at", "left")
    complete = F.lit(True)
    for name in WEATHER_VARS:
        complete = complete & F.col(name).isNotNull()
    return joined.withColumn("has_forecast", complete)
