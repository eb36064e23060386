"""Unpivot, conditional pivot, calendar and hour spines."""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.functions.numbers import as_numeric, numeric_to_int
from wardbook.functions.text import blank_to_null, strip_text

# Rows of a finished grid that one task should make.
_ROWS_PER_TASK = 1 << 20


def unpivot_profile(wide: DataFrame, names: list, numbers: list) -> DataFrame:
    """Metrics as rows and neighbourhoods as columns, to one row per neighbourhood and metric.

    ``names`` and ``numbers`` are the two header rows; columns beyond the shorter of them, columns
    without a number and rows without a metric are skipped. Null values stay.
    """
    metric, *values = wide.columns
    columns = [
        F.struct(
            F.lit(str(number)).alias("neighbourhood_number"),
            F.lit(name).cast("string").alias("neighbourhood_name"),
            F.col(f"`{column}`").cast("string").alias("value"),
        )
        for column, name, number in zip(values, names, numbers)
        if number is not None
    ]
    return (
        wide.filter(F.col(f"`{metric}`").isNotNull())
        .select(strip_text(F.col(f"`{metric}`").cast("string")).alias("metric"), F.explode(F.array(*columns)).alias("c"))
        .select("c.neighbourhood_number", "c.neighbourhood_name", "metric", "c.value")
    )


def pivot_metrics(long: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """One integer column per wanted metric; only wanted metrics' values are cast."""
    value = blank_to_null(F.col("value"))
    return long.groupBy(F.col("neighbourhood_number").cast("int").alias("neighbourhood_id")).agg(
        *[
            numeric_to_int(F.max(F.when(F.col("metric") == metric, as_numeric(value)))).alias(alias)
            for alias, metric in metrics.items()
        ]
    )


def calendar(spark: SparkSession, start: date, today: date) -> DataFrame:
    """One row per day from ``start`` through the end of the year after ``today``."""
    end = date(today.year + 1, 12, 31)
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_day"))


def hour_spine(dates: DataFrame, column: str = "delay_date", keys: int = 1, days_known: int = 3653) -> DataFrame:
    """Every hour from the first day's 00:00 to the last day's 23:00.

    The days are spread over tasks before their hours are made, by the rows that ``keys`` values an hour over
    about ``days_known`` days give, or the cluster's cores if they are more; an explicit number keeps AQE from
    drawing the few day rows, and so all later hours and keys, back into one task.
    """
    cores = min(dates.sparkSession.sparkContext.defaultParallelism, days_known)
    spread = max(cores, -(-days_known * 24 * keys // _ROWS_PER_TASK))
    bounds = dates.agg(F.min(column).alias("d0"), F.max(column).alias("d1"))
    days = bounds.select(F.explode(F.sequence("d0", "d1")).alias("day")).repartition(spread, "day")
    return days.select(F.explode(_hours_of("day")).alias("hour"))


def _hours_of(day: str) -> Column:
    midnight = F.col(day).cast("timestamp_ntz")
    return F.sequence(midnight, midnight + F.expr("interval 23 hours"), F.expr("interval 1 hour"))


def key_hours(log: DataFrame, key: str, column: str = "delay_date") -> DataFrame:
    """Every hour of the log's days for every value of ``key`` in it, however many there are.

    The distinct values stay where the cluster has them; only their number and the number of days are fetched, to
    spread keys and days over tasks by the rows to make before hours are unnested.
    """
    keys = log.select(key).filter(F.col(key).isNotNull()).distinct()
    bounds = log.agg(F.min(column).alias("d0"), F.max(column).alias("d1"))
    n_days = bounds.select(F.coalesce(F.datediff("d1", "d0") + 1, F.lit(0))).first()[0]
    spread = max(1, -(-keys.count() * n_days * 24 // _ROWS_PER_TASK), min(log.sparkSession.sparkContext.defaultParallelism, n_days))
    span = bounds.select(F.struct("d0", "d1")).scalar()
    days = keys.withColumn("span", span).select(key, F.explode(F.sequence("span.d0", "span.d1")).alias("day"))
    return days.repartition(spread, key, "day").select(F.explode(_hours_of("day")).alias("hour"), key)


def line_hours(hours: DataFrame, lines: list[str], name: str = "line") -> DataFrame:
    """Every hour for every line, by unnesting the fixed line list rather than joining."""
    return hours.select("hour", F.explode(F.array(*map(F.lit, lines))).alias(name))
