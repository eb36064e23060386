"""Report queries and measures over the marts.

A measure takes the columns to show it by; facts are counted by key before a dimension joins, so joins
see one row per key. Results are unordered unless the order is the feature: sort where they are shown.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardbook.operators.marts import agg_delays_station_month
from wardbook.schema import LONG_DELAY_MINUTES



def _minutes() -> Column:
    return F.sum(F.col("delay_minutes").cast("long"))


def star_crime(fct: DataFrame, dim_date: DataFrame, dim_n: DataFrame) -> DataFrame:
    """Incidents, or better their counts by key, with calendar and neighbourhood attributes, without the
    bulky geometry."""
    place = bi_columns(dim_n)
    return fct.join(dim_date, fct["occurrence_date_key"] == dim_date["date_key"], "left").join(
        place, "neighbourhood_id", "left"
    )


def star_delays(fct: DataFrame, dim_date: DataFrame, dim_code: DataFrame) -> DataFrame:
    codes = dim_code.select("delay_code", "system", "code_family_hint")
    return fct.join(dim_date, fct["delay_date_key"] == dim_date["date_key"], "left").join(codes, "delay_code", "left")


def bi_columns(dim_n: DataFrame) -> DataFrame:
    return dim_n.drop("geometry_geojson")


def top_n(df: DataFrame, by: Sequence[Column], n: int, per: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows in the order ``by``, of the whole or per group. Make ``by`` a total order."""
    if not per:
        return df.orderBy(*by).limit(n)
    rank = F.row_number().over(W.partitionBy(*per).orderBy(*by))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def yoy(df: DataFrame, year_col: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Each year's value, the previous year's and the relative change; the change is null without a
    previous value. A year that follows a counted one appears with 0 even if nothing happened in it."""
    zero = F.lit(0).cast(df.schema[value].dataType)
    now = df.select(*keys, year_col, value, zero.alias("previous"))
    later = df.select(*keys, (F.col(year_col) + 1).alias(year_col), zero.alias(value), F.col(value).alias("previous"))
    return (
        now.unionByName(later)
        .groupBy(*keys, year_col)
        .agg(F.sum(value).alias(value), F.sum("previous").alias("previous"))
        .withColumn(
            "change",
            (F.col(value) - F.col("previous")).cast("double") / F.nullif(F.col("previous").cast("double"), F.lit(0.0)),
        )
    )


def b1(fct: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Incidents."""
    return fct.groupBy(*by).agg(F.count("*").alias("incidents"))


def b2(dim_n: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Population: of the neighbourhoods, whether or not anything happened in them."""
    return dim_n.groupBy(*by).agg(F.sum(F.col("population_2021").cast("long")).alias("population"))


def b3(fct: DataFrame, dim_n: DataFrame, by: Sequence[str] = (), total: bool = False) -> DataFrame:
    """Incidents per 1000 by neighbourhood attributes; incidents in no known neighbourhood show under
    null, without a population. With no columns, all incidents over all population. ``total`` adds that row
    to the others, from the same counts, and ``is_total`` to tell it."""
    if not by:
        counts = fct.agg(F.count("*").alias("incidents"))
    else:
        counts = fct.groupBy("neighbourhood_id").agg(F.count("*").alias("incidents"))
        place = dim_n.select("neighbourhood_id", *[c for c in by if c != "neighbourhood_id"], F.lit(True).alias("_known"))
        shown = [F.when(F.col("_known"), F.col(c)).alias(c) for c in by]
        counts = counts.join(place, "neighbourhood_id", "left").select(*shown, "incidents")
    none = F.lit(None).cast("long")
    both = counts.withColumn("population", none).unionByName(
        dim_n.select(*by, none.alias("incidents"), F.col("population_2021").cast("long").alias("population"))
    )
    sums = [F.sum("incidents").alias("incidents"), F.sum("population").alias("population")]
    if total:
        level = F.grouping_id().alias("_level")
        groups = both.rollup(*by).agg(*sums, level).filter(F.col("_level").isin(0, 2 ** len(by) - 1))
        groups = groups.withColumn("is_total", F.col("_level") > 0).drop("_level")
    else:
        groups = both.groupBy(*by).agg(*sums)
    return groups.withColumn("per_1000", F.col("incidents") * 1000.0 / F.nullif(F.col("population"), F.lit(0)))


def b4(fct: DataFrame, dim_date: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Incidents and their year-over-year change, for the calendar's years."""
    days = fct.groupBy("occurrence_date_key", *by).agg(F.count("*").alias("n"))
    calendar = dim_date.select("date_key", "year")
    yearly = (
        days.join(calendar, days["occurrence_date_key"] == calendar["date_key"])
        .groupBy("year", *by)
        .agg(F.sum("n").alias("incidents"))
    )
    return yoy(yearly, "year", "incidents", by).join(calendar.select("year").distinct(), "year", "left_semi")


def b5(fct: DataFrame, by: Sequence[str] = (), min_minutes: int = LONG_DELAY_MINUTES) -> DataFrame:
    minutes = F.col("delay_minutes")
    return fct.groupBy(*by).agg(
        F.count("*").alias("delay_events"),
        _minutes().alias("delay_minutes"),
        F.avg(minutes).alias("avg_delay_minutes"),
        F.count_if(minutes >= min_minutes).alias("delays_10min_plus"),
    )


def b6(fct: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Incidents by month and category."""
    days = b1(fct, ["occurrence_date_key", "mci_category"])
    months = dim_date.select("date_key", "month_start")
    return (
        days.join(months, days["occurrence_date_key"] == months["date_key"], "left")
        .groupBy("month_start", "mci_category")
        .agg(F.sum("incidents").alias("incidents"))
    )


def b7(fct: DataFrame, dim_n: DataFrame, n: int = 15) -> DataFrame:
    """The neighbourhoods with the highest rate, with population and improvement flag. One without a
    rate (no incidents or no population) has nothing to show."""
    rates = b3(fct, dim_n, ["neighbourhood_id", "neighbourhood_name", "is_improvement_area"])
    return top_n(rates.filter("per_1000 is not null"), [F.desc("per_1000"), F.asc("neighbourhood_id")], n)


def b8(fct: DataFrame) -> DataFrame:
    """Matrix of delay minutes in its long form: a row per station and month (yyyy-MM), all months."""
    return fct.groupBy("station", F.date_format("delay_date", "yyyy-MM").alias("month")).agg(_minutes().alias("delay_minutes"))


def b8_wide(fct: DataFrame, months: Sequence[str]) -> DataFrame:
    """The matrix itself: stations down, the given months across."""
    return b8(fct).groupBy("station").pivot("month", list(months)).agg(F.first("delay_minutes"))


def b9(fct: DataFrame) -> DataFrame:
    """Delay minutes by cause."""
    return fct.groupBy("delay_description").agg(_minutes().alias("delay_minutes"))


def b10(fct: DataFrame) -> DataFrame:
    """Delays by hour of day."""
    return fct.groupBy("delay_hour").agg(F.count("*").alias("delay_events"))


def b11(fct: DataFrame, category: str) -> DataFrame:
    """One category per year and its change, for the years with incidents."""
    yearly = (
        fct.filter(F.col("mci_category") == category)
        .groupBy(F.year("occurrence_date").alias("year"))
        .agg(F.count("*").alias("incidents"))
    )
    return yoy(yearly, "year", "incidents").filter("incidents > 0")


def b12(fct: DataFrame, dim_n: DataFrame) -> DataFrame:
    """Rate per 1000 by year and neighbourhood."""
    yearly = (
        fct.filter(F.col("neighbourhood_id").isNotNull())
        .groupBy(F.year("occurrence_date").alias("year"), "neighbourhood_id")
        .agg(F.count("*").alias("incidents"))
    )
    place = dim_n.select("neighbourhood_id", "neighbourhood_name", "population_2021")
    rate = F.col("incidents") * 1000.0 / F.nullif(F.col("population_2021"), F.lit(0))
    return yearly.join(place, "neighbourhood_id").withColumn("per_1000", rate)


def b13(fct: DataFrame, since: str, n: int = 1) -> DataFrame:
    """The causes with the most delay minutes since a date."""
    causes = (
        fct.filter(F.col("delay_date") >= F.lit(since).cast("date"))
        .groupBy("delay_description")
        .agg(F.count("*").alias("delay_events"), _minutes().alias("delay_minutes"))
    )
    return top_n(causes, [F.desc_nulls_last("delay_minutes"), F.asc("delay_description")], n)


def b14(fct: DataFrame, n: int = 1) -> DataFrame:
    """The stations with the most delay minutes on each line."""
    stations = fct.groupBy("line_group", "station").agg(_minutes().alias("delay_minutes"))
    return top_n(stations, [F.desc_nulls_last("delay_minutes"), F.asc("station")], n, per=["line_group"])


def b15(fct: DataFrame, days: int = 30) -> DataFrame:
    """Share of incidents reported more than ``days`` days after they occurred."""
    late = F.count_if(F.col("days_to_report") > days)
    return fct.agg(
        F.count("*").alias("incidents"),
        late.alias("late"),
        (late / F.nullif(F.count("*"), F.lit(0))).alias("share_late"),
    )


def b16(agg: DataFrame, n: int = 10) -> DataFrame:
    """The station-months with the most delay minutes. Ties go by month, station and line."""
    keys = [F.asc("month_start"), F.asc("station"), F.asc("line")]
    return top_n(agg, [F.desc_nulls_last("total_delay_minutes"), *keys], n)


def worst_station_months(fct: DataFrame, n: int = 10) -> DataFrame:
    return b16(agg_delays_station_month(fct), n)
