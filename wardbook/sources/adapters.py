"""The benchmark tables in the shape of the raw text tables, so that every operator runs over them.

``clean=False`` plants the faults the data tests look for; ``clean=True`` gives data that passes them.
"""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.functions.dates import floor_hour
from wardbook.schema import PROFILE_METRICS
from wardbook.sources.landing import LOADED_AT

LOADED = datetime(2024, 2, 1, 6, 0, 0, tzinfo=timezone.utc)
RAW_LINES = ["YU", " yus ", "YU/BD", "BD ", "Line 2 Bloor", "SHP", "LINE 4 SHEPPARD", "SRT"]
CATEGORY_BY_PRIORITY = ["Assault", "Auto Theft", "Break and Enter", "Robbery", "Theft Over"]
BOUNDS = ["n", "s ", "E", "W", ""]
PREMISES = ["House", "Apartment", "Commercial", "Outside", "Transit", "Other"]
CODE_LETTERS = ["U", "R", "X"]
CUSTOMERS_PER_PLACE = 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(col: Column) -> Column:
    return col.cast("string")


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def _every(key: Column, n: int) -> Column:
    return key % n == 0


def _code(number: Column) -> Column:
    return F.concat(F.lit("E"), _pick(number, CODE_LETTERS), F.lpad(_text(number), 2, "0"))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, moved back by a 30-day stretch for every 15 users (up to 100 stretches), so that a
    larger table is a longer log rather than a denser one."""
    stretch = (F.floor(F.col("user_id") / 15) % 100 * 30).cast("int")
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts") - F.make_dt_interval(stretch))


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn(LOADED_AT, F.lit(LOADED).cast("timestamp"))


def raw_delays(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    k = F.col("event_id")
    minutes = F.floor("value")
    line = _pick(k, RAW_LINES)
    return _stamp(
        event_log(spark, sf_dir).select(
            _text(k).alias("id"),
            F.substring(_text(F.col("ts")), 1, 10).alias("date"),
            F.substring(_text(F.col("ts")), 12, 5).alias("time"),
            F.date_format("ts", "EEEE").alias("day"),
            F.concat(F.lit(" Station "), _text(F.col("user_id") % 75), F.lit(" ")).alias("station"),
            F.concat(F.lower(_code(k % 60 + 1)), F.lit(" ")).alias("code"),
            F.when(_every(k, 17), "").otherwise(_text(minutes if clean else F.when(_every(k, 97), -minutes).otherwise(minutes))).alias("min_delay"),
            F.when(_every(k, 19), "").otherwise(_text(minutes + 2)).alias("min_gap"),
            _pick(k, BOUNDS).alias("bound"),
            F.when(~_every(k, 101), line).alias("line"),
            F.when(_every(k, 11), "  ").otherwise(_text(F.col("user_id"))).alias("vehicle"),
        )
    )


def delay_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes 1 to 50, from the part sizes; log entries also use 51 to 60, which are unknown."""
    size = F.col("p_size")
    return (
        table(spark, sf_dir, "part")
        .groupBy(size)
        .agg(F.min("p_partkey").alias("first_part"))
        .select(
            _code(size).alias("delay_code"),
            F.concat(F.lit("Cause "), _text(size % 20)).alias("delay_description"),
            F.when(_every(size, 3), "srt").otherwise("subway").alias("system"),
        )
    )


def raw_crime(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    k = F.col("o_orderkey")
    occurred = F.add_months(F.col("o_orderdate").cast("date"), 216)
    lag = (k % 45).cast("int")
    reported = F.date_add(occurred, lag if clean else F.when(_every(k, 211), -1).otherwise(lag))
    place = F.floor(F.col("o_custkey") / CUSTOMERS_PER_PLACE)
    category = F.element_at(F.array(*map(F.lit, CATEGORY_BY_PRIORITY)), F.substring("o_orderpriority", 1, 1).cast("int"))
    occ_text = _text(occurred)
    if not clean:
        place = F.when(_every(k, 97), place + 1_000_000).otherwise(place)
        category = F.when(_every(k, 307), "Vandalism").otherwise(category)
        occ_text = F.when(~_every(k, 401), occ_text)
    return _stamp(
        table(spark, sf_dir, "orders").select(
            _text(k).alias("id"),
            F.concat(F.lit("GO-"), _text(F.floor(k / 2)), F.lit(" ")).alias("event_unique_id"),
            _text(reported).alias("report_date"),
            occ_text.alias("occ_date"),
            F.when(_every(k, 31), "").otherwise(_text(F.year(occurred))).alias("occ_year"),
            F.when(_every(k, 29), "").otherwise(_text(k % 24)).alias("occ_hour"),
            F.concat(F.date_format(occurred, "EEEE"), F.lit("   ")).alias("occ_dow"),
            _text((k + 5) % 24).alias("report_hour"),
            F.concat(F.lit("D"), _text(F.col("o_custkey") % 17)).alias("division"),
            F.concat(F.lit(" "), _pick(k, PREMISES[:4])).alias("location_type"),
            _pick(k, PREMISES).alias("premises_type"),
            _text(1000 + k % 7).alias("ucr_code"),
            _text(k % 3 * 100).alias("ucr_ext"),
            F.concat(category, F.lit(" "), _text(k % 4)).alias("offence"),
            F.concat(F.lit(" "), category, F.lit(" ")).alias("mci_category"),
            F.when(_every(k, 50), "NSA").when(_every(k, 53), "").otherwise(_text(place)).alias("hood_158"),
            F.concat(F.lit("Place "), _text(place), F.lit(" ")).alias("neighbourhood_158"),
            F.when(_every(k, 37), "").otherwise(F.concat(F.lit("-79."), F.lpad(_text(k % 10000), 4, "0"))).alias("long_wgs84"),
            F.when(_every(k, 37), "").otherwise(F.concat(F.lit("43."), F.lpad(_text(k * 7 % 10000), 4, "0"))).alias("lat_wgs84"),
        )
    )


def raw_neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return _stamp(
        table(spark, sf_dir, "supplier").select(
            _text(k).alias("area_short_code"),
            F.concat(F.lit(" "), "s_name", F.lit(" ")).alias("area_name"),
            F.when(_every(F.col("s_nationkey"), 3), "Neighbourhood Improvement Area ")
            .when(F.col("s_nationkey") % 3 == 1, "Emerging Neighbourhood")
            .when(F.col("s_nationkey") != 2, "Not an NIA or Emerging Neighbourhood")
            .alias("classification"),
            F.concat(F.lit('{"type": "Point", "coordinates": [-79.'), _text(k), F.lit(", 43.7]}")).alias("geometry"),
        )
    )


def raw_profiles(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    """One row per customer: 15 metrics for each place, three of which are used, in several rows."""
    k = F.col("c_custkey")
    place, j = F.floor(k / CUSTOMERS_PER_PLACE), k % CUSTOMERS_PER_PLACE
    population = F.concat(_text(j * 100 + place * 37 % 500 + 3), F.when(j == 10, ".5").otherwise(""))
    if not clean:
        population = F.when(_every(place + 1, 23), "0").when(_every(place + 1, 19), "").otherwise(population)
    income = _text(30000 + place * 113 % 50000 + j)
    number = place if clean else F.when(_every(place + 1, 29), place + 1_000_000).otherwise(place)
    return _stamp(
        table(spark, sf_dir, "customer").select(
            _text(number).alias("neighbourhood_number"),
            F.concat(F.lit("Place "), _text(place)).alias("neighbourhood_name"),
            F.when(j.isin(0, 5, 10), PROFILE_METRICS["population_2021"])
            .when(j.isin(1, 6), PROFILE_METRICS["median_income_2020"])
            .when(j == 2, PROFILE_METRICS["households_2021"])
            .otherwise(F.concat(F.lit("Other metric "), _text(j)))
            .alias("metric"),
            F.when(j.isin(0, 5, 10), population)
            .when(j.isin(1, 6), income)
            .when(j == 2, _text(100 + place * 7 % 400))
            .otherwise(F.col("c_mktsegment"))
            .alias("value"),
        )
    )


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hour with events, two days late: the first days lack weather, as do some readings."""
    m = F.col("m")
    return (
        event_log(spark, sf_dir)
        .groupBy((floor_hour(F.col("ts")) + F.expr("interval 2 days")).alias("hour"))
        .agg(F.min("event_id").alias("m"))
        .select(
            "hour",
            F.when(m % 41 != 0, m % 400 / 10.0 - 10.0).cast("double").alias("temperature_2m"),
            (m % 50 / 10.0).cast("double").alias("precipitation"),
            F.when(m % 43 != 0, m % 7).cast("double").alias("snowfall"),
            (m % 300 / 10.0).cast("double").alias("wind_speed_10m"),
        )
    )


def weather_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same weather as parallel arrays, one row per day: at most 24 readings each."""
    values = ["temperature_2m", "precipitation", "snowfall", "wind_speed_10m"]
    row = F.struct(F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"), *values)
    return (
        weather_hourly(spark, sf_dir)
        .groupBy(F.col("hour").cast("date").alias("day"))
        .agg(F.collect_list(row).alias("rows"))
        .select("day", F.struct(*[F.col(f"rows.{n}").alias(n) for n in ("time", *values)]).alias("hourly"))
    )


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    override = [None, '{"snowfall": 4}', '{"snowfall": "2.5", "humidity": 9}', '{"precipitation": "wet"}', "not json", ""]
    return event_log(spark, sf_dir).select(
        k.alias("request_id"),
        _pick(k, ["YU", "BD", "SHP", "XX"]).alias("line"),
        F.col("ts").alias("at"),
        _pick(F.floor(k / 4), override).alias("weather"),
    )
