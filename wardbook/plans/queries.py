"""One registered query per operator, over the benchmark tables in their raw-table shape.

Each takes a ``Tables`` and returns a frame whose work grows with those tables. Decimals leave as
doubles and load times as epoch seconds, so that any engine can compare them.
"""

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.functions import dates, numbers, text
from wardbook.operators import features, marts, metrics, model, monthly, quality, reports, reshape, score, snapshots, staging
from wardbook.plans import run
from wardbook.schema import BASELINE_KEYS, CRIME_CATEGORIES, HISTORY_FEATURES, LINES, PROFILE_METRICS, SEED_LENGTHS, SEED_SCHEMA, TARGET
from wardbook.session import scratch_path
from wardbook.sources import adapters, landing, sinks, weather

TODAY = date(2024, 6, 30)
FUTURE_AFTER = date(2019, 1, 1)
HOLDOUT = 7
REPORT_YEAR = 2018
HEADERS = {
    "id": "_id",
    "date": "Date",
    "time": "Time",
    "day": "Day",
    "station": "Station",
    "code": "Code",
    "min_delay": "Min Delay",
    "min_gap": "Min Gap",
    "bound": "Bound",
    "line": "Line",
    "vehicle": "Vehicle",
}
PAGE_SIZE = 1000

_REGISTRY: dict[str, Callable] = {}


class Tables:
    """The raw, staging and mart frames over one folder of benchmark tables, as lazy plans."""

    def __init__(self, spark: SparkSession, sf_dir: str, clean: bool = False):
        self.spark, self.sf_dir, self.clean = spark, sf_dir, clean

    def source(self, name):
        return adapters.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw_delays(self):
        return adapters.raw_delays(self.spark, self.sf_dir, self.clean)

    @cached_property
    def raw_crime(self):
        return adapters.raw_crime(self.spark, self.sf_dir, self.clean)

    @cached_property
    def raw_neighbourhoods(self):
        return adapters.raw_neighbourhoods(self.spark, self.sf_dir)

    @cached_property
    def raw_profiles(self):
        return adapters.raw_profiles(self.spark, self.sf_dir, self.clean)

    @cached_property
    def codes(self):
        return adapters.delay_codes(self.spark, self.sf_dir)

    @cached_property
    def weather(self):
        return adapters.weather_hourly(self.spark, self.sf_dir)

    @cached_property
    def requests(self):
        return adapters.score_requests(self.spark, self.sf_dir)

    @cached_property
    def stg_delays(self):
        return staging.stg_delays(self.raw_delays)

    @cached_property
    def stg_crime(self):
        return staging.stg_crime(self.raw_crime)

    @cached_property
    def stg_neighbourhoods(self):
        return staging.stg_neighbourhoods(self.raw_neighbourhoods)

    @cached_property
    def stg_profiles(self):
        return staging.stg_profiles(self.raw_profiles)

    @cached_property
    def dim_date(self):
        return marts.dim_date(self.spark, TODAY)

    @cached_property
    def dim_neighbourhood(self):
        return marts.dim_neighbourhood(self.stg_neighbourhoods, self.stg_profiles)

    @cached_property
    def dim_code(self):
        return marts.dim_delay_code(self.codes)

    @cached_property
    def fct_crime(self):
        return marts.fct_crime(self.stg_crime)

    @cached_property
    def fct_delays(self):
        return marts.fct_delays(self.stg_delays, self.dim_code)

    @cached_property
    def agg_crime(self):
        return marts.agg_crime_monthly(self.fct_crime, self.dim_neighbourhood)

    @cached_property
    def agg_delays(self):
        return marts.agg_delays_station_month(self.fct_delays)

    @cached_property
    def grid(self):
        return features.build_grid(self.fct_delays)

    @cached_property
    def frame(self):
        """The training frame as a written table: split, rates and test rows all read it."""
        return self._written(features.training_frame(self.fct_delays, self.weather, history=False), "frame")

    @cached_property
    def history_frame(self):
        return self._written(features.training_frame(self.fct_delays, self.weather), "history_frame")

    def _written(self, df, name):
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def baseline(self):
        return features.baseline_rate(*features.time_split(self.frame, HOLDOUT))

    @cached_property
    def all(self):
        return {
            "stg_crime_incidents": self.stg_crime,
            "stg_ttc_delays": self.stg_delays,
            "stg_neighbourhoods": self.stg_neighbourhoods,
            "stg_neighbourhood_profiles": self.stg_profiles,
            "ttc_delay_codes": self.codes,
            "dim_date": self.dim_date,
            "dim_neighbourhood": self.dim_neighbourhood,
            "dim_ttc_delay_code": self.dim_code,
            "fct_crime_incidents": self.fct_crime,
            "fct_ttc_delays": self.fct_delays,
            "agg_crime_monthly_neighbourhood": self.agg_crime,
            "agg_ttc_delays_station_month": self.agg_delays,
        }


def comparable(df: DataFrame) -> DataFrame:
    def out(field):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_seconds(col).alias(field.name)
        return col

    return df.select(*[out(f) for f in df.schema])


def _register(name: str, build: Callable[[Tables], DataFrame]) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Tables(spark, sf_dir)))

    query.__name__ = name
    _REGISTRY[name] = query


def query(build):
    _register(build.__name__, build)
    return build


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


def _rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


# --- Landing and sinks --------------------------------------------------------------------------


def _csv(df: DataFrame, path: str, headers: dict[str, str] | None = None) -> str:
    """Write the raw columns as published CSV: header names, blanks quoted, spaces kept."""
    headers = headers or {}
    columns = [F.col(c).alias(headers.get(c, c)) for c in df.columns if c != landing.LOADED_AT]
    writer = df.select(*columns).write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def _pages(df: DataFrame, key: str, path: str, keep_nulls: bool = True) -> str:
    """Write records as response pages of PAGE_SIZE consecutive ids each."""
    records = F.transform(F.array_sort(F.collect_list(F.struct("_at", "_record"))), lambda r: r["_record"])
    record = F.struct(*[F.col(c) for c in df.columns])
    number = F.col(f"`{key}`").cast("long")
    envelope = F.struct(
        F.lit(True).alias("success"),
        F.struct(F.col("records"), df.agg(F.count("*")).scalar().alias("total")).alias("result"),
    )
    paged = (
        df.select(number.alias("_at"), F.floor(number / PAGE_SIZE).alias("_page"), record.alias("_record"))
        .groupBy("_page")
        .agg(records.alias("records"))
    )
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    paged.select(F.to_json(envelope, options).alias("value")).write.text(path)
    return path


def _published_delays(t: Tables) -> DataFrame:
    return t.raw_delays.select(*[F.col(c).alias(h) for c, h in HEADERS.items()])


def _database(t: Tables, name: str) -> str:
    """A database of its own in the scratch folder."""
    unique = f"{name}_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {unique} LOCATION '{scratch_path(t.spark, name)}'")
    return unique


@query
def s2_land_csv(t):
    path = _csv(t.raw_delays, scratch_path(t.spark, "delays"), HEADERS)
    return landing.land_csv(t.spark, path, loaded_at=adapters.LOADED)


@query
def s3_clean_ident(t):
    ident = text.clean_ident(F.col("text"))
    return t.source("documents").select(
        "doc_id", F.md5(ident).alias("ident_md5"), F.length(ident).cast("long").alias("ident_length")
    )


@query
def s4_duplicate_idents(t):
    labels = t.source("part").select(
        F.explode(F.array(F.concat_ws(" ", "p_brand", "p_type"), F.lower(F.concat_ws("_", "p_brand", "p_type")))).alias(
            "label"
        )
    )
    return landing.duplicate_idents(labels, "label")


@query
def s5_batch_stamp(t):
    path = _csv(t.raw_crime, scratch_path(t.spark, "crime"))
    landed = landing.land_csv(t.spark, path, loaded_at=adapters.LOADED)
    stamp = F.col(landing.LOADED_AT)
    return landed.agg(F.count("*").alias("n_rows"), F.min(stamp).alias("first_stamp"), F.max(stamp).alias("last_stamp"))


@query
def s6_full_refresh(t):
    table = f"{_database(t, 'raw')}.ttc_subway_delays"
    steps = []
    for step, df in enumerate((t.raw_delays, t.raw_delays.filter("bound <> ''"), t.raw_delays.drop("vehicle"))):
        changed = landing.write_raw(df, table)
        now = t.spark.table(table)
        counted = now.agg(F.lit(step).alias("step"), F.lit(changed).alias("shape_changed"), F.count("*").alias("n_rows"))
        # Stored, since the next load replaces what is counted.
        steps.append(t._written(counted.withColumn("n_columns", F.lit(len(now.columns))), f"step_{step}"))
    return reduce(DataFrame.unionByName, steps)


@query
def s7_land_pages(t):
    path = _pages(_published_delays(t), "_id", scratch_path(t.spark, "pages"))
    return landing.land_pages(t.spark, path, loaded_at=adapters.LOADED)


@query
def s8_pinned_columns(t):
    k = F.col("event_id")
    records = t.source("events").select(
        k.alias("_id"), F.when(k % 5 == 0, "noted").alias("Note 1"), F.col("event_type").alias("Type"), "value"
    )
    path = _pages(records, "_id", scratch_path(t.spark, "pages"), keep_nulls=False)
    landed = landing.land_pages(t.spark, path, loaded_at=adapters.LOADED)
    return landed.select("id", "note_1", "type", F.col("value").cast("double").alias("value"))


@query
def s11_snapshots(t):
    root = scratch_path(t.spark, "snapshots")
    raw = t.raw_delays
    for day, df in ((1, raw), (1, raw.filter("bound = 'N'")), (2, raw.filter("bound <> ''"))):
        landing.land_snapshot(df, root, "ttc_subway_delays", date(2024, 2, day))
    landed = t.spark.read.parquet(f"{root}/ttc_subway_delays")
    return landed.groupBy("snapshot_date").agg(F.count("*").alias("n_rows"))


@query
def s12_seed(t):
    path = _csv(t.codes, scratch_path(t.spark, "codes"))
    return landing.load_seed(t.spark, path, SEED_SCHEMA, SEED_LENGTHS)


@query
def s13_materialize(t):
    schema = _database(t, "marts")
    landing.materialize(t.stg_delays, "staging.stg_ttc_delays")
    table = landing.materialize(
        marts.fct_delays(t.spark.table("stg_ttc_delays"), t.dim_code), f"{schema}.fct_ttc_delays", "table"
    )
    return reports.b5(table, ["line_group"]).select("line_group", "delay_events", "delay_minutes")


@query
def s14_weather_gaps(t):
    hours = reshape.hour_spine(t.stg_delays)
    return weather.weather_gaps(t.weather, hours)


@query
def s14_weather_coverage(t):
    return weather.weather_coverage(t.weather, reshape.hour_spine(t.stg_delays))


@query
def s15_weather_rows(t):
    return weather.weather_rows(adapters.weather_payload(t.spark, t.sf_dir))


@query
def s16_forecast_pick(t):
    return weather.forecast_at(t.requests, t.weather).drop("weather")


@query
def s17_metrics_sink(t):
    path = scratch_path(t.spark, "metrics")
    sinks.write_metrics(_rounded(metrics.evaluate(t.baseline), "roc_auc", "pr_auc", "brier"), path)
    return t.spark.read.json(path)


def _run_inputs(t: Tables) -> dict[str, str]:
    return {
        "crime": _csv(t.raw_crime, scratch_path(t.spark, "crime")),
        "ttc": _pages(_published_delays(t), "_id", scratch_path(t.spark, "ttc")),
        "neighbourhoods": _csv(t.raw_neighbourhoods, scratch_path(t.spark, "neighbourhoods")),
        "profiles": _csv(t.raw_profiles, scratch_path(t.spark, "profiles")),
        "codes": _csv(t.codes, scratch_path(t.spark, "codes")),
    }


@query
def s18_run_all(t):
    """Rows per table after a run over clean files whose 41 tests must pass, and the metrics of its training."""
    t = Tables(t.spark, t.sf_dir, clean=True)
    results = run.run_all(
        t.spark,
        _run_inputs(t),
        today=TODAY,
        loaded_at=adapters.LOADED,
        raw=_database(t, "raw"),
        schema=_database(t, "marts"),
        weather=t.weather,
        out=scratch_path(t.spark, "training"),
        days=HOLDOUT,
    )
    landed = results.pop("landed").select("table_name", "n_rows")
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in results.items()]
    return reduce(DataFrame.unionByName, counted, landed)


# --- Reshape ------------------------------------------------------------------------------------


@query
def r1_unpivot(t):
    """A wide sheet of 25 columns, built from customers; two columns lack a number."""
    k = F.col("c_custkey")
    wide = (
        t.source("customer")
        .select(F.floor(k / 25).alias("row"), (k % 25).alias("position"), F.col("c_mktsegment").alias("value"))
        .groupBy("row")
        .pivot("position", list(range(25)))
        .agg(F.min("value"))
        .withColumn("metric", F.when(F.col("row") % 7 != 3, F.concat(F.lit(" Metric "), "row", F.lit("\t"))))
        .select("metric", *[F.col(f"`{i}`") for i in range(25)])
    )
    names = [f"Place {i}" for i in range(25)]
    return reshape.unpivot_profile(wide, names, [None if i in (4, 9) else 100 + i for i in range(25)])


@query
def r2_profile_pivot(t):
    return reshape.pivot_metrics(t.raw_profiles, PROFILE_METRICS)


@query
def r3_dim_date(t):
    """The generated calendar, with each day's incidents."""
    daily = t.fct_crime.groupBy("occurrence_date_key").agg(F.count("*").alias("incidents"))
    d = t.dim_date
    return d.join(daily, d["date_key"] == daily["occurrence_date_key"], "left").select(
        *d.columns, F.coalesce("incidents", F.lit(0)).alias("incidents")
    )


@query
def r4_hour_spine(t):
    return reshape.hour_spine(t.stg_delays)


@query
def r5_line_hours(t):
    return reshape.line_hours(reshape.hour_spine(t.stg_delays), LINES)


# --- Projections, filters, casts ----------------------------------------------------------------


@query
def p1_stg_crime(t):
    return t.stg_crime


@query
def p2_stg_ttc_delays(t):
    return t.stg_delays


@query
def p3_stg_neighbourhoods(t):
    return t.stg_neighbourhoods


@query
def p4_stg_profiles(t):
    return t.stg_profiles


@query
def p5_strict_cast(t):
    return t.stg_crime.groupBy("mci_category").agg(
        F.count("*").alias("n_rows"),
        F.max("source_row_id").alias("max_id"),
        F.min("occurrence_date").alias("first_date"),
        F.sum(F.col("occurrence_hour").cast("long")).alias("sum_hour"),
        F.max("longitude").alias("max_longitude"),
    )


@query
def p5b_bad_values(t):
    """Ids replaced by labels, dates cut to the month and signs spelled out, on some rows."""
    k = F.col("id").cast("long")
    spoiled = t.raw_crime.withColumns(
        {
            "report_date": F.when(k % 61 == 0, F.substring("report_date", 1, 7)).otherwise(F.col("report_date")),
            "occ_hour": F.when(k % 67 == 0, "noon").otherwise(F.col("occ_hour")),
            "hood_158": F.when(k % 71 == 0, "n/a").otherwise(F.col("hood_158")),
            "lat_wgs84": F.when(k % 73 == 0, F.concat(F.col("lat_wgs84"), F.lit("N"))).otherwise(F.col("lat_wgs84")),
        }
    )
    delays = t.raw_delays.withColumns(
        {
            "min_delay": F.when(k % 59 == 0, "ten").otherwise(F.col("min_delay")),
            "time": F.when(k % 83 == 0, "25:61").otherwise(F.col("time")),
        }
    )
    crime = staging.bad_values(spoiled, staging.CRIME_TYPES).withColumn("table_name", F.lit("crime"))
    return crime.unionByName(staging.bad_values(delays, staging.DELAY_TYPES).withColumn("table_name", F.lit("delays")))


@query
def p6_blank_to_null(t):
    return t.stg_delays.groupBy("bound").agg(
        F.count("*").alias("n_rows"),
        F.count("delay_minutes").alias("n_minutes"),
        F.count("gap_minutes").alias("n_gap"),
        F.count("vehicle").alias("n_vehicle"),
    )


@query
def p7_sentinel_to_null(t):
    return t.raw_crime.select(
        F.col("id").cast("long").alias("id"),
        text.sentinel_to_null(F.col("hood_158"), staging.UNKNOWN_AREA).cast("int").alias("neighbourhood_id"),
    )


@query
def p8_line_group(t):
    return t.stg_delays.groupBy("line", "line_group").agg(F.count("*").alias("n_rows"))


@query
def p9_prefix_flag(t):
    return t.stg_neighbourhoods.select("neighbourhood_id", "is_improvement_area")


@query
def p10_text_timestamp(t):
    return t.raw_delays.select(
        F.col("id").cast("long").alias("id"), dates.text_timestamp(F.col("date"), F.col("time")).alias("delay_at")
    )


@query
def p11_fact_date_filter(t):
    return t.fct_crime


@query
def p11_year_by_month(t):
    """One year's incidents by month, of the fact as a run stores it: only that year's months are read."""
    fct = monthly.with_month(t.fct_crime, "occurrence_date")
    table = landing.materialize(fct, f"{_database(t, 'marts')}.fct_crime_incidents", "table", "occurrence_date", [monthly.MONTH])
    year = monthly.between(table, "occurrence_date", date(REPORT_YEAR, 1, 1), date(REPORT_YEAR, 12, 31))
    return year.groupBy(F.month("occurrence_date").alias("month"), "mci_category").agg(F.count("*").alias("incidents"))


@query
def p11_weekend_days(t):
    """The weekends of one year: the calendar's rows decide which months are read."""
    fct = monthly.with_month(t.fct_crime, "occurrence_date")
    table = landing.materialize(fct, f"{_database(t, 'marts')}.fct_crime_incidents", "table", "occurrence_date", [monthly.MONTH])
    days = t.dim_date.filter(F.col("is_weekend") & (F.col("year") == REPORT_YEAR))
    found = monthly.on_days(table, "occurrence_date_key", days)
    return found.groupBy("date_day", "day_abbr").agg(F.count("*").alias("incidents"))


@query
def p12_calendar_attributes(t):
    return marts.calendar_attributes(t.stg_delays.select("delay_date"), "delay_date").groupBy(
        "date_key", "date_day", "year", "quarter", "month", "month_abbr", "month_start", "iso_day_of_week", "day_abbr", "is_weekend"
    ).agg(F.count("*").alias("n_rows"))


@query
def p13_code_family(t):
    return t.dim_code


@query
def p14_date_key(t):
    return t.fct_delays.groupBy("delay_date_key").agg(F.count("*").alias("n_rows"))


@query
def p15_days_to_report(t):
    return t.fct_crime.groupBy("days_to_report").agg(F.count("*").alias("n_rows"))


@query
def p16_has_temperature(t):
    return features.join_weather(t.grid, t.weather).dropna(subset=["temperature_2m"]).drop("delay_minutes")


@query
def p17_in_list(t):
    return t.fct_delays.filter(F.col("line_group").isin(LINES)).select("ttc_delay_key", "line_group")


@query
def p18_bi_columns(t):
    return reports.bi_columns(t.dim_neighbourhood)


# --- Joins --------------------------------------------------------------------------------------


@query
def j1_dim_neighbourhood(t):
    return t.dim_neighbourhood


@query
def j2_fct_ttc_delays(t):
    return t.fct_delays


@query
def j3_known_places(t):
    return t.agg_crime.groupBy("neighbourhood_id", "neighbourhood_name").agg(F.sum("incidents").alias("incidents"))


@query
def j4_hours_by_line(t):
    return reshape.line_hours(reshape.hour_spine(t.stg_delays), LINES).groupBy("line").agg(
        F.count("*").alias("n_hours"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour")
    )


@query
def j5_grid_counts(t):
    return t.grid.filter("delays > 0")


@query
def j6_grid_weather(t):
    return features.join_weather(t.grid, t.weather)


@query
def j7_baseline_join(t):
    return _rounded(t.baseline.select("hour", "line", TARGET, "p"), "p")


@query
def j8_relationships(t):
    return quality.relationships(t.fct_crime, "neighbourhood_id", t.dim_neighbourhood, "neighbourhood_id")


@query
def j9_star_crime(t):
    counts = reports.b1(t.fct_crime, ["occurrence_date_key", "neighbourhood_id", "mci_category"])
    star = reports.star_crime(counts, t.dim_date, t.dim_neighbourhood)
    return star.groupBy("year", "is_weekend", "is_improvement_area", "mci_category").agg(F.sum("incidents").alias("incidents"))


@query
def j9_star_delays(t):
    counts = reports.b5(t.fct_delays, ["delay_date_key", "delay_code"])
    star = reports.star_delays(counts, t.dim_date, t.dim_code)
    sums = [F.sum(c).alias(c) for c in ("delay_events", "delay_minutes", "delays_10min_plus")]
    return star.groupBy("day_abbr", "system", "code_family_hint").agg(*sums)


@query
def j10_requests_forecast(t):
    joined = weather.forecast_at(t.requests, t.weather)
    return joined.groupBy("line", "has_forecast").agg(F.count("*").alias("n_requests"))


# --- Aggregations -------------------------------------------------------------------------------


@query
def a1_crime_monthly(t):
    return t.agg_crime


@query
def a2_ttc_station_month(t):
    return t.agg_delays


@query
def a3_hourly_delays(t):
    return features.hourly_delays(t.fct_delays)


@query
def a4_filtered_count(t):
    return t.fct_delays.groupBy("station").agg(F.count_if(F.col("delay_minutes") >= 10).alias("delays_10min_plus"))


@query
def a5_bounds(t):
    return t.fct_delays.agg(F.min("delay_date").alias("first_date"), F.max("delay_date").alias("last_date"))


@query
def a6_group_rate(t):
    return _rounded(features.group_rate(t.frame), "p")


@query
def a7_conditional_max(t):
    return reshape.pivot_metrics(
        t.raw_profiles, {"population_2021": PROFILE_METRICS["population_2021"]}
    )


@query
def a8_having_duplicates(t):
    return quality.unique_combination(t.source("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def a9_row_counts(t):
    raw = {
        "major_crime_indicators": t.raw_crime,
        "ttc_subway_delays": t.raw_delays,
        "neighbourhoods": t.raw_neighbourhoods,
        "neighbourhood_profiles": t.raw_profiles,
    }
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in raw.items()]
    return reduce(DataFrame.unionByName, counts)


@query
def a10_positive_rate(t):
    train, test = features.time_split(t.frame, HOLDOUT)
    parts = train.select(F.lit("train").alias("part"), TARGET).unionByName(test.select(F.lit("test").alias("part"), TARGET))
    return _rounded(parts.groupBy("part").agg(F.count("*").alias("n_rows"), F.avg(TARGET).alias("positive_rate")), "positive_rate")


# --- Ordered functions, top-k -------------------------------------------------------------------


@query
def w1_prev_1h(t):
    return features.add_history_features(t.grid).select("hour", "line", "delays", "delays_prev_1h")


@query
def w2_prev_24h(t):
    return features.add_history_features(t.grid).select("hour", "line", "delays", "delays_prev_24h")


@query
def w3_history_optional(t):
    """Frames with and without history hold the same rows; history is added only when asked for."""
    without = t.frame.select("hour", "line", TARGET)
    with_history = features.training_frame(t.fct_delays, t.weather)
    return without.join(with_history.select("hour", "line", *HISTORY_FEATURES), ["hour", "line"])


@query
def w4_top_per_group(t):
    rates = _rounded(reports.b12(t.fct_crime, t.dim_neighbourhood), "per_1000")
    best = reports.top_n(rates, [F.desc_nulls_last("per_1000"), F.asc("neighbourhood_id")], 3, per=["year"])
    return best.select("year", "rank", "neighbourhood_id", "per_1000")


@query
def w5_yoy(t):
    yearly = t.fct_crime.groupBy(F.year("occurrence_date").alias("year"), "mci_category").agg(
        F.count("*").alias("incidents")
    )
    return _rounded(reports.yoy(yearly, "year", "incidents", ["mci_category"]), "change")


@query
def t1_grid_ordered(t):
    return t.grid.orderBy("hour", "line")


@query
def t2_top_station_months(t):
    return reports.b16(t.agg_delays).select("month_start", "station", "line", "total_delay_minutes")


@query
def t3_top_rates(t):
    return _rounded(reports.b7(t.fct_crime, t.dim_neighbourhood, 15).select("neighbourhood_id", "per_1000"), "per_1000")


@query
def t4_shift_by_hour(t):
    """History over a frame with holes: rows, not hours, are what is shifted."""
    sparse = t.grid.filter("delays > 0")
    return features.add_history_features(sparse).select("hour", "line", "delays_prev_1h", "delays_prev_24h")


# --- Scalar functions ---------------------------------------------------------------------------




@query
def f1_trim(t):
    return t.raw_crime.select(F.col("id").cast("long").alias("id"), F.trim("mci_category").alias("v"), F.trim("occ_dow").alias("w"))


@query
def f2_upper_trim(t):
    return t.raw_delays.select(F.col("id").cast("long").alias("id"), text.upper_trim(F.col("station")).alias("v"))


@query
def f3_nullif(t):
    return t.raw_delays.select(F.col("id").cast("long").alias("id"), text.blank_to_null(F.col("min_delay")).alias("v"))


@query
def f4_coalesce(t):
    return t.fct_delays.select("ttc_delay_key", F.coalesce("delay_minutes", F.lit(0)).alias("v"), "delay_description")


@query
def f5_concat(t):
    return t.raw_crime.select(F.col("id").cast("long").alias("id"), F.concat("occ_date", F.lit(" "), "division").alias("v"))


@query
def f6_substr(t):
    return t.stg_delays.select("source_row_id", F.substring("delay_code", 2, 1).alias("v"))


@query
def f7_like_prefix(t):
    return t.stg_delays.select("source_row_id", F.col("line").startswith("YU").alias("v"))


@query
def f8_case(t):
    return t.stg_delays.select("source_row_id", text.code_family(F.col("delay_code")).alias("v"))


@query
def f9_in(t):
    return t.raw_crime.select(F.col("id").cast("long").alias("id"), F.col("hood_158").isin("NSA", "").alias("v"))


@query
def f10_date_format(t):
    day = F.col("occurrence_date")
    return t.stg_crime.select(
        "source_row_id", dates.date_key(day).alias("k"), F.date_format(day, "MMM").alias("m"), F.date_format(day, "E").alias("d")
    )


@query
def f11_extract(t):
    day = F.col("delay_at")
    return t.stg_delays.select(
        "source_row_id",
        F.year(day).alias("y"),
        F.quarter(day).alias("q"),
        F.month(day).alias("m"),
        dates.iso_day_of_week(day).alias("d"),
        F.hour(day).alias("h"),
    )


@query
def f12_date_trunc(t):
    return t.stg_delays.select(
        "source_row_id",
        dates.month_start(F.col("delay_date")).alias("m"),
        F.trunc("delay_date", "year").alias("y"),
        dates.floor_hour(F.col("delay_at")).alias("h"),
    )


@query
def f13_date_difference(t):
    return t.stg_crime.select("source_row_id", F.datediff("report_date", "occurrence_date").alias("v"))


@query
def f14_interval_add(t):
    return t.stg_delays.select("source_row_id", (F.col("delay_at") + F.expr("interval 23 hours")).alias("v"))


@query
def f15_round_numeric(t):
    return t.source("lineitem").groupBy("l_orderkey").agg(
        numbers.exact_avg(F.col("l_quantity").cast("int"), 2).alias("v")
    )


@query
def f16_numeric_to_int(t):
    return t.raw_profiles.filter(F.col("metric") == PROFILE_METRICS["population_2021"]).groupBy("neighbourhood_number").agg(
        F.sum(numbers.numeric_to_int(numbers.as_numeric(text.blank_to_null(F.col("value"))))).alias("v")
    )


@query
def f17_safe_division(t):
    return t.dim_neighbourhood.select(
        "neighbourhood_id", numbers.rate_per_1000(F.col("households_2021"), F.col("population_2021")).alias("v")
    )


@query
def f18_ident_functions(t):
    return t.source("customer").groupBy(text.clean_ident(F.col("c_name")).alias("v")).agg(F.count("*").alias("n_rows"))


@query
def f19_strip(t):
    padded = F.concat(F.lit("\t "), "event_type", F.lit(" \n"))
    return t.source("events").select("event_id", text.strip_text(padded).alias("v"))


@query
def f20_time_parts(t):
    ts = F.col("delay_at")
    return t.stg_delays.select("source_row_id", F.hour(ts).alias("h"), F.weekday(ts).alias("w"), F.month(ts).alias("m"))


@query
def f21_floor_hour(t):
    return t.source("events").select("event_id", dates.floor_hour(F.col("ts")).alias("v"))


@query
def f22_flags(t):
    return features.add_features(t.grid).select("hour", "line", "is_weekend", "is_service_hour", TARGET)


@query
def f23_override(t):
    base = t.requests.withColumns({n: F.lit(0.5) for n in ("temperature_2m", "precipitation", "snowfall", "wind_speed_10m")})
    return score.apply_override(base).drop("weather", "at")


@query
def f24_round(t):
    return features.group_rate(t.frame, ["line", "hour_of_day"]).select("line", "hour_of_day", F.round("p", 3).alias("p"))


# --- Data tests ---------------------------------------------------------------------------------


@query
def q1_not_null(t):
    return quality.not_null(t.stg_crime, "occurrence_date").select("source_row_id")


@query
def q2_unique(t):
    return quality.unique(t.source("lineitem"), "l_orderkey")


@query
def q3_accepted_values(t):
    return quality.accepted_values(t.stg_crime, "mci_category", CRIME_CATEGORIES)


@query
def q4_relationships(t):
    return quality.relationships(t.stg_delays, "delay_code", t.dim_code, "delay_code")


@query
def q5_non_negative(t):
    return quality.non_negative(t.fct_crime, "days_to_report").select("crime_incident_key", "days_to_report")


@query
def q6_unique_combination(t):
    return quality.unique_combination(t.fct_crime, ["event_id", "mci_category"])


@query
def q7_no_future(t):
    return quality.no_future(t.fct_crime, ["occurrence_date", "report_date"], FUTURE_AFTER).select(
        "crime_incident_key", "occurrence_date", "report_date"
    )


@query
def q8_plausible(t):
    return quality.plausible(t.agg_crime, "incidents_per_1000").select(
        "month_start", "neighbourhood_id", "mci_category", "incidents_per_1000"
    )


@query
def q9_freshness(t):
    """A table landed in daily batches, the day after each row's date, judged on several days."""
    landed = t.raw_delays.withColumn(landing.LOADED_AT, F.date_add(F.col("date").cast("date"), 1).cast("timestamp"))
    loads = [quality.freshness(landed, adapters.LOADED + timedelta(days=d)).withColumn("days", F.lit(d)) for d in (-30, 0, 3, 9)]
    return reduce(DataFrame.unionByName, loads)


@query
def q10_run_checks(t):
    """Staging as views and marts as tables, as a run leaves them."""
    schema = _database(t, "marts")
    tables = {
        name: df if name.startswith("stg_") else landing.materialize(df, f"{schema}.{name}", "table")
        for name, df in t.all.items()
    }
    return quality.run_checks(tables, quality.declared_checks(TODAY))


# --- Model --------------------------------------------------------------------------------------


@query
def m1_grid(t):
    return t.grid


@query
def m2_features(t):
    return features.add_features(t.grid)


@query
def m3_training_frame(t):
    return features.training_frame(t.fct_delays, t.weather)


@query
def m5_split(t):
    train, test = features.time_split(t.frame, HOLDOUT)
    parts = train.select(F.lit("train").alias("part"), "hour").unionByName(test.select(F.lit("test").alias("part"), "hour"))
    return parts.groupBy("part").agg(
        F.count("*").alias("n_rows"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour")
    )


@query
def m7_baseline(t):
    return _rounded(
        t.baseline.groupBy(*BASELINE_KEYS).agg(F.count("*").alias("n_rows"), F.min("p").alias("p")), "p"
    )


@query
def m8_roc_auc(t):
    return _rounded(metrics.roc_auc(t.baseline), "roc_auc")


@query
def m9_pr_auc(t):
    return _rounded(metrics.pr_auc(t.baseline), "pr_auc")


@query
def m10_brier(t):
    return _rounded(metrics.brier(t.baseline), "brier")


def _trained(frame, columns):
    """The held-out rows and whether each has a probability; the trees themselves have no equal elsewhere."""
    train, test = features.time_split(frame, HOLDOUT)
    scored = model.predict(model.fit(train, columns), test)
    return scored.select("hour", "line", TARGET, F.col("p").between(0, 1).alias("has_p"))


@query
def m6_classifier(t):
    return _trained(t.frame, model.FEATURES)


@query
def m11_informed(t):
    return _trained(t.history_frame, model.informed_features())


@query
def m12_metrics_row(t):
    train, test = features.time_split(t.frame, HOLDOUT)
    split = features.split_instant(t.frame, HOLDOUT)
    row = metrics.metrics_row(train, test, split, {"baseline": t.baseline}, "2024-02-01T06:00:00+00:00")
    return row.select("trained_at", "rows_train", "rows_test", "test_from", "positive_rate", "baseline.*")


@query
def m13_refit_save(t):
    """Rows scored by the fitted and by the reloaded model, and how many they differ on."""
    path = scratch_path(t.spark, "model")
    fitted = model.fit(t.frame)
    sinks.save_model(fitted, path)
    scored = model.predict(fitted, t.frame).withColumnRenamed("p", "p_fitted")
    both = model.predict(sinks.load_model(path), scored)
    return both.agg(F.count("*").alias("n_rows"), F.count_if(~F.col("p").eqNullSafe(F.col("p_fitted"))).alias("n_differ"))


@query
def m14_score(t):
    scored = score.score(t.requests, t.weather, model.fit(t.frame))
    return scored.withColumn("has_p", F.coalesce(F.col("p_delay_5min").between(0, 1), F.lit(False))).drop("p_delay_5min")


@query
def m14_request_status(t):
    prepared = score.prepare_requests(t.requests, t.weather)
    return prepared.groupBy("status").agg(
        F.count("*").alias("n_requests"), F.round(F.sum("snowfall"), 6).alias("sum_snowfall")
    )


# --- Reports ------------------------------------------------------------------------------------


@query
def b1_incidents(t):
    return reports.b1(t.fct_crime, ["mci_category", "police_division"])


@query
def b2_population(t):
    return reports.b2(t.dim_neighbourhood, ["is_improvement_area"])


@query
def b3_rate(t):
    rates = reports.b3(t.fct_crime, t.dim_neighbourhood, ["tsns_classification"], total=True)
    shown = F.when(F.col("is_total"), "(all)").otherwise(F.col("tsns_classification"))
    return _rounded(rates.withColumn("tsns_classification", shown).drop("is_total"), "per_1000")


@query
def b4_yoy(t):
    return _rounded(reports.b4(t.fct_crime, t.dim_date), "change")


@query
def b5_delay_measures(t):
    return _rounded(reports.b5(t.fct_delays, ["line_group"]), "avg_delay_minutes")


@query
def b6_month_category(t):
    return reports.b6(t.fct_crime, t.dim_date)


@query
def b7_top_neighbourhoods(t):
    return _rounded(reports.b7(t.fct_crime, t.dim_neighbourhood), "per_1000")


@query
def b8_station_month(t):
    return reports.b8(t.fct_delays)


@query
def b8_matrix(t):
    """The matrix itself, of the log's first months."""
    return reports.b8_wide(t.fct_delays, ["2024-01", "2024-02"])


@query
def b9_minutes_by_cause(t):
    return reports.b9(t.fct_delays)


@query
def b10_hour_histogram(t):
    return reports.b10(t.fct_delays)


@query
def b11_auto_theft(t):
    return _rounded(reports.b11(t.fct_crime, "Auto Theft"), "change")


@query
def b12_yearly_rates(t):
    return _rounded(reports.b12(t.fct_crime, t.dim_neighbourhood), "per_1000")


@query
def b13_top_cause(t):
    return reports.b13(t.fct_delays, "2024-01-10")


@query
def b14_top_station(t):
    return reports.b14(t.fct_delays)


@query
def b15_late_share(t):
    return _rounded(reports.b15(t.fct_crime), "share_late")


@query
def b16_top_station_months(t):
    return reports.worst_station_months(t.fct_delays)


# --- Ideas the model's notes describe -----------------------------------------------------------


def _two_snapshots(t):
    old = t.stg_crime.select("source_row_id", "event_id", "occurrence_hour", "neighbourhood_id")
    k = F.col("source_row_id")
    new = old.withColumns(
        {
            "occurrence_hour": F.when(k % 17 == 0, F.lit(99)).otherwise(F.col("occurrence_hour")),
            "source_row_id": F.when(k % 19 == 0, -k).otherwise(k),
        }
    )
    return old, new


@query
def x1_snapshot_diff(t):
    return snapshots.snapshot_diff(*_two_snapshots(t), "source_row_id")


@query
def x1_bucketed_diff(t):
    """The same from snapshots kept in buckets, as many as a shuffle has tasks."""
    table, buckets = f"{_database(t, 'snapshots')}.crime", int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    names = [
        landing.land_bucketed(df, table, date(2024, 2, day), "source_row_id", buckets)
        for day, df in enumerate(_two_snapshots(t), 1)
    ]
    return snapshots.bucketed_diff(*map(t.spark.table, names), "source_row_id")


@query
def x2_latest_by_key(t):
    """Two batches: the second brings one category's rows again, and leaves other rows of their events out."""
    first = t.stg_crime.select("event_id", "source_row_id", "mci_category", "_loaded_at")
    second = first.filter("mci_category = 'Robbery'").withColumn("_loaded_at", F.col("_loaded_at") + F.expr("interval 1 day"))
    return snapshots.latest_by_key(first.unionByName(second), "event_id")


@query
def x2_incremental_fact(t):
    """Three batches applied to a fact stored by month. The second brings one category's rows since 2019 again, a
    tenth of them on a day 40 days later; the third is an older load that comes late, and changes nothing."""
    columns = ["event_id", "source_row_id", "occurrence_date", "mci_category", "_loaded_at"]
    first, stamp, day = t.stg_crime.select(*columns), F.col("_loaded_at"), F.col("occurrence_date")
    moved = F.when(F.col("source_row_id") % 10 == 0, F.date_add(day, 40)).otherwise(day)
    second = first.filter((F.col("mci_category") == "Robbery") & (day >= "2019-01-01"))
    second = second.withColumns({"occurrence_date": moved, "_loaded_at": stamp + F.expr("interval 1 day")})
    third = first.filter("mci_category = 'Assault'").withColumn("_loaded_at", stamp - F.expr("interval 1 day"))
    path = scratch_path(t.spark, "fact")
    for batch in (first, second, third):
        monthly.apply_batch(batch, path, "event_id", "occurrence_date")
    return t.spark.read.parquet(path).select(*columns)


@query
def x3_volume_check(t):
    monthly = t.fct_crime.select(dates.month_start(F.col("occurrence_date")).alias("month_start"))
    return _rounded(snapshots.volume_check(monthly, "month_start", sigma=1.0), "mean_rows", "sd_rows")


@query
def x4_station_grid(t):
    return _grid_totals(features.build_grid(t.fct_delays, None, key="station"))


@query
def x4_code_grid(t):
    return _grid_totals(features.build_grid(t.fct_delays, None, key="delay_code"))


def _grid_totals(grid):
    return grid.groupBy("line").agg(
        F.count("*").alias("n_hours"),
        F.count_if(F.col("delays_5min") > 0).alias("n_late_hours"),
        F.sum("delays").alias("delays"),
        F.sum("delay_minutes").alias("delay_minutes"),
    )
