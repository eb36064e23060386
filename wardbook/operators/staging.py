"""Typed, trimmed, unfiltered copies of the raw text tables, and the report of values that do not cast."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.functions.dates import strict_date, text_timestamp
from wardbook.functions.text import blank_to_null, line_group, prefix_flag, sentinel_to_null, upper_trim
from wardbook.operators.reshape import pivot_metrics
from wardbook.schema import IMPROVEMENT_AREA_PREFIX, PROFILE_METRICS
from wardbook.sources.landing import LOADED_AT

UNKNOWN_AREA = ["NSA", ""]
BLANK = [""]
# What each raw column must cast to, and the texts that stand for no value in it. The staging views cast by
# these rules, and the report of bad values lists what they reject. A time is cast together with its date.
CRIME_TYPES = {
    "id": ("bigint", []),
    "report_date": ("date", []),
    "occ_date": ("date", []),
    "occ_year": ("int", BLANK),
    "occ_hour": ("int", BLANK),
    "report_hour": ("int", BLANK),
    "hood_158": ("int", UNKNOWN_AREA),
    "long_wgs84": ("double", BLANK),
    "lat_wgs84": ("double", BLANK),
}
DELAY_TYPES = {"id": ("bigint", []), "date": ("date", []), "time": ("time", []), "min_delay": ("int", BLANK), "min_gap": ("int", BLANK)}
PLACE_TYPES = {"area_short_code": ("int", [])}
PROFILE_TYPES = {"neighbourhood_number": ("int", [])}


def _typed(name: str, types: dict[str, tuple[str, list[str]]]) -> Column:
    """The column as staging has it; a value that does not cast is an error."""
    dtype, none = types[name]
    if dtype == "time":
        return text_timestamp(F.col("date"), F.col(name))
    col = sentinel_to_null(F.col(name), none) if none else F.col(name)
    return strict_date(col) if dtype == "date" else col.cast(dtype)


def _rejected(name: str, types: dict[str, tuple[str, list[str]]]) -> Column:
    """Whether ``_typed`` fails."""
    dtype, none = types[name]
    col = sentinel_to_null(F.col(name), none) if none else F.col(name)
    if dtype == "time":
        both = F.concat(F.col("date"), F.lit(" "), col)
        return both.isNotNull() & both.try_cast("timestamp_ntz").isNull()
    bad = col.isNotNull() & col.try_cast(dtype).isNull()
    return bad | F.length(F.trim(col)).between(1, 7) if dtype == "date" else bad


def stg_crime(raw: DataFrame) -> DataFrame:
    def typed(name):
        return _typed(name, CRIME_TYPES)

    return raw.select(
        typed("id").alias("source_row_id"),
        F.trim("event_unique_id").alias("event_id"),
        typed("report_date").alias("report_date"),
        typed("occ_date").alias("occurrence_date"),
        typed("occ_year").alias("occurrence_year"),
        typed("occ_hour").alias("occurrence_hour"),
        F.trim("occ_dow").alias("occurrence_day_of_week"),
        typed("report_hour").alias("report_hour"),
        F.trim("division").alias("police_division"),
        F.trim("location_type").alias("location_type"),
        F.trim("premises_type").alias("premises_type"),
        F.trim("ucr_code").alias("ucr_code"),
        F.trim("ucr_ext").alias("ucr_ext"),
        F.trim("offence").alias("offence"),
        F.trim("mci_category").alias("mci_category"),
        typed("hood_158").alias("neighbourhood_id"),
        F.trim("neighbourhood_158").alias("neighbourhood_name_raw"),
        typed("long_wgs84").alias("longitude"),
        typed("lat_wgs84").alias("latitude"),
        LOADED_AT,
    )


def stg_delays(raw: DataFrame) -> DataFrame:
    def typed(name):
        return _typed(name, DELAY_TYPES)

    return raw.select(
        typed("id").alias("source_row_id"),
        typed("date").alias("delay_date"),
        typed("time").alias("delay_at"),
        F.trim("day").alias("day_of_week"),
        upper_trim(F.col("station")).alias("station"),
        upper_trim(F.col("code")).alias("delay_code"),
        typed("min_delay").alias("delay_minutes"),
        typed("min_gap").alias("gap_minutes"),
        blank_to_null(upper_trim(F.col("bound"))).alias("bound"),
        upper_trim(F.col("line")).alias("line"),
        line_group(F.col("line")).alias("line_group"),
        blank_to_null(F.trim("vehicle")).alias("vehicle"),
        LOADED_AT,
    )


def stg_neighbourhoods(raw: DataFrame) -> DataFrame:
    return raw.select(
        _typed("area_short_code", PLACE_TYPES).alias("neighbourhood_id"),
        F.trim("area_name").alias("neighbourhood_name"),
        F.trim("classification").alias("tsns_classification"),
        prefix_flag(F.col("classification"), IMPROVEMENT_AREA_PREFIX).alias("is_improvement_area"),
        F.col("geometry").alias("geometry_geojson"),
        LOADED_AT,
    )


def stg_profiles(raw: DataFrame) -> DataFrame:
    return pivot_metrics(raw, PROFILE_METRICS)


def bad_values(raw: DataFrame, types: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Per column, how many values staging rejects, with the smallest such value. One pass over the table
    whatever the number of columns."""
    totals = raw.agg(
        *[F.count_if(_rejected(n, types)).alias(f"n_{n}") for n in types],
        *[F.min(F.when(_rejected(n, types), F.col(n))).alias(f"v_{n}") for n in types],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("column_name"),
                F.lit(t).alias("type_name"),
                F.col(f"n_{n}").alias("n_bad"),
                F.col(f"v_{n}").alias("example"),
            )
            for n, (t, _) in types.items()
        ]
    )
    return totals.select(F.inline(rows))
