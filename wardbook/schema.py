"""Names, types and constants shared by the operators."""

from dataclasses import dataclass

# --- Fixed values -------------------------------------------------------------------------------
# These must equal the published data model, or results differ.

LINES = ["YU", "BD", "SHP"]
LINE_GROUPS = ["YU", "BD", "SHP", "OTHER"]
CRIME_CATEGORIES = ["Assault", "Auto Theft", "Break and Enter", "Robbery", "Theft Over"]

PROFILE_METRICS = {
    "population_2021": "Total - Age groups of the population - 25% sample data",
    "median_income_2020": "Median total income in 2020 ($)",
    "households_2021": "Total - Private households by household size - 100% data",
}

IMPROVEMENT_AREA_PREFIX = "Neighbourhood Improvement"
UNKNOWN_CODE = "Unknown code"
FIRST_DATE = "2014-01-01"
DELAY_THRESHOLD_MINUTES = 5
LONG_DELAY_MINUTES = 10
HOLDOUT_DAYS = 90
RATE_LIMIT_PER_1000 = 100

WEATHER_VARS = ["temperature_2m", "precipitation", "snowfall", "wind_speed_10m"]
FEATURES = [
    "line",
    "hour_of_day",
    "weekday",
    "month",
    "is_weekend",
    "is_service_hour",
    "temperature_2m",
    "precipitation",
    "snowfall",
    "wind_speed_10m",
]
HISTORY_FEATURES = ["delays_prev_1h", "delays_prev_24h"]
TARGET = "any_delay_5min"
BASELINE_KEYS = ["line", "weekday", "hour_of_day"]

SEED_SCHEMA = "delay_code string, delay_description string, system string"
SEED_LENGTHS = {"delay_code": 10}
# --- End of fixed values ------------------------------------------------------------------------


@dataclass(frozen=True)
class Dataset:
    """One source: its key, its raw table and the way its files arrive (``csv`` or ``pages``)."""

    key: str
    raw_table: str
    kind: str = "csv"


DATASETS = {
    d.key: d
    for d in (
        Dataset("crime", "major_crime_indicators"),
        Dataset("ttc", "ttc_subway_delays", kind="pages"),
        Dataset("neighbourhoods", "neighbourhoods"),
        Dataset("profiles", "neighbourhood_profiles"),
    )
}
