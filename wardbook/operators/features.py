"""The dense line-by-hour grid, its features and the time split."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardbook.functions.dates import floor_hour
from wardbook.operators.reshape import hour_spine, key_hours, line_hours
from wardbook.schema import BASELINE_KEYS, DELAY_THRESHOLD_MINUTES, HOLDOUT_DAYS, LINES, TARGET
from wardbook.sources.weather import one_per_hour

_COUNTS = ["delays", "delays_5min", "delay_minutes"]
_LOOK_BACK = 24
_BLOCK = 1024


def hourly_delays(
    fct: DataFrame, lines: list[str] | None = LINES, threshold: int = DELAY_THRESHOLD_MINUTES, key: str = "line_group"
) -> DataFrame:
    minutes = F.col("delay_minutes")
    return (
        fct.filter(F.col(key).isNotNull() if lines is None else F.col(key).isin(lines))
        .groupBy(F.col(key), floor_hour(F.col("delay_at")).alias("hour"))
        .agg(
            F.count("*").alias("delays"),
            F.count_if(minutes >= threshold).alias("delays_5min"),
            F.sum(minutes.cast("long")).alias("delay_minutes"),
        )
    )


def build_grid(
    fct: DataFrame, lines: list[str] | None = LINES, threshold: int = DELAY_THRESHOLD_MINUTES, key: str = "line_group"
) -> DataFrame:
    """One row per hour and line, zero where nothing happened. Unordered: sort where it is written.

    ``lines`` are the values of ``key``, so stations and delay codes work too; None takes all values of the
    log, however many. The grid grows with the calendar and the number of lines, not with the log.
    """
    grid = key_hours(fct, key) if lines is None else line_hours(hour_spine(fct, keys=len(lines)), lines, key)
    counts = hourly_delays(fct, lines, threshold, key)
    return grid.join(counts, ["hour", key], "left").select(
        "hour", F.col(key).alias("line"), *[F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS]
    )


def add_features(grid: DataFrame) -> DataFrame:
    hour_of_day, weekday = F.hour("hour"), F.weekday("hour")
    return grid.withColumns(
        {
            "hour_of_day": hour_of_day,
            "weekday": weekday,
            "month": F.month("hour"),
            "is_weekend": (weekday >= 5).cast("int"),
            "is_service_hour": ((hour_of_day >= 6) | (hour_of_day <= 1)).cast("int"),
            TARGET: (F.col("delays_5min") > 0).cast("int"),
        }
    )


def _row_positions(frame: DataFrame) -> DataFrame:
    """Number each line's rows by hour from 0 (``_pos``), a calendar month at a time.

    Rows are numbered within their month, then shifted by the rows of earlier months; only the month
    totals meet in one window per line.
    """
    month = frame.withColumn("_month", F.trunc("hour", "month"))
    totals = month.groupBy("line", "_month").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy("line").orderBy("_month").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("line", "_month", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = F.row_number().over(W.partitionBy("line", "_month").orderBy("hour"))
    return (
        month.withColumn("_row", within)
        .join(starts, ["line", "_month"])
        .withColumn("_pos", F.col("_start") + F.col("_row") - 1)
        .drop("_month", "_row", "_start")
    )


def add_history_features(frame: DataFrame) -> DataFrame:
    """Delays of the previous row and the sum over the previous 24 rows of the line, without the
    current one; 0 where there are none. A frame without ``delays`` stays as it is.

    A line's rows are cut into blocks, and the last 24 of a block are lent to the next one, so no task
    holds a whole line.
    """
    if "delays" not in frame.columns:
        return frame
    block = F.floor(F.col("_pos") / _BLOCK)
    lent = F.col("_pos") % _BLOCK >= _BLOCK - _LOOK_BACK
    copies = F.when(lent, F.array(block, block + 1)).otherwise(F.array(block))
    rows = _row_positions(frame).withColumn("_block", F.explode(copies))
    before = W.partitionBy("line", "_block").orderBy("_pos")
    return (
        rows.withColumns(
            {
                "delays_prev_1h": F.coalesce(F.lag("delays").over(before), F.lit(0)),
                "delays_prev_24h": F.coalesce(
                    F.sum("delays").over(before.rowsBetween(-_LOOK_BACK, -1)), F.lit(0)
                ),
            }
        )
        .filter(F.col("_block") == F.floor(F.col("_pos") / _BLOCK))
        .drop("_pos", "_block")
    )


def join_weather(grid: DataFrame, weather: DataFrame) -> DataFrame:
    return grid.join(one_per_hour(weather), "hour", "left")


def training_frame(fct: DataFrame, weather: DataFrame, *, history: bool = True, **grid_args) -> DataFrame:
    """Grid, weather and features. History is taken before the rows without temperature go."""
    frame = add_features(join_weather(build_grid(fct, **grid_args), weather))
    if history:
        frame = add_history_features(frame)
    return frame.dropna(subset=["temperature_2m"])


def time_split(df: DataFrame, days: int = HOLDOUT_DAYS) -> tuple[DataFrame, DataFrame]:
    """Rows before and from the instant ``days`` days before the last hour."""
    split = split_instant(df, days).scalar()
    return df.filter(F.col("hour") < split), df.filter(F.col("hour") >= split)


def split_instant(df: DataFrame, days: int = HOLDOUT_DAYS) -> DataFrame:
    return df.agg((F.max("hour") - F.make_dt_interval(F.lit(days))).alias("split_at"))


def group_rate(train: DataFrame, keys: list[str] = BASELINE_KEYS) -> DataFrame:
    return train.groupBy(*keys).agg(F.avg(TARGET).alias("p"))


def baseline_rate(train: DataFrame, test: DataFrame, keys: list[str] = BASELINE_KEYS) -> DataFrame:
    """The test rows with the historical rate of their group, or the overall rate of an unseen one."""
    overall = train.agg(F.avg(TARGET)).scalar()
    return test.join(group_rate(train, keys), keys, "left").withColumn("p", F.coalesce("p", overall))
