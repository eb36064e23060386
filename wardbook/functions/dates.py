"""Column expressions over dates and zone-less timestamps.

Hours stay ``timestamp_ntz`` throughout: going through a zoned timestamp would lose or repeat an hour
on the two days a year when clocks change.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_date(col: Column) -> Column:
    """Cast text to date; a year or year-month alone is an error rather than its first day."""
    text = F.trim(col)
    return F.when(
        F.length(text).between(1, 7), F.raise_error(F.concat(F.lit("not a full date: "), text)).cast("date")
    ).otherwise(col.cast("date"))


def text_timestamp(date: Column, time: Column) -> Column:
    return F.concat(date, F.lit(" "), time).cast("timestamp_ntz")


def date_key(date: Column) -> Column:
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def iso_day_of_week(date: Column) -> Column:
    return F.weekday(date) + 1


def floor_hour(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))
