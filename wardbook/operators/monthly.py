"""Facts partitioned by month: reports read the months they ask for, and batches rewrite the months they touch."""

from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardbook.functions.dates import month_start
from wardbook.operators.snapshots import latest_by_key
from wardbook.sources import versions

# The partition column; facts end with it.
MONTH = "fact_month"


def with_month(fct: DataFrame, date_column: str) -> DataFrame:
    return fct.withColumn(MONTH, month_start(F.col(date_column)))


def between(fct: DataFrame, date_column: str, first: date, last: date) -> DataFrame:
    """Rows of the days from ``first`` to ``last``. Of a partitioned fact only their months are read."""
    day = F.col(date_column)
    wanted = (day >= F.lit(first)) & (day <= F.lit(last))
    if MONTH in fct.columns:
        wanted &= (F.col(MONTH) >= F.lit(first.replace(day=1))) & (F.col(MONTH) <= F.lit(last))
    return fct.filter(wanted)


def on_days(fct: DataFrame, key: str, days: DataFrame) -> DataFrame:
    """The fact with the attributes of chosen ``days`` (rows of the calendar). The months of a partitioned fact
    that the days are not in are pruned when the calendar has been read."""
    same: Column = fct[key] == days["date_key"]
    if MONTH in fct.columns:
        same &= fct[MONTH] == days["month_start"]
    return fct.join(days, same)


def _months(df: DataFrame) -> list[date | None]:
    """A few values for each year."""
    return [r[0] for r in df.select(MONTH).distinct().collect()]


def _in_months(fct: DataFrame, months: list[date | None]) -> DataFrame:
    known = [m for m in months if m is not None]
    wanted = F.col(MONTH).isin(known) if known else F.lit(False)
    return fct.filter(wanted | F.col(MONTH).isNull() if len(known) < len(months) else wanted)


def _partition(path: str, month: date | None) -> str:
    return f"{path}/{MONTH}={month.isoformat() if month else '__HIVE_DEFAULT_PARTITION__'}"


def apply_batch(batch: DataFrame, path: str, key: str, date_column: str, loaded_at: str = "_loaded_at") -> list[date | None]:
    """Bring the fact stored under ``path``, partitioned by month, up to date with a batch; the months that were
    read and rewritten.

    Afterwards it holds what ``latest_by_key`` gives over all batches, in whatever order they came: all rows of each
    key's newest batch. A batch touches the months of its rows and those in which its keys stand so far, as an event
    may have moved to another day; the latter are found from the key column alone. All other months keep their files.
    A batch holds all rows of its keys and load time: to apply it again changes nothing, so a run that was cut off
    between two months is simply repeated.
    """
    spark = batch.sparkSession
    rows = with_month(batch, date_column)
    if not versions.exists(spark, f"{path}/_SUCCESS"):
        first = latest_by_key(rows, key, loaded_at).hint("rebalance", F.col(MONTH))
        first.write.mode("overwrite").partitionBy(MONTH).parquet(path)
        return _months(rows)
    fact = spark.read.parquet(path)
    keys = batch.select(key).distinct()
    same = fact[key].eqNullSafe(keys[key])
    touched = _months(rows.select(MONTH).unionByName(fact.select(key, MONTH).join(keys, same, "left_semi").select(MONTH)))
    if not touched:
        return []
    now, loads = _in_months(fact, touched), batch.select(key, loaded_at).distinct()
    now = now.join(loads, now[key].eqNullSafe(loads[key]) & now[loaded_at].eqNullSafe(loads[loaded_at]), "left_anti")
    now = now.unionByName(rows.select(*fact.columns))
    made = Observation()
    month = F.col(MONTH)
    whole = latest_by_key(now, key, loaded_at).observe(made, F.collect_set(month).alias("months"), F.count_if(month.isNull()).alias("undated"))
    # The months' new files are all written before the first of them takes its place.
    whole.hint("rebalance", month).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    full = {*made.get["months"], *([None] if made.get["undated"] else [])}
    for emptied in set(touched) - full:
        versions.remove(spark, _partition(path, emptied))
    return touched
