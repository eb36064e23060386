"""Comparing and checking whole snapshots."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardbook.sources.landing import KEY_COLUMNS


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys added, removed or changed between two snapshots of one shape; ``key`` is unique in each."""
    return _diff(old, new, key, (key,), lambda a, b: a.eqNullSafe(b))


def bucketed_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``snapshot_diff`` of two tables of ``landing.land_bucketed``: with equal numbers of buckets, bucket by bucket,
    without a shuffle."""
    return _diff(old, new, key, KEY_COLUMNS, lambda a, b: a == b)


def _diff(old, new, key, matched, same):
    values = [c for c in old.columns if c != key and c not in matched]

    def side(df, name):
        keys = [F.col(c).alias(f"{name}_{c}") for c in dict.fromkeys((*matched, key))]
        return df.select(*keys, F.struct(*values).alias(f"{name}_row"))

    change = (
        F.when(F.col("old_row").isNull(), "added")
        .when(F.col("new_row").isNull(), "removed")
        .when(~F.col("old_row").eqNullSafe(F.col("new_row")), "changed")
    )
    on = reduce(lambda a, b: a & b, [same(F.col(f"old_{c}"), F.col(f"new_{c}")) for c in matched])
    return (
        side(old, "old")
        .join(side(new, "new"), on, "full")
        .select(F.coalesce(f"old_{key}", f"new_{key}").alias(key), change.alias("change"))
        .filter("change is not null")
    )


def latest_by_key(df: DataFrame, key: str, loaded_at: str = "_loaded_at") -> DataFrame:
    """All rows of each key's newest batch; rows without a load time are a key's oldest. The newest batch is found by a partial aggregate and joined
    back, so a hot key's rows never sort in one window; AQE splits them in the join."""
    newest = df.groupBy(F.col(key).alias("_key")).agg(F.max(loaded_at).alias("_newest"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(loaded_at).eqNullSafe(F.col("_newest"))
    return df.join(newest, same).select(*df.columns)


def volume_check(df: DataFrame, period: str, keys: list[str] | None = None, sigma: float = 3) -> DataFrame:
    """Periods whose row count is more than ``sigma`` standard deviations from the mean of its group.

    Only the counts meet in a window: one row per period.
    """
    keys = keys or []
    counts = df.groupBy(*keys, period).agg(F.count("*").alias("n_rows"))
    mean, deviation = F.avg("n_rows"), F.stddev("n_rows")
    if keys:
        group = W.partitionBy(*keys)
        counts = counts.withColumns({"mean_rows": mean.over(group), "sd_rows": deviation.over(group)})
    else:
        stats = counts.agg(F.struct(mean.alias("mean_rows"), deviation.alias("sd_rows"))).scalar()
        counts = counts.withColumn("_stats", stats).select(period, "n_rows", "_stats.*")
    return counts.filter(F.abs(F.col("n_rows") - F.col("mean_rows")) > sigma * F.col("sd_rows"))
