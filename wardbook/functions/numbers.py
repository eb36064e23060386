"""Column expressions over numbers, with numeric (not binary) rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_numeric(col: Column) -> Column:
    """Text to an exact number with enough decimals that a later rounding is the only one."""
    return col.cast("decimal(38,18)")


def numeric_to_int(col: Column) -> Column:
    """Round half away from zero; a plain cast would cut the fraction off."""
    return F.round(col, 0).cast("int")


def exact_avg(col: Column, scale: int) -> Column:
    """Average of an integer column, exact before rounding; the rows are summed as plain longs."""
    total = F.sum(col.cast("long")).cast("decimal(20,0)")
    return F.round(total / F.nullif(F.count(col), F.lit(0)).cast("decimal(20,0)"), scale)


def rate_per_1000(count: Column, population: Column) -> Column:
    return F.round(count * F.lit(1000.0).cast("decimal(5,1)") / F.nullif(population, F.lit(0)), 3)
