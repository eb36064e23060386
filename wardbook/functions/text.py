"""Column expressions over text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_ident(col: Column) -> Column:
    """Turn a label into a snake_case identifier; empty becomes ``col``, a leading digit gets ``c_``."""
    joined = F.regexp_replace(col, "[^0-9a-zA-Z]+", "_")
    name = F.lower(F.btrim(joined, F.lit("_")))
    return (
        F.when(F.length(name) == 0, "col")
        .when(name.rlike("^[0-9]"), F.concat(F.lit("c_"), name))
        .otherwise(name)
    )


def strip_text(col: Column) -> Column:
    """Remove all surrounding whitespace, not only spaces."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def upper_trim(col: Column) -> Column:
    return F.upper(F.trim(col))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def sentinel_to_null(col: Column, values: list[str]) -> Column:
    return F.when(~col.isin(values), col)


def prefix_flag(col: Column, prefix: str) -> Column:
    return col.startswith(prefix)


def line_group(col: Column) -> Column:
    """Collapse the free-text line to one of the three lines or OTHER; the first match wins."""
    line = upper_trim(col)
    return (
        F.when(line.startswith("YU") | line.startswith("LINE 1"), "YU")
        .when(line.startswith("BD") | line.startswith("LINE 2"), "BD")
        .when(line.startswith("SHP"), "SHP")
        .otherwise("OTHER")
    )


def code_family(code: Column) -> Column:
    return F.when(F.substring(code, 2, 1).isin("U", "R"), "Equipment").otherwise("Other")
