"""Data tests. Each returns its failing rows or groups; a test passes when nothing comes back.

Groups carry their number of rows (``n_rows``), so that a hot value travels through a shuffle as one
partial count per task instead of as its rows.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.schema import CRIME_CATEGORIES, LINE_GROUPS, RATE_LIMIT_PER_1000


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values held by more than one row; nulls compare equal."""
    return df.groupBy(*cols).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values held by more than one row; nulls are ignored."""
    return unique_combination(df.filter(F.col(col).isNotNull()), [col])


def accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list; null passes."""
    return df.filter(~F.col(col).isin(list(values))).groupBy(col).agg(F.count("*").alias("n_rows"))


def relationships(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys that the parent lacks; a null key passes."""
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    known = parent.select(F.col(parent_key).alias(key))
    return keys.join(known, key, "left_anti")


def non_negative(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) < 0)


def no_future(df: DataFrame, cols: Sequence[str], today: date) -> DataFrame:
    return df.filter(_any_future(cols, today))


def plausible(df: DataFrame, col: str, limit: float = RATE_LIMIT_PER_1000) -> DataFrame:
    return df.filter(F.col(col) > limit)


def freshness(df: DataFrame, now: datetime, warn_days: int = 2, error_days: int = 7) -> DataFrame:
    """One row: the newest load and whether it is too old. An empty table is an error."""
    age = F.lit(now).cast("timestamp") - F.col("max_loaded_at")
    return df.agg(F.max("_loaded_at").alias("max_loaded_at")).select(
        "max_loaded_at",
        F.when(age <= F.make_dt_interval(F.lit(warn_days)), "pass")
        .when(age <= F.make_dt_interval(F.lit(error_days)), "warn")
        .otherwise("error")
        .alias("status"),
    )


def _any_future(cols, today):
    return reduce(lambda a, b: a | b, [F.col(c) > F.lit(today) for c in cols])


@dataclass(frozen=True)
class Check:
    """One declared test of one table. ``args`` holds what its kind needs beyond the columns."""

    table: str
    kind: str
    columns: tuple[str, ...]
    args: dict = field(default_factory=dict, hash=False)

    @property
    def label(self) -> str:
        return ", ".join(self.columns)


def _each(table, kind, *columns, **args):
    return [Check(table, kind, (c,), args) for c in columns]


def declared_checks(today: date) -> list[Check]:
    """The model's 41 data tests."""
    keys = {
        "stg_crime_incidents": "source_row_id",
        "stg_ttc_delays": "source_row_id",
        "stg_neighbourhoods": "neighbourhood_id",
        "stg_neighbourhood_profiles": "neighbourhood_id",
        "ttc_delay_codes": "delay_code",
        "dim_date": "date_key",
        "dim_neighbourhood": "neighbourhood_id",
        "dim_ttc_delay_code": "delay_code",
        "fct_crime_incidents": "crime_incident_key",
        "fct_ttc_delays": "ttc_delay_key",
    }
    checks = [c for t, k in keys.items() for c in (*_each(t, "unique", k), *_each(t, "not_null", k))]
    checks += _each("stg_neighbourhoods", "unique", "neighbourhood_name")
    checks += _each("stg_neighbourhoods", "not_null", "neighbourhood_name")
    checks += _each("stg_crime_incidents", "not_null", "event_id", "occurrence_date", "mci_category")
    checks += _each("stg_ttc_delays", "not_null", "delay_date")
    checks += _each("stg_neighbourhood_profiles", "not_null", "population_2021")
    checks += _each("dim_neighbourhood", "not_null", "population_2021")
    checks += _each("fct_crime_incidents", "not_null", "occurrence_date_key")
    checks += _each("stg_crime_incidents", "accepted_values", "mci_category", values=CRIME_CATEGORIES)
    checks += _each("stg_ttc_delays", "accepted_values", "line_group", values=LINE_GROUPS)
    for table, column, parent, parent_key in (
        ("fct_crime_incidents", "occurrence_date_key", "dim_date", "date_key"),
        ("fct_crime_incidents", "neighbourhood_id", "dim_neighbourhood", "neighbourhood_id"),
        ("fct_ttc_delays", "delay_date_key", "dim_date", "date_key"),
    ):
        checks += _each(table, "relationships", column, parent=parent, parent_key=parent_key)
    checks += _each("stg_ttc_delays", "non_negative", "delay_minutes")
    checks += _each("fct_crime_incidents", "non_negative", "days_to_report")
    checks += _each("agg_crime_monthly_neighbourhood", "non_negative", "incidents_per_1000")
    checks.append(
        Check(
            "agg_crime_monthly_neighbourhood",
            "unique_combination",
            ("month_start", "neighbourhood_id", "mci_category"),
        )
    )
    checks.append(Check("agg_ttc_delays_station_month", "unique_combination", ("month_start", "station", "line")))
    checks.append(Check("fct_crime_incidents", "no_future", ("occurrence_date", "report_date"), {"today": today}))
    checks += _each("agg_crime_monthly_neighbourhood", "plausible", "incidents_per_1000", limit=RATE_LIMIT_PER_1000)
    return checks


# Tests that look at one row at a time: all of a table's are counted in one scan of it.
_ROW_TESTS = {
    "not_null": lambda c: F.col(c.columns[0]).isNull(),
    "non_negative": lambda c: F.col(c.columns[0]) < 0,
    "no_future": lambda c: _any_future(c.columns, c.args["today"]),
    "plausible": lambda c: F.col(c.columns[0]) > c.args["limit"],
}


_GROUP_TESTS = ("unique", "unique_combination")


def _in_one_scan(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Results of a table's row tests and of at most one test of groups, which then carry the row counts."""
    rows = [c for c in checks if c.kind in _ROW_TESTS]
    failed = {c: F.count_if(_ROW_TESTS[c.kind](c)).alias(f"n{i}") for i, c in enumerate(rows)}
    by = next((c for c in checks if c.kind in _GROUP_TESTS), None)
    if by is None:
        counts = df.agg(*failed.values())
    else:
        groups = df.groupBy(*by.columns).agg(F.count("*").alias("n_rows"), *failed.values())
        counted = F.lit(True) if by.kind == "unique_combination" else F.col(by.columns[0]).isNotNull()
        sums = [F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(rows))]
        counts = groups.agg(F.count_if(counted & (F.col("n_rows") > 1)).alias("n_groups"), *sums)
    results = [_result(c, F.col(f"n{i}")) for i, c in enumerate(rows)]
    return counts.select(F.inline(F.array(*results, *([_result(by, F.col("n_groups"))] if by else []))))


def _related(checks: Sequence[Check], tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Results of one table's relationships, all from its rows counted by all their keys."""
    counts = tables[checks[0].table].groupBy(*[c.columns[0] for c in checks]).agg(F.count("*").alias("n_rows"))
    results = []
    for check in checks:
        key, parent = check.columns[0], tables[check.args["parent"]]
        keys = counts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("n_rows").alias("n_rows"))
        missing = keys.join(parent.select(F.col(check.args["parent_key"]).alias(key)), key, "left_anti")
        failed = missing.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_failed"))
        results.append(failed.select(F.inline(F.array(_result(check, F.col("n_failed"))))))
    return results


def run_checks(tables: dict[str, DataFrame], suite: Sequence[Check]) -> DataFrame:
    """One row per check with its number of failures: rows, or groups for the grouped kinds.

    A table is read once for its row tests and first test of groups, once for its relationships, and once for
    each further test.
    """
    parts = []
    for table in dict.fromkeys(c.table for c in suite):
        own = [c for c in suite if c.table == table]
        grouped = [c for c in own if c.kind in _GROUP_TESTS]
        together = [c for c in own if c.kind in _ROW_TESTS] + grouped[:1]
        if together:
            parts.append(_in_one_scan(tables[table], together))
        for check in grouped[1:]:
            parts.append(_in_one_scan(tables[table], [check]))
        for check in (c for c in own if c.kind == "accepted_values"):
            failed = accepted_values(tables[table], check.columns[0], check.args["values"]).agg(F.count("*").alias("n_failed"))
            parts.append(failed.select(F.inline(F.array(_result(check, F.col("n_failed"))))))
        related = [c for c in own if c.kind == "relationships"]
        if related:
            parts += _related(related, tables)
    return reduce(DataFrame.unionByName, parts)


def _result(check, n_failed):
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.label).alias("column_name"),
        n_failed.cast("long").alias("n_failed"),
        F.when(n_failed == 0, "pass").otherwise("fail").alias("status"),
    )


def require_passing(results: DataFrame) -> None:
    """Stop a run at its failed tests. The frame holds one row per declared check."""
    failed = results.filter("status = 'fail'").collect()
    if failed:
        raise RuntimeError(
            "failed checks: "
            + "; ".join(f"{r.check_name}({r.table_name}: {r.column_name}) {r.n_failed}" for r in failed)
        )
