"""Replacing a table as a whole: its new rows are written once, to a folder of their own, and then become the
table by operations on names alone.

A load that fails, or whose driver is lost, before that leaves the table as it was; what it wrote is never read.
One writer at a time is taken for granted. Readers by name see all old or all new rows.
"""

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

_NEXT, _OLD = "__next", "__old"


def _files(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    fs, path = _files(spark, path)
    return fs.exists(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, path = _files(spark, path)
    fs.delete(path, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, old = _files(spark, old)
    if not fs.rename(old, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{old} was not renamed to {new}")


def database_folder(spark: SparkSession, table: str) -> str:
    """Of the database that ``table`` is named in, or of the current one."""
    database = table.rpartition(".")[0] or spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def _home(spark: SparkSession, table: str) -> str:
    """The folder of a table's versions, beside the tables of its database."""
    database, name = table.split(".")
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}.versions"


def write_version(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> str:
    """The rows in a new folder, whose name sorts after those of earlier versions."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    path = f"{_home(df.sparkSession, table)}/{stamp}-{uuid.uuid4().hex[:8]}"
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def _create(spark: SparkSession, table: str, df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    # Partitions are found by listing the folder, so that they move with it.
    key = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        spark.sql(f"CREATE TABLE {table} ({df._jdf.schema().toDDL()}) USING parquet {parts} LOCATION '{path}'")
    finally:
        spark.conf.set(key, before)


def recover(spark: SparkSession, table: str) -> None:
    """Finish or undo what a lost driver left of a replacement, so that the table is whole under its name."""
    if spark.catalog.tableExists(table):
        path = location(spark, table)
        if not exists(spark, path) and exists(spark, path + _OLD):  # lost between the two renames of ``move_in``
            rename(spark, path + _OLD, path)
            spark.catalog.refreshTable(table)
    elif spark.catalog.tableExists(table + _NEXT):  # lost between the two renames of ``_swap_names``
        spark.sql(f"ALTER TABLE {table}{_NEXT} RENAME TO {table}")
    for left in (table + _NEXT, table + _OLD):
        spark.sql(f"DROP TABLE IF EXISTS {left}")


def _swap_names(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}{_OLD}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{_OLD}")
    spark.sql(f"ALTER TABLE {table}{_NEXT} RENAME TO {table}")
    spark.sql(f"DROP TABLE {table}{_OLD}")


def _same_shape(df: DataFrame, table: str, partition_by: Sequence[str]) -> bool:
    own = df.sparkSession.catalog.listColumns(table)
    return df.sparkSession.table(table).dtypes == df.dtypes and [c.name for c in own if c.isPartition] == list(partition_by)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> bool:
    """Replace a table, or make it, by one write and one change of its location; True if its shape is new.

    A new shape takes a second entry in the catalog and two renames there; ``recover`` ends a swap that was cut off
    between them. The version before is kept, for those who still read it; older ones are deleted. ``partition_by``
    names the last columns.
    """
    spark = df.sparkSession
    recover(spark, table)
    there = spark.catalog.tableExists(table)
    before = location(spark, table) if there else None
    path = write_version(df, table, partition_by)
    same = there and _same_shape(df, table, partition_by)
    if same:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    elif there:
        _create(spark, table + _NEXT, df, path, partition_by)
        _swap_names(spark, table)
    else:
        _create(spark, table, df, path, partition_by)
    spark.catalog.refreshTable(table)
    _remove_versions(spark, table, path, before)
    return not same


def _remove_versions(spark: SparkSession, table: str, now: str, before: str | None) -> None:
    """Versions older than the one before the present one. Newer ones may be another load's."""
    fs, home = _files(spark, _home(spark, table))
    name = lambda p: p.rstrip("/").rsplit("/", 1)[-1]
    oldest = min(name(now), name(before) if before and name(before)[:1].isdigit() else name(now))
    for status in fs.listStatus(home):
        if status.getPath().getName() < oldest:
            fs.delete(status.getPath(), True)


def move_in(df: DataFrame, table: str) -> bool:
    """``replace_table`` for a table that views were made over: with the same columns its folder stays where it
    is, as the views' plans name it, and the new rows' folder is renamed into its place.

    A table that ``recover`` finds without a folder gets its old one back. Temporary views are refreshed.
    """
    spark = df.sparkSession
    recover(spark, table)
    if not spark.catalog.tableExists(table) or spark.table(table).columns != df.columns:
        return replace_table(df, table)
    place, path = location(spark, table), write_version(df, table)
    remove(spark, place + _OLD)
    rename(spark, place, place + _OLD)
    try:
        rename(spark, path, place)
    except BaseException:
        rename(spark, place + _OLD, place)
        raise
    finally:
        spark.catalog.refreshTable(table)
    remove(spark, place + _OLD)
    for view in spark.catalog.listTables():
        if view.isTemporary:
            spark.catalog.refreshTable(view.name)
    return False
