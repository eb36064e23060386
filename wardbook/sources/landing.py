"""Landing published snapshots as text tables, and writing tables."""

import uuid
import warnings
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.functions.text import blank_to_null, clean_ident
from wardbook.sources import versions

LOADED_AT = "_loaded_at"
KEY_COLUMNS = ("_key_text", "_key_missing")
# A value no file holds: it lets the reader tell an empty field (null) from a quoted empty one ('').
_NULL_MARK = "\u0001"
_PAGE_SCHEMA = "success boolean, error string, result struct<records: array<{record}>, total: bigint>"


def duplicate_idents(labels: DataFrame, label: str) -> DataFrame:
    """Identifiers that two or more different labels clean to."""
    return (
        labels.select(clean_ident(F.col(label)).alias("ident"), F.col(label).alias("label"))
        .distinct()
        .groupBy("ident")
        .agg(F.count("*").alias("n_labels"))
        .filter("n_labels > 1")
    )


def _checked_names(names: list[str]) -> list[str]:
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate column names after cleaning: {names}")
    return names


def _stamped(df: DataFrame, loaded_at: datetime) -> DataFrame:
    return df.withColumn(LOADED_AT, F.lit(loaded_at).cast("timestamp"))


def land_csv(spark: SparkSession, path: str, *, loaded_at: datetime, multiline: bool = False) -> DataFrame:
    """A CSV file, or folder of files with one header, as all-text columns under cleaned names.

    A row with too few or too many fields fails the read. ``multiline`` accepts quoted line breaks but
    makes each file one task, so it is off by default; such a break then fails the read too.
    """
    reader = (
        spark.read.option("escape", '"')
        .option("nullValue", _NULL_MARK)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .option("multiLine", multiline)
    )
    header = reader.option("header", False).csv(path).limit(1)
    labels = [F.coalesce(F.col(c), F.lit("")) for c in header.columns]
    row = header.select(F.array(*labels).alias("labels"), F.array(*map(clean_ident, labels)).alias("names")).first()
    if row is None:
        raise ValueError(f"no header in {path}")
    names = _checked_names(row["names"])
    # Every file's own header is held against the first one's labels, so a file that orders its columns
    # otherwise fails. A column without a label can't be held against anything.
    labelled = all(row["labels"])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (row["labels"] if labelled else names)])
    rows = reader.option("header", True).option("enforceSchema", not labelled).schema(schema).csv(path)
    return _stamped(rows.toDF(*names), loaded_at)


def land_pages(
    spark: SparkSession, paths: str | list[str], *, loaded_at: datetime, whole_files: bool = False
) -> DataFrame:
    """Saved response pages, one JSON envelope per line (or per file), as all-text columns.

    The columns are the keys of the first page's first record, in its order. A later record may lack
    one (null) but may not add one (error). Any unsuccessful page, and fewer or more records than the stated
    total, fail the load. Without a total all pages are read, with a warning.
    """
    text = spark.read.text(paths, wholetext=whole_files)
    # Envelopes first, with the records left as text; their fields are parsed when the rows are read.
    envelopes = text.select(
        F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"),
        F.from_json("value", _PAGE_SCHEMA.format(record="string")).alias("page"),
    )
    ok = F.coalesce(F.col("page.success"), F.lit(False))
    records = F.col("page.result.records")
    summary = envelopes.agg(
        F.count_if(~ok).alias("failed"),
        F.first(F.when(~ok, F.coalesce("page.error", F.lit("unreadable page"))), ignorenulls=True).alias("error"),
        F.sum(F.size(records)).alias("records"),
        F.max("page.result.total").alias("total"),
        F.min_by(F.json_object_keys(records[0]), F.when(F.size(records) > 0, F.col("at"))).alias("keys"),
    ).first()
    if summary["failed"]:
        raise RuntimeError(f"{summary['failed']} unsuccessful pages: {summary['error']}")
    if summary["total"] is None:
        warnings.warn(f"{summary['records'] or 0} records, but no page states the total", stacklevel=2)
    elif (summary["records"] or 0) != summary["total"]:
        raise RuntimeError(f"{summary['records'] or 0} records of {summary['total']}")
    keys = summary["keys"] or []
    record = F.col("record")
    extra = F.array_except(F.map_keys(record), F.array(*map(F.lit, keys)).cast("array<string>"))
    record = F.when(
        F.size(extra) > 0, F.raise_error(F.concat(F.lit("unexpected keys: "), F.array_join(extra, ", ")))
    ).otherwise(record)
    pages = text.select(F.from_json("value", _PAGE_SCHEMA.format(record="map<string,string>")).alias("page"))
    rows = pages.select(F.explode("page.result.records").alias("record")).select(record.alias("record"))
    cleaned = spark.range(1).select(*[clean_ident(F.lit(k)) for k in keys]).first() if keys else []
    names = _checked_names(list(cleaned))
    landed = rows.select(*[blank_to_null(F.col("record")[k]).alias(n) for k, n in zip(keys, names)])
    return _stamped(landed, loaded_at)


def land_snapshot(df: DataFrame, root: str, table: str, run_date: date) -> str:
    """Write one run date's snapshot beside the others; one that is already there whole is kept as it is.
    What a crashed write left is replaced."""
    path = f"{root}/{table}/snapshot_date={run_date:%Y%m%d}"
    if not versions.exists(df.sparkSession, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return path


def land_bucketed(df: DataFrame, table: str, run_date: date, key: str, buckets: int) -> str:
    """Keep one run date's snapshot as a table in ``buckets`` sorted files by ``key``; returns its name.

    Two dates with as many buckets are compared (``snapshots.bucketed_diff``) without moving a row. ``KEY_COLUMNS`` are
    added: the key as text, empty for null, and whether it is null. A table that is there is whole, and kept as it is; what
    a crashed write left is in a folder of its own, which no table names.
    """
    spark, name = df.sparkSession, f"{table}_{run_date:%Y%m%d}"
    if not spark.catalog.tableExists(name):
        text, keyless = KEY_COLUMNS
        rows = df.withColumns({text: F.coalesce(F.col(key).cast("string"), F.lit("")), keyless: F.col(key).isNull()})
        # The files' own partitioning, so that each bucket is one task's and one file.
        rows = rows.repartition(buckets, *KEY_COLUMNS)
        folder = f"{versions.database_folder(spark, name)}/{uuid.uuid4().hex}"
        rows.write.bucketBy(buckets, *KEY_COLUMNS).sortBy(*KEY_COLUMNS).option("path", folder).saveAsTable(name)
    return name


def load_seed(spark: SparkSession, path: str, schema: str, max_lengths: dict[str, int] | None = None) -> DataFrame:
    """A static CSV of declared types; text longer than its column's limit is an error."""
    seed = spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)

    def within(name, limit):
        col = F.col(name)
        return F.when(F.length(col) > limit, F.raise_error(F.concat(F.lit(f"{name} is too long: "), col))).otherwise(col)

    return seed.withColumns({name: within(name, limit) for name, limit in (max_lengths or {}).items()})


def write_raw(df: DataFrame, table: str) -> bool:
    """Replace a raw table by a full load; True when it was absent or its columns changed.

    With unchanged columns the table stays in place, so that views over it keep working. The rows are written
    once; a load that fails, at whatever point, leaves the table as it was.
    """
    return versions.move_in(df, table)


def materialize(
    df: DataFrame, name: str, kind: str = "view", sort_by: str | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Staging layers are views; marts are tables, since many readers use each of them. A table whose rows
    can't all be made stays as it was.

    ``partition_by`` names columns that ``df`` ends with; the rows of a partition are brought together first, in
    as many tasks as its size asks for.
    """
    if kind == "view":
        df.createOrReplaceTempView(name.split(".")[-1])
        return df
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, sort_by)
    versions.replace_table(df, name, partition_by)
    return df.sparkSession.table(name)
