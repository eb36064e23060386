"""Tables written between steps, so that a lost executor costs one step."""

from pyspark.sql import DataFrame, SparkSession

from wardbook.session import scratch_path


# Most rows and bytes of an Arrow batch: a worker holds a few batches beside what it works on.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 512, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in small Arrow batches from now on, unless the session's are smaller yet."""
    for key, most in BATCH.items():
        now = int((spark.conf.get(key, None) or "0").rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, most)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back."""
    small_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
