import pathlib
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))


def session():
    # Intermediate tables of a test run; a cluster names a shared folder here.
    scratch = tempfile.mkdtemp(prefix="wardbook-tests-")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("wardbook-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return session()
