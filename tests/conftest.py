import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Test modules build columns when they are imported, which needs a session.
SESSION = (
    SparkSession.builder.master("local[8]")
    .appName("mysem-tests")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "6g")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="mysem-tests-"))
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("OFF")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def one(spark):
    """Evaluate columns on a single row."""

    def run(*cols):
        row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
        return row[0] if len(cols) == 1 else tuple(row)

    return run
