import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from signalmart import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session.start(
        SparkSession.builder.master("local[8]")
        .appName("signalmart-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
