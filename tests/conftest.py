import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from paceline.operators.skew import MAX_ROWS_CONF  # noqa: E402

DATA = Path(os.environ.get("PACELINE_TEST_DATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_groups(spark):
    """Treat groups of more than 20 rows as hot."""
    spark.conf.set(MAX_ROWS_CONF, "20")
    yield 20
    spark.conf.unset(MAX_ROWS_CONF)


@pytest.fixture
def data():
    if not DATA.exists():
        pytest.skip("no test tables")
    return str(DATA)
