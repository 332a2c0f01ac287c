import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("basketlab-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hand(spark):
    """Five small baskets with supports that are easy to count by hand."""
    content = {1: [1, 2, 3], 2: [1, 2], 3: [1, 3], 4: [2, 3], 5: [4]}
    rows = [(ticket, item) for ticket, items in content.items() for item in items]
    return spark.createDataFrame(rows, "ticket_id long, item long")
