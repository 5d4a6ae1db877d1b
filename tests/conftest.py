import os
import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.local.dir", f"{folder}/local")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/checkpoints")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    """Folder of the smallest tables."""
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip("no tables here")
    return path
