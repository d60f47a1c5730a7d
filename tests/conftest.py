import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from strata.session import RECOMMENDED_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    builder = SparkSession.builder.master("local[8]").appName("strata-tests")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    session = (builder.config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.checkpoint.dir", f"{base}/shared").config("spark.sql.warehouse.dir", f"{base}/warehouse")
               .config("spark.driver.memory", "4g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
