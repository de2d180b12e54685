import os
import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    tmp = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    made = SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
    made = made.config("spark.local.dir", f"{tmp}/local").config("spark.sql.warehouse.dir", f"{tmp}/warehouse").config("spark.checkpoint.dir", f"{tmp}/shared").getOrCreate()
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
