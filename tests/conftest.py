import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    scratch = str(tmp_path_factory.mktemp("scratch"))
    spark = (SparkSession.builder.master("local[4]").appName("attrix-tests")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from attrix.session import scratch_root

    scratch_root(spark)
    yield spark
    spark.stop()
