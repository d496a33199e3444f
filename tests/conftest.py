import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("indicarium-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .getOrCreate())
    from indicarium.session import get_spark
    s = get_spark()
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="indicarium-test-")
