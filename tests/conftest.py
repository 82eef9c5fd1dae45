import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sweepframe.session import prepare

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.python.filterPushdown.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    prepare(s)
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
