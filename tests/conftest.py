import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from funnelspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[8]", spark_ui_enabled="false", spark_sql_shuffle_partitions="8", spark_driver_memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def frame(spark):
    """Small frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
