import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodgeframe.session import build_session  # noqa: E402


# Columns at module level of the tests need a running session.
SESSION = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def evaluate(spark):
    """Value of one expression over one row of constants."""

    def run(column, ddl="x string", row=(None,)):
        return spark.createDataFrame([row], ddl).select(column.alias("v")).first()["v"]

    return run
