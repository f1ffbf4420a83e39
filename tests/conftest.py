import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lectern.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "lectern-tests", master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def campus(spark):
    from tests.seed import campus_tables

    return campus_tables(spark)
