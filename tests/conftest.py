import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__  # noqa: E402,F401  registers the packages for the workers
from spanquarry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session
