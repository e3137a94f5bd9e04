import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from riskloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "riskloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    # Keep small test tables in many partitions, so that the work between partitions is tested.
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield session
    session.stop()
