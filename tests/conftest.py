import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cohortsmith import build_session
    store = tempfile.mkdtemp(prefix="cohortsmith-test-")
    s = build_session("local[4]", app="cohortsmith-tests", conf={
        "spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": store})
    yield s
    s.stop()
