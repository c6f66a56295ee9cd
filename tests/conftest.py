import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from bottomgrid.session import build_session
    # one session for all tests: what their plans broadcast adds up
    s = build_session("local[*]", app="bottomgrid-tests", shuffle_partitions=8, extra={"spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    import uuid
    from bottomgrid.session import scratch_path
    return scratch_path(spark, "tests", uuid.uuid4().hex)
