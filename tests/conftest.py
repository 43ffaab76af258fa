import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from inkstream.session import build_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # The shared folder comes from the session's spark.checkpoint.dir; inkstream.session.shared_dir
    # creates a scratch one only when the environment leaves it unset.
    s = build_session(master="local[4]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE
