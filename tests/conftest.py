import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shroud.session import build_session
    # local[4,2]: four threads and a second attempt for failed tasks (retry tests)
    s = build_session("local[4,2]", app="shroud-tests", shuffle_partitions=8,
                      listing_parallelism=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from shroud.session import scratch_path
    return lambda name: scratch_path(spark, name)
