import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import build_session, work_root
    # spark.checkpoint.dir comes from the session's configuration when set;
    # work_root() picks a fresh local folder only when it is not.
    s = build_session(master="local[*]", shuffle_partitions=8)
    work_root(s)
    yield s
    s.stop()


@pytest.fixture()
def db(spark):
    from tripmart.session import scratch_database
    return scratch_database(spark, "test")


SF = "/root/testdata/sf0.001"
