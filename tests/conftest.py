import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from ctrflow.scratch import release
    from ctrflow.session import local_session

    session = local_session(int(os.environ.get("TEST_CPUS", "8")), "4g", "ctrflow-tests")
    session.sparkContext.setLogLevel("ERROR")
    # small input would otherwise end up in one slice, and nothing would cross a boundary
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield session
    release(session)
    session.stop()


@pytest.fixture()
def tmp(tmp_path):
    return "file:" + str(tmp_path)
