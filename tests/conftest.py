import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import build_session

    session = build_session(
        "cartwheel-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra={"spark.driver.memory": "4g", "spark.sql.adaptive.coalescePartitions.enabled": "true"},
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartwheel-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cartwheel-test-")
