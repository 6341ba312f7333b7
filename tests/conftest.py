import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from reviewforge.session import build_session

    ckpt = tempfile.mkdtemp(prefix="rf-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="reviewforge-tests",
        shuffle_partitions=8,
        extra={
            "spark.checkpoint.dir": ckpt,
            "spark.driver.memory": "4g",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
