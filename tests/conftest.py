import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    # Tests set their own shared folder only because none is configured.
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from tidemark.session import scratch_dir
    return scratch_dir(spark, "test")
