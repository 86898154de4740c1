import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = os.environ.get("CITYSTREAM_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from citystream.session import get_session
    # Tests run where spark.checkpoint.dir may be unset: give them their own.
    extra = {}
    from pyspark.sql import SparkSession
    if SparkSession.getActiveSession() is None:
        extra["spark.checkpoint.dir"] = os.environ.get(
            "SPARK_CHECKPOINT_DIR", tempfile.mkdtemp(prefix="citystream-test-"))
    s = get_session("local[*]", shuffle_partitions=8, extra=extra)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
