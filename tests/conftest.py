import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_spark

    s = get_spark("strata-tests", master="local[4]", shuffle_partitions=4,
                  extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    """A path that does not exist yet, inside a fresh scratch folder."""
    return os.path.join(tempfile.mkdtemp(prefix="strata-test-"), "t")
