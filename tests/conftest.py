import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shelflens.session import get_session
    s = get_session("local[4]", shuffle_partitions=8,
                    extra={"spark.local.dir": tempfile.mkdtemp(prefix="shelflens-test-"),
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shelflens-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)
