import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from driftline.session import local_session
    warehouse = tempfile.mkdtemp(prefix="driftline-wh-")
    s = local_session(4, 8, extra={"spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture
def tmp_uri(tmp_path):
    return str(tmp_path)
