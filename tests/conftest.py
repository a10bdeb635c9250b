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
    from daybook.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    # Tests have no cluster-provided checkpoint folder: use a private one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def wh_root(tmp_path):
    return str(tmp_path / "warehouse")
