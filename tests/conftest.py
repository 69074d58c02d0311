import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from chronoledger.session import build_session

    s = build_session("local[4]", 4, extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cl-wh-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
