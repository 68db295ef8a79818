import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.config import get_session
    s = get_session("local[4]", 4, app_name="strata-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-test-ckpt-")})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
