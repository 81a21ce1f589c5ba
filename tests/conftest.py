import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from metroflux.session import get_session
    ckpt = tempfile.mkdtemp(prefix="metroflux-test-ckpt-")
    s = get_session("local[*]", 8, extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g"})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.01"
