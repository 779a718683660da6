import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from persona_engine.session import get_session
    s = get_session("local[4]", 8, app_name="persona_engine_tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pe-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="pe-test-out-")
