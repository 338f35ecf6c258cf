import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tallystar.session import get_session
    s = get_session("local[4]", 8, app_name="tallystar-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh folder under the session's scratch root."""
    from tallystar.session import fresh_path
    return fresh_path(spark, "test")


@pytest.fixture()
def local_tmp():
    return tempfile.mkdtemp(prefix="tallystar-test-")
