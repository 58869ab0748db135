import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("LEDGERLINE_DRIVER_MEMORY", "6g")
    s = local_session(8, 4, app="tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
