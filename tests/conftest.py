import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ladderweek import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    session = build_session("local[4]", 4, **quiet)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
