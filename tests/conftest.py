import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from streetloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", 4, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
