from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from corpusloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "tests", shuffle=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
