from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from brooklog.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = local_session(
        8, 4, **{"spark.checkpoint.dir": str(scratch), "spark.driver.memory": "4g"}
    )
    yield session
    session.stop()


@pytest.fixture
def home(tmp_path):
    return str(tmp_path)
