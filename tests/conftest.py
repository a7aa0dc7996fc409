from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from gablework.session import local_session  # noqa: E402

TABLES = os.environ.get("GABLEWORK_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    if not Path(TABLES).is_dir():
        pytest.skip(f"no tables at {TABLES}")
    return TABLES
