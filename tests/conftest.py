from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tideglass.session import build_session

    s = build_session("local[4]", "tests", spark__driver__memory="6g", spark__sql__shuffle__partitions="4")
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small() -> str:
    if not Path(SMALL).exists():
        pytest.skip("no test data")
    return SMALL
