import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from keeprule.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "keeprule-tests",
        master="local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def nothing_is_small(monkeypatch):
    """Let every measured table count as too large for a broadcast."""
    from keeprule.operators import lookups

    monkeypatch.setattr(lookups, "BROADCAST_ROWS", -1)
