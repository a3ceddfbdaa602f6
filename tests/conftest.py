from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marketfold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def scratch() -> Path:
    return Path(tempfile.mkdtemp(prefix="run-"))


@pytest.fixture(scope="session")
def spark(scratch):
    session = build_session(
        "marketfold-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.checkpoint.dir": str(scratch / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
