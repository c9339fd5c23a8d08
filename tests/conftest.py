from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
