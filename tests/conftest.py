from __future__ import annotations

import sys
import pathlib

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from sensorloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(root / "checkpoints"),
        "spark.sql.warehouse.dir": str(root / "warehouse"),
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF


def rows(df):
    """Rows of a frame as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
