from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lexloom.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture
def one(spark):
    """Evaluate a column over one row of string columns given as keywords."""

    def run(column, **values):
        schema = ", ".join(f"{name} string" for name in values)
        return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]

    return run
