from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from order_analytics.operators import staging  # noqa: E402
from order_analytics.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=tmp_path_factory.mktemp("shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    staging.RELEASE_ROUNDS = 0  # small tables leave little to release, and every round waits
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema -> DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
