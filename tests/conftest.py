from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from basketmill.session import get_spark  # noqa: E402
from basketmill.sources.star import StarSource  # noqa: E402

TESTDATA = "/root/testdata"
SMALL = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__driver__memory="6g",
        spark__log__level="OFF",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return StarSource(spark, SMALL)
