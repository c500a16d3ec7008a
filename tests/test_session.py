from __future__ import annotations

import pytest

from basketmill.operators import staging
from basketmill.session import GIB, sized_for


def test_settings_follow_the_input_size():
    def partitions(size):
        return int(sized_for(size)["spark__sql__shuffle__partitions"])

    assert partitions(0) == partitions(100 * GIB) == 200
    assert partitions(5000 * GIB) == 1000
    assert partitions(100 * 1024 * GIB) == 20_480
    assert partitions(1000 * 1024 * GIB) == 204_800
    assert sized_for(GIB)["spark__sql__files__maxPartitionBytes"] == "128m"
    assert sized_for(100 * 1024 * GIB)["spark__sql__files__maxPartitionBytes"] == "524m"


class FakeSession:
    """Just the settings that decide where intermediate tables go."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})()


def test_staging_folder():
    assert staging.staging_folder(FakeSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_folder(FakeSession("yarn"))
    local = staging.staging_folder(FakeSession("local[2]"))
    assert local and local == staging.staging_folder(FakeSession("local[2]"))
